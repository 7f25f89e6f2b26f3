"""Repeated byte strings across documents, by suffix sorting over a difference cover.

Only bytes that stand in a string of ``length`` bytes which an earlier document has as well are of
interest, so suffixes are sorted by that many bytes, and suffixes that cannot have an equal are
dropped as early as possible:

1. A difference cover D modulo v has, for any two positions, a shift below v that takes both into
   the cover.  So two equal strings of ``length`` bytes hold equal sampled strings of
   ``length - v + 1`` bytes, which are triples of words of up to v bytes (50 bytes: v is 13, D has four
   residues, the triples 38 bytes).  The sampled triples are sorted; those that no other document
   or chunk of documents has are unique.
2. Suffixes without a shared triple at any sampled position of their first v bytes have no equal
   and are gone.  The remaining ones are named for their whole ``length`` and merged: sorted
   together, whatever their residues.
3. Neighbours in that order with equal names are one string; all but those of the first document
   that has it mark bytes as repeated.

Names are hashes of the bytes instead of ranks.  Ranks would have to be sent back to each position at
each level of the recursion; a hash of names is known on the spot, and any fixed order of names
brings equal ones together.

A text that an earlier document has wholly is repeated as a whole, and its suffixes are left out:
the earlier one has the same.  Documents are dealt into chunks of consecutive ids and about equal bytes.  Each chunk sends its
sorted, distinct names as one compressed block of differences per range of names, and gets a bit for
each of them back.  So a passage that very many documents have is sent once per chunk, and no
position is a row of a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postsieve.llm.common import in_doc_order, running_totals, stored
from postsieve.llm.sorted_numbers import grouped, packed_names, unpacked_names
from postsieve.llm.words import distinct

#: Bytes of the shortest repeated string.
LENGTH = 50
#: Bytes of text in a chunk.
CHUNK = 8 << 20
#: Names that one task merges, about.
MERGED = 2_000_000
#: Bytes of text whose names are computed at a time.
PIECE = 1 << 18
#: Largest modulus whose smallest cover is searched for.
SEARCHED = 32
#: Bits of names beyond those that number all bytes (64 in all at most).  A triple taken for shared
#: though it is not costs a little work; a string taken for repeated would be lost.
TRIPLE_BITS, STRING_BITS = 10, 32
_ODD = np.uint64(0x9E3779B97F4A7C15)


@lru_cache
def difference_cover(v: int) -> tuple[int, ...]:
    """Residues such that every difference modulo ``v`` is one of two of them."""

    def covers(chosen: tuple[int, ...]) -> bool:
        return len({(a - b) % v for a in chosen for b in chosen}) == v

    if v <= SEARCHED:
        for size in range(1, v + 1):
            for rest in combinations(range(1, v), size - 1):
                if covers((0, *rest)):
                    return (0, *rest)
    # A run of steps of one, and steps of that run's length.
    step = int(np.ceil(np.sqrt(v)))
    return tuple(sorted({*range(step), *range(0, v, step)}))


def modulus(length: int) -> int:
    """Of the cover: a quarter of the bytes is for the shift, the others are the sampled string."""
    return length // 4 + 1


def _words(flat: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number; behind the end are zeros."""
    words = np.concatenate((flat, np.zeros(8, np.uint8))).astype(np.uint64)
    for half in (1, 2, 4):
        words = words[:-half] | (words[half:] << np.uint64(8 * half))
    return words[: len(flat)]


def _names(words: np.ndarray, at: np.ndarray, length: int, bits: int) -> np.ndarray:
    """Names of the ``length`` bytes from each of the positions on (within ``words``)."""
    name = np.full(len(at), length, np.uint64)
    for begin in range(0, length, 8):
        word = words[at + begin]
        if length - begin < 8:
            word &= np.uint64((1 << 8 * (length - begin)) - 1)
        name += word
        name *= _ODD
        name ^= name >> np.uint64(32)
    name *= _ODD
    return name >> np.uint64(64 - bits)


def _name_of(doc_id: int | None) -> bytes:
    """What tells rows of one text apart."""
    return b" NULL" if doc_id is None else b" %d" % doc_id


class Chunk:
    """The texts of a chunk, and names of the suffixes of those that are no copies of an earlier text."""

    def __init__(self, table: pa.Table, reply: pa.Table, length: int):
        parts = [pa.ipc.open_stream(pa.py_buffer(blob.as_py())).read_all() for blob in table.column("texts")]
        rows = pa.concat_tables(parts).to_pydict()
        copies = {r["bits"] for r in reply.to_pylist() if r["phase"] == COPY}
        # Rows in order of id, NULL last; equal ids have one rank.
        rows = sorted(
            (i is None, i or 0, text, i, key) for i, text, key in zip(rows["doc_id"], rows["text"], rows["key"])
        )
        self.rows = [(i, text, (key + _name_of(i)) in copies) for _, _, text, i, key in rows]
        fresh = [(i, text) for i, text, copied in self.rows if not copied]
        self.length = length
        self.sizes = np.array([len(text) for _, text in fresh], np.int64)
        self.starts = np.concatenate((np.zeros(1, np.int64), np.cumsum(self.sizes)))
        change = [k == 0 or fresh[k][0] != fresh[k - 1][0] for k in range(len(fresh))]
        self.rank = np.cumsum(change).astype(np.int64)
        self.flat = np.frombuffer(b"".join(text for _, text in fresh), np.uint8)

    def pieces(self, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """``(begin, end, offsets, fits)``: places in their documents, whether ``size`` bytes from there are in it."""
        for begin in range(0, len(self.flat), PIECE):
            end = min(begin + PIECE, len(self.flat))
            a = int(np.searchsorted(self.starts, begin, side="right")) - 1
            b = int(np.searchsorted(self.starts, end))
            cuts = np.clip(self.starts[a : b + 1], begin, end)
            owner = np.repeat(np.arange(a, b), np.diff(cuts))
            offset = np.arange(begin, end) - self.starts[owner]
            yield begin, end, offset, offset + size <= self.sizes[owner]

    def named(self, positions: np.ndarray, size: int, bits: int) -> np.ndarray:
        """Names of the ``size`` bytes from each of the ascending positions on."""
        names = [np.zeros(0, np.uint64)]
        for begin in range(0, len(self.flat), PIECE):
            a, b = np.searchsorted(positions, (begin, begin + PIECE))
            if a < b:
                words = _words(self.flat[begin : begin + PIECE + size])
                names.append(_names(words, positions[a:b] - begin, size, bits))
        return np.concatenate(names)

    def sampled(self, v: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """``(positions, names)`` of the sampled strings that end within their document."""
        size = self.length - v + 1
        cover = np.zeros(v, bool)
        cover[list(difference_cover(v))] = True
        found = [begin + np.flatnonzero(cover[offset % v] & fits) for begin, _, offset, fits in self.pieces(size)]
        positions = np.concatenate([np.zeros(0, np.int64), *found])
        return positions, self.named(positions, size, bits)

    def remaining(self, v: int, shared: np.ndarray) -> np.ndarray:
        """Which suffixes have a shared sampled position among their first ``v`` bytes."""
        near = np.zeros(len(self.flat) + 1, np.int32)
        np.add.at(near, np.maximum(shared - v + 1, 0), 1)
        np.add.at(near, shared + 1, -1)
        left = np.cumsum(near[:-1], dtype=np.int32) > 0
        for begin, end, _, fits in self.pieces(self.length):
            left[begin:end] &= fits
        return left

    def ranks(self, positions: np.ndarray) -> np.ndarray:
        return self.rank[np.searchsorted(self.starts, positions, side="right") - 1]


_NAMES = "order BIGINT, part INT, phase INT, bucket BIGINT, n BIGINT, names BINARY"
_REPLY = "order BIGINT, part INT, phase INT, bucket BIGINT, n BIGINT, bits BINARY"
#: Phases: which texts are copies, names of triples, names of whole strings, what a chunk notes for itself.
COPY, TRIPLES, STRINGS, OWN = 0, 1, 2, 3


def _columns(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _key(table: pa.Table) -> tuple[int, int]:
    return tuple(table.column(c)[0].as_py() for c in ("order", "part"))


def _rows(key: tuple[int, int], phase: int, blocks: list[tuple[int, int, bytes]]) -> pa.Table:
    """Rows of ``_NAMES``, from ``(bucket, n, blob)``."""
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    rows = [(*key, phase, *block) for block in blocks]
    return pa.table(
        [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=_columns(_NAMES)
    )


def _ranges(names: np.ndarray, bits: int, buckets: int) -> list[tuple[int, int, bytes]]:
    """Ascending distinct names, cut into ranges."""
    width = np.uint64(((1 << bits) - 1) // buckets + 1)
    bucket = (names // width).astype(np.int64)
    new = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist()
    return [(int(bucket[a]), b - a, packed_names(names[a:b])) for a, b in zip(new, [*new[1:], len(names)])]


def _answer(reply: pa.Table, phase: int, n: int) -> np.ndarray:
    """The bit of each of the ``n`` names that a chunk has sent, in order."""
    rows = [r for r in reply.to_pylist() if r["phase"] == phase]
    rows.sort(key=lambda r: r["bucket"])
    bits = [np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=r["n"]).astype(bool) for r in rows]
    out = np.concatenate(bits) if bits else np.zeros(0, bool)
    if len(out) != n:
        raise ValueError(f"{len(out)} answers for {n} names")
    return out


def _merged(names: DataFrame, earlier: bool) -> DataFrame:
    """Rows of ``_REPLY``: which names another chunk has, or (``earlier``) one of a lower order.

    The blocks of one range of names are merged in a task.  What a chunk has sent to itself goes back.
    """

    def merge(table: pa.Table) -> pa.Table:
        every_row = table.to_pylist()
        rows = [r for r in every_row if r["phase"] != OWN]
        back = [(r, r["names"]) for r in every_row if r["phase"] == OWN]
        if rows:
            times = np.array([r["n"] for r in rows], np.int64)
            every = np.concatenate([unpacked_names(r["names"], r["n"]) for r in rows])
            order, group, first = grouped(every)
            if earlier:
                chunk = np.repeat(np.array([r["order"] for r in rows], np.int64), times)[order]
                found = np.minimum.reduceat(chunk, first)[group] < chunk
            else:
                found = (np.diff(np.append(first, len(every))) > 1)[group]
            bits = np.zeros(len(every), bool)
            bits[order] = found
            ends = np.cumsum(times)
            back += [(r, np.packbits(bits[e - r["n"] : e]).tobytes()) for e, r in zip(ends, rows)]
        kinds = {"order": pa.int64(), "part": pa.int32(), "phase": pa.int32(), "bucket": pa.int64(), "n": pa.int64()}
        return pa.table(
            [*[pa.array([r[c] for r, _ in back], k) for c, k in kinds.items()], pa.array([b for _, b in back], pa.binary())],
            names=_columns(_REPLY),
        )

    return names.groupBy("bucket").applyInArrow(merge, _REPLY)


def chunk_starts(sizes: DataFrame, chunk: int) -> list[tuple[int | None, int, int]]:
    """``(first id, order, parts)`` of all chunks, by id; a few bytes for each chunk of the table.

    An id whose texts alone fill a chunk has an order of its own and may have several parts.  NULL
    ids are the last order.
    """
    sizes = sizes.groupBy("doc_id").agg(F.sum(F.col("size") + 1).alias("size"))
    known = stored(in_doc_order(sizes.where("doc_id IS NOT NULL"), ["doc_id"]).withColumn("all", F.lit(0)))
    totals = known.groupBy("part", "all").agg(F.sum("size").alias("bytes"))
    before = F.broadcast(running_totals(totals, ["bytes"], ["all"]).drop("all"))  # a row per task
    so_far = Window.partitionBy("part").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("size").over(so_far), F.lit(0))
    placed = known.withColumn("inside", inside).join(before, "part")
    large = F.col("size") >= chunk
    order = F.floor((F.col("bytes_before") + F.col("inside")) / chunk) * 2 + large.cast("bigint")
    starts = placed.groupBy(order.cast("bigint").alias("order")).agg(
        F.min("doc_id").alias("first"), F.max(F.when(large, F.ceil(F.col("size") / chunk)).otherwise(1)).alias("parts")
    )
    out = [(r["first"], r["order"], int(r["parts"])) for r in starts.orderBy("first").collect()]
    none = sizes.where("doc_id IS NULL").first()
    if none is not None:
        out.append((None, 1 + max([x[1] for x in out], default=-1), max(1, -(-none["size"] // chunk))))
    return out


class _Places:
    """Order and part of rows, by id and a number that spreads rows of one id."""

    def __init__(self, starts: list[tuple[int | None, int, int]]):
        known = [s for s in starts if s[0] is not None]
        self.firsts = np.array([s[0] for s in known], np.int64)
        self.orders = np.array([s[1] for s in known], np.int64)
        self.several = {s[1]: s[2] for s in starts if s[2] > 1}
        self.nameless = starts[-1][1] if starts and starts[-1][0] is None else -1

    def of(self, batch: pa.RecordBatch) -> tuple[list[int], list[int]]:
        ids = batch.column("doc_id")
        order = np.full(len(ids), self.nameless)
        if len(self.firsts):
            at = np.searchsorted(self.firsts, ids.fill_null(0).to_numpy(), side="right") - 1
            order = np.where(ids.is_null().to_numpy(zero_copy_only=False), order, self.orders[at])
        order = order.tolist()
        return order, [key % self.several.get(o, 1) for key, o in zip(batch.column("spread").to_pylist(), order)]


def _packed(docs: DataFrame, places, chunk: int) -> DataFrame:
    """``(order, part, texts)``: compressed blocks of rows of one chunk."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        held: dict[tuple[int, int], tuple[list, list, list]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for (order, part), (ids, texts, keys) in held.items():
                columns = [pa.array(ids, pa.int64()), pa.array(texts, pa.binary()), pa.array(keys, pa.binary())]
                rows = pa.record_batch(columns, ["doc_id", "text", "key"])
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rows.schema, options=options) as writer:
                    writer.write_batch(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([order], pa.int64()),
                        pa.array([part], pa.int32()),
                        pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                    ],
                    ["order", "part", "texts"],
                )
            held.clear()

        for batch in batches:
            columns = [batch.column(c) for c in ("doc_id", "text", "key")]
            for order, part, doc_id, text, key in zip(*places.value.of(batch), *columns):
                into = held.setdefault((order, part), ([], [], []))
                into[0].append(doc_id.as_py())
                into[1].append(text.as_py())
                into[2].append(key.as_py())
                size += len(into[1][-1]) + 32
                if size > chunk:
                    yield from flush()
                    size = 0
        yield from flush()

    return docs.mapInArrow(pack, "order BIGINT, part INT, texts BINARY")


def _copies(sizes: DataFrame, places, length: int) -> DataFrame:
    """Rows of ``_REPLY`` for texts that an earlier document has wholly; their key and id are in ``bits``."""
    first = sizes.groupBy("key").agg(F.min("doc_id").alias("first"), F.count("*").alias("times")).where("times > 1")
    later = (F.col("doc_id").isNull() & F.col("first").isNotNull()) | (F.col("doc_id") > F.col("first"))
    found = sizes.where(F.col("size") >= length).join(first, "key").where(later)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            order, part = places.value.of(batch)
            n = len(order)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(order, pa.int64()), pa.array(part, pa.int32()), pa.array([COPY] * n, pa.int32()),
                    pa.array([0] * n, pa.int64()), pa.array([1] * n, pa.int64()),
                    pa.array(
                        [k + _name_of(i) for k, i in zip(batch.column("key").to_pylist(), batch.column("doc_id").to_pylist())],
                        pa.binary(),
                    ),
                ],
                _columns(_REPLY),
            )

    # Once for rows that repeat id and text.
    return found.select("doc_id", "spread", "key").mapInArrow(place, _REPLY).distinct()


def repeated_strings(
    docs: DataFrame, length: int = LENGTH, chunk: int = CHUNK, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(doc_id, n_bytes, spans, kept)``, a row per row of ``docs``.

    ``spans`` are the maximal runs ``(start, end)`` of bytes (UTF-8, from 0, ends exclusive) that
    are covered by strings of ``length`` bytes which also begin in a document with a smaller id, as
    they stand in the input; strings never reach from one document into another.  ``kept`` are the
    other bytes one after the other; a character may be cut.

    NULL texts are empty.  Rows with equal ids are not before one another, so they take nothing from
    each other; NULL ids come last.  An empty table gives an empty result; other columns are not
    looked at.  Strings are compared by hashes with 32 bits more than number all bytes, 64 at most.
    """
    content = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), content.alias("text"))
    # By 128 bits and the size: whole texts that are equal.
    hashes = [F.hex(F.xxhash64("text")), F.hex(F.xxhash64(F.lit(1), "text")), F.octet_length("text").cast("string")]
    rows = rows.select(
        "*",
        F.concat_ws(" ", *hashes).cast("binary").alias("key"),
        F.pmod(F.xxhash64("text"), F.lit(1 << 31)).alias("spread"),
    )
    sizes = stored(rows.select("doc_id", "key", "spread", F.octet_length("text").cast("bigint").alias("size")))
    v = modulus(length)
    starts = chunk_starts(sizes, chunk)
    places = docs.sparkSession.sparkContext.broadcast(_Places(starts))
    # Chunks have a known size, so their number says how many names there will be.
    n_bytes = (len(starts) + 1) * chunk
    triple_bits, string_bits = (min(64, n_bytes.bit_length() + more) for more in (TRIPLE_BITS, STRING_BITS))
    buckets = max(1, n_bytes // 4 // MERGED)
    keys = ["order", "part"]
    texts = _packed(rows, places, chunk).groupBy(*keys)
    copies = stored(_copies(sizes, places, length))

    def triples(table: pa.Table, reply: pa.Table) -> pa.Table:
        names = distinct(Chunk(table, reply, length).sampled(v, triple_bits)[1])
        return _rows(_key(table), TRIPLES, _ranges(names, triple_bits, buckets))

    def suffixes(table: pa.Table, reply: pa.Table) -> pa.Table:
        own = Chunk(table, reply, length)
        positions, names = own.sampled(v, triple_bits)
        order, group, first = grouped(names)
        shared = np.zeros(0, bool)
        if len(names):
            rank = own.ranks(positions)[order]
            several = np.minimum.reduceat(rank, first) < np.maximum.reduceat(rank, first)
            shared = (_answer(reply, TRIPLES, len(first)) | several)[group]
        left = own.remaining(v, positions[order[shared]])
        names = distinct(own.named(np.flatnonzero(left), length, string_bits))
        noted = pa.compress(np.packbits(left).tobytes(), codec="zstd", asbytes=True)
        key = _key(table)
        strings = _rows(key, STRINGS, _ranges(names, string_bits, buckets))
        return pa.concat_tables([strings, _rows(key, OWN, [(sum(key) % buckets, len(left), noted)])])

    def remove(table: pa.Table, reply: pa.Table) -> pa.Table:
        own = Chunk(table, reply, length)
        noted = next(r for r in reply.to_pylist() if r["phase"] == OWN)
        size = (noted["n"] + 7) // 8
        bits = pa.decompress(noted["bits"], decompressed_size=size, codec="zstd", asbytes=True)
        left = np.unpackbits(np.frombuffer(bits, np.uint8), count=noted["n"])
        positions = np.flatnonzero(left)
        names = own.named(positions, length, string_bits)
        order, group, first = grouped(names)
        before = np.zeros(0, bool)
        if len(names):
            rank = own.ranks(positions)[order]
            before = _answer(reply, STRINGS, len(first))[group] | (np.minimum.reduceat(rank, first)[group] < rank)
        begins = np.sort(positions[order[before]])
        cuts = np.searchsorted(begins, own.starts)
        spans, kept, fresh = [], [], 0
        for _, content, copied in own.rows:
            if copied:
                spans.append([{"start": 0, "end": len(content)}])
                kept.append(b"")
                continue
            at = begins[cuts[fresh] : cuts[fresh + 1]] - own.starts[fresh]
            fresh += 1
            if not len(at):
                spans.append([])
                kept.append(content)
                continue
            gap = np.flatnonzero(at[1:] > at[:-1] + length)
            start = at[np.append(0, gap + 1)].tolist()
            end = (at[np.append(gap, len(at) - 1)] + length).tolist()
            spans.append([{"start": a, "end": b} for a, b in zip(start, end)])
            kept.append(b"".join(content[a:b] for a, b in zip([0, *end], [*start, len(content)])))
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table(
            {
                "doc_id": pa.array([r[0] for r in own.rows], pa.int64()),
                "n_bytes": pa.array([len(r[1]) for r in own.rows], pa.int64()),
                "spans": pa.array(spans, span),
                "kept": pa.array(kept, pa.binary()),
            }
        )

    shared = _merged(texts.cogroup(copies.groupBy(*keys)).applyInArrow(triples, _NAMES), earlier=False)
    named = texts.cogroup(copies.union(shared).groupBy(*keys)).applyInArrow(suffixes, _NAMES)
    replies = copies.union(_merged(named, earlier=True))
    return texts.cogroup(replies.groupBy(*keys)).applyInArrow(
        remove, "doc_id BIGINT, n_bytes BIGINT, spans ARRAY<STRUCT<start: BIGINT, end: BIGINT>>, kept BINARY"
    )
