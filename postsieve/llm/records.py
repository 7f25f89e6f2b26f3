"""Token ids as length-delimited binary records with masked checksums, and an index beside them.

A record file ``part-00000.rec`` holds, for each sequence, in this order: the payload's length
(8 bytes), the masked CRC-32C of those 8 bytes (4), the payload, the masked CRC-32C of the
payload (4); all numbers are little-endian.  That is the framing of the TFRecord format.  The
payload is one flag byte (1: the document has an id), one byte with the width of a token id (2
or 4), the document's id (8 bytes) and the token ids.  ``part-00000.idx`` has 24 bytes per
record, the document's id, the record's offset and its length, so that records can be read in
any order without scanning the file.

Files are written under a name of the attempt and then renamed, so a task that is lost or runs
twice leaves one whole file.
"""

from __future__ import annotations

import posixpath
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postsieve.llm.common import in_doc_order, input_tasks, running_totals, stored
from postsieve.llm.tokens import encoder

HEADER = np.dtype([("has_id", "u1"), ("width", "u1"), ("doc_id", "<i8")])
INDEX = np.dtype([("doc_id", "<i8"), ("offset", "<u8"), ("length", "<u8")])
#: Bytes gathered before they are written, and bytes read at once.
BLOCK = 8 << 20

# The Castagnoli polynomial (reflected) and the constant of the checksum's mask.
_POLYNOMIAL = 0x82F63B78
_MASK = 0xA282EAD8
_ROW = 256  # bytes whose checksums are computed side by side


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_POLYNOMIAL), table >> 1)
    return table


def _zero_tables(n: int) -> np.ndarray:
    """Four tables that move a checksum's state past ``n`` zero bytes."""
    state = np.arange(256, dtype=np.uint32) << (np.arange(4, dtype=np.uint32) * 8)[:, None]
    for _ in range(n):
        state = _TABLE[state & 255] ^ (state >> 8)
    return state


_TABLE = _byte_table()
_NEXT4, _NEXT_ROW = _zero_tables(4), _zero_tables(_ROW)


def _move(tables: np.ndarray, state: np.ndarray) -> np.ndarray:
    out = tables[0][state & 255]
    for k in (1, 2, 3):
        out ^= tables[k][(state >> (8 * k)) & 255]
    return out


def masked_crc32c(payloads: list[bytes]) -> np.ndarray:
    """Masked CRC-32C of byte strings of 4 bytes or more, computed side by side."""
    sizes = np.array([len(p) for p in payloads], np.int64)
    n_rows = -(-sizes // _ROW)
    last = np.cumsum(n_rows)
    grid = np.zeros(int(last[-1]) * _ROW if len(last) else 0, np.uint8)
    for payload, size, end in zip(payloads, sizes.tolist(), (last * _ROW).tolist()):
        grid[end - size : end] = np.frombuffer(payload, np.uint8)
        grid[end - size : end - size + 4] ^= 0xFF  # zeros before a payload change nothing
    words = np.ascontiguousarray(grid.view("<u4").reshape(-1, _ROW // 4).T)
    rows = np.zeros(words.shape[1], np.uint32)
    for word in words:
        rows = _move(_NEXT4, rows ^ word)
    state = np.zeros(len(payloads), np.uint32)
    order = np.argsort(-n_rows, kind="stable")
    fewest_first = n_rows[order][::-1]
    most = int(n_rows.max()) if len(n_rows) else 0
    for left in range(most, 0, -1):  # rows still to come, this one included
        active = order[: len(order) - int(np.searchsorted(fewest_first, left))]
        state[active] = _move(_NEXT_ROW, state[active]) ^ rows[last[active] - left]
    state ^= np.uint32(0xFFFFFFFF)
    return ((state >> np.uint32(15)) | (state << np.uint32(17))) + np.uint32(_MASK)


def frame(payloads: list[bytes]) -> list[bytes]:
    """Each payload with its length and the two checksums."""
    lengths = [len(p).to_bytes(8, "little") for p in payloads]
    heads, tails = masked_crc32c(lengths).astype("<u4"), masked_crc32c(payloads).astype("<u4")
    return [
        b"".join((length, heads[i].tobytes(), payload, tails[i].tobytes()))
        for i, (length, payload) in enumerate(zip(lengths, payloads))
    ]


def unframe(block: bytes, offsets: np.ndarray, verify: bool = True) -> list[bytes]:
    """Payloads of the records at ``offsets`` of a block; a wrong checksum is an error."""
    view, payloads, heads, tails, lengths = memoryview(block), [], [], [], []
    for at in offsets.tolist():
        lengths.append(bytes(view[at : at + 8]))
        end = at + 12 + int.from_bytes(lengths[-1], "little")
        heads.append(int.from_bytes(view[at + 8 : at + 12], "little"))
        payloads.append(bytes(view[at + 12 : end]))
        tails.append(int.from_bytes(view[end : end + 4], "little"))
    if verify and payloads:
        good = np.array_equal(masked_crc32c(lengths), np.array(heads, np.uint32))
        if not good or not np.array_equal(masked_crc32c(payloads), np.array(tails, np.uint32)):
            raise ValueError("a record's checksum does not match")
    return payloads


class _PartWriter:
    """One task's record file and its index."""

    def __init__(self, folder: str, part: int):
        self.fs, root = fs.FileSystem.from_uri(folder)
        self.name = f"part-{part:05d}"
        self._base = posixpath.join(root, self.name)
        self._work = posixpath.join(root, f"_{self.name}-{uuid.uuid4().hex}")
        self.fs.create_dir(root, recursive=True)
        self._out = self.fs.open_output_stream(self._work + ".rec")
        self._index = self.fs.open_output_stream(self._work + ".idx")
        self.size = self.records = self.tokens = 0
        self._waiting: list[tuple[int, bytes]] = []
        self._bytes = 0

    def add(self, doc_id: int | None, ids: bytes, width: int) -> None:
        head = np.array((doc_id is not None, width, doc_id or 0), HEADER).tobytes()
        self._waiting.append((doc_id or 0, head + ids))
        self._bytes += len(ids)
        self.tokens += len(ids) // width
        if self._bytes >= BLOCK:
            self.flush()

    def flush(self) -> None:
        framed = frame([payload for _, payload in self._waiting])
        sizes = np.array([len(f) for f in framed], np.int64)
        index = np.zeros(len(framed), INDEX)
        index["doc_id"] = [doc_id for doc_id, _ in self._waiting]
        index["length"] = sizes
        index["offset"] = self.size + np.cumsum(sizes) - sizes
        self._out.write(b"".join(framed))
        self._index.write(index.tobytes())
        self.size, self.records = self.size + int(sizes.sum()), self.records + len(framed)
        self._waiting, self._bytes = [], 0

    def close(self) -> None:
        self.flush()
        for stream, kind in ((self._out, ".rec"), (self._index, ".idx")):
            stream.close()
            self.fs.move(self._work + kind, self._base + kind)


FILES_SCHEMA = "part INT, file STRING, n_records BIGINT, n_tokens BIGINT, n_bytes BIGINT"


def write_sequences(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int | None = 0,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Encode every text and write all documents in ascending order of id; one row per file.

    ``folder`` is a URI on a store that all executors see.  NULL and empty texts have only the
    end id; NULL ids come first; rows with equal ids are all written, next to each other.  An
    empty table writes no file.  Other columns are not written.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, writer, part = encoder(tokenizer), None, 0
        code, width = encode.dtype, encode.dtype.itemsize
        end = b"" if end_id is None else np.array([end_id], code).tobytes()
        for batch in batches:
            for number, name, content in zip(*(batch.column(c) for c in ("part", "doc_id", "text"))):
                if writer is None:
                    part = number.as_py()
                    writer = _PartWriter(folder, part)
                writer.add(name.as_py(), encode.encode(content.as_py()) + end, width)
        if writer is not None:
            writer.close()
            found = [[part], [writer.name], [writer.records], [writer.tokens], [writer.size]]
            types = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(f, t) for f, t in zip(found, types)],
                ["part", "file", "n_records", "n_tokens", "n_bytes"],
            )

    return stored(in_doc_order(rows, ["doc_id"]).mapInArrow(write, FILES_SCHEMA))


SEQUENCES_SCHEMA = (
    "part INT, record BIGINT, doc_id BIGINT, start BIGINT, n_tokens BIGINT, "
    "ids_crc32 BIGINT, ids ARRAY<INT>"
)


def _blocks(index: np.ndarray) -> Iterator[slice]:
    """Runs of records of about BLOCK bytes."""
    block = (index["offset"] // BLOCK).astype(np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(index)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        if a < b:
            yield slice(a, b)


def read_sequences(
    spark: SparkSession, folder: str, files: DataFrame, with_ids: bool = True, verify: bool = True
) -> DataFrame:
    """All records of the files that ``write_sequences`` listed, checked against their checksums.

    ``start`` counts the tokens of all records before this one, over all files in order of part;
    ``ids_crc32`` is of the ids as little-endian 32-bit numbers.  Without ``with_ids`` the list
    of ids is NULL, so that only digests leave the tasks.
    """
    before = running_totals(files.withColumn("all", F.lit(0)), ["n_tokens"], ["all"])
    placed = files.join(F.broadcast(before.drop("all")), "part")  # a row per file
    listed = placed.select("part", "file", "n_tokens_before").repartition(
        input_tasks(spark), "part"
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                base = posixpath.join(root, row["file"])
                with store.open_input_file(base + ".idx") as stream:
                    index = np.frombuffer(stream.read(), INDEX)
                start = row["n_tokens_before"]
                with store.open_input_file(base + ".rec") as stream:
                    for run in _blocks(index):
                        chosen = index[run]
                        first = int(chosen["offset"][0])
                        size = int(chosen["offset"][-1] + chosen["length"][-1]) - first
                        block = stream.read_at(size, first)
                        payloads = unframe(block, chosen["offset"].astype(np.int64) - first, verify)
                        out = _rows(payloads, row["part"], run.start, start, with_ids)
                        start += pa.compute.sum(out.column("n_tokens")).as_py()
                        yield out

    return listed.mapInArrow(read, SEQUENCES_SCHEMA)


def _rows(payloads: list[bytes], part: int, record: int, start: int, with_ids: bool) -> pa.RecordBatch:
    names, counts, sums, lists = [], [], [], []
    for payload in payloads:
        head = np.frombuffer(payload, HEADER, 1)[0]
        ids = np.frombuffer(payload, f"<u{head['width']}", offset=HEADER.itemsize).astype("<u4")
        names.append(int(head["doc_id"]) if head["has_id"] else None)
        counts.append(len(ids))
        sums.append(zlib.crc32(ids))
        lists.append(ids.astype(np.int32) if with_ids else None)
    n = len(payloads)
    starts = start + np.cumsum(counts) - counts
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n, part, np.int32)),
            pa.array(np.arange(record, record + n, dtype=np.int64)),
            pa.array(names, pa.int64()),
            pa.array(starts.astype(np.int64)),
            pa.array(counts, pa.int64()),
            pa.array(sums, pa.int64()),
            pa.array(lists, pa.list_(pa.int32())),
        ],
        ["part", "record", "doc_id", "start", "n_tokens", "ids_crc32", "ids"],
    )


def read_records(folder: str, file: str, records: list[int]) -> list[tuple[int | None, np.ndarray]]:
    """``(doc_id, ids)`` of some records of one file, in the given order, by index alone."""
    store, root = fs.FileSystem.from_uri(folder)
    base, out = posixpath.join(root, file), []
    with store.open_input_file(base + ".idx") as index, store.open_input_file(base + ".rec") as data:
        for number in records:
            entry = np.frombuffer(index.read_at(INDEX.itemsize, number * INDEX.itemsize), INDEX)[0]
            (payload,) = unframe(data.read_at(int(entry["length"]), int(entry["offset"])), np.zeros(1, np.int64))
            head = np.frombuffer(payload, HEADER, 1)[0]
            ids = np.frombuffer(payload, f"<u{head['width']}", offset=HEADER.itemsize)
            out.append((int(head["doc_id"]) if head["has_id"] else None, ids))
    return out
