"""Delete from each document the passages it shares with earlier ones, by aligning their lines.

Single lines recur by chance, so the keys of a document are its shortest runs of lines with enough
words (one line, where that has enough).  Holders of each key are counted over the whole table; a key that
one document has alone finds nothing, and of the others every holder meets the first document that
has it.  Each such pair is aligned with patience diff (lines that occur once on either side are matched in
order, and the stretches between them again), and runs of aligned lines with enough words leave
the later document.  Patience diff keeps one order and needs lines that occur once; blocks that were moved, or
are repeated on either side, are anchored by the keys that both documents have.

So all blocks that any earlier document has are found: each holds keys, and each key's first owner is a partner.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.llm.common import stored
from postsieve.llm.near_join import row_key
from postsieve.llm.words import distinct, mix, small_batches, text_buffer, word_hashes

#: Words of a block that is worth deleting.  Shorter repeats are ordinary language.
MIN_WORDS = 20
#: Holders of one key are dealt over this many tasks where they meet its owner.
SALTS = 16
#: Of the hashes of runs of lines; odd.
_BASE = 0x9E3779B97F4A7C15


def line_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(hashes, words, counts)``: of each line its words' hash and number, of each text its lines.

    Lines end at line feeds; a NULL text has none, an empty one has one.
    """
    flat, offsets = text_buffer(texts)
    hashes, starts, _ = word_hashes(texts)
    feeds = np.flatnonzero(flat == 10)
    has_text = texts.is_valid().to_numpy(zero_copy_only=False)
    # A text's lines start at its first byte and behind its line feeds.
    line_starts = np.concatenate((offsets[:-1][has_text], feeds + 1))
    owner = np.concatenate(
        (np.flatnonzero(has_text), np.searchsorted(offsets, feeds, side="right") - 1)
    )
    order = np.lexsort((line_starts, owner))
    line_starts, owner = line_starts[order], owner[order]
    counts = np.bincount(owner, minlength=len(offsets) - 1)
    # Words of line i are those that start before line i + 1 does.
    first = np.searchsorted(starts, line_starts)
    last = np.append(first[1:], len(starts)) if len(first) else first
    words = last - first
    place = np.arange(len(hashes)) - np.repeat(first, words)
    placed = mix(hashes + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(placed, dtype=np.uint64)))
    lines = mix(sums[last] - sums[first] + words.astype(np.uint64)) if len(first) else np.zeros(0, np.uint64)
    return lines.view(np.int64), words, counts


def shortest_runs(lines: np.ndarray, words: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(hash, start, end)``: from each line on, and up to each line, the fewest lines with ``min_words`` words.

    Ends are exclusive.  Every line of a block with so many words is in such a run within the block.
    """
    n, at = len(lines), np.arange(len(lines))
    total = np.concatenate((np.zeros(1, np.int64), np.cumsum(words, dtype=np.int64)))
    ahead = np.maximum(np.searchsorted(total, total[:-1] + min_words), at + 1)
    back = np.minimum(np.searchsorted(total, total[1:] - min_words, side="right") - 1, at)
    start = np.concatenate((at[ahead <= n], back[back >= 0]))
    end = np.concatenate((ahead[ahead <= n], at[back >= 0] + 1))
    start, end = np.unique(np.stack((start, end)), axis=1)
    base, inverse = (np.full(n, x, np.uint64) for x in (_BASE, pow(_BASE, -1, 1 << 64)))
    base[:1], inverse[:1] = 1, 1
    sums = np.cumsum(mix(lines.view(np.uint64)) * np.cumprod(base), dtype=np.uint64)
    sums = np.concatenate((np.zeros(1, np.uint64), sums))
    run = mix((sums[end] - sums[start]) * np.cumprod(inverse)[start] + (end - start).astype(np.uint64))
    return run.view(np.int64), start, end


def document_lines(docs: DataFrame, min_words: int) -> DataFrame:
    """``(doc_id, row_key, lines, words, keys)`` of ``(doc_id, row_key, text)``: hashes and words of lines, keys."""
    kind = docs.schema["row_key"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches(batch):
                lines, words, counts = line_hashes(part.column("text"))
                cuts = np.concatenate(([0], np.cumsum(counts)))
                keys = [
                    distinct(shortest_runs(lines[a:b], words[a:b], min_words)[0])
                    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())
                ]
                at, ends = (pa.array(x.astype(np.int32)) for x in (cuts, np.cumsum([0, *map(len, keys)])))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("row_key"),
                        pa.ListArray.from_arrays(at, pa.array(lines)),
                        pa.ListArray.from_arrays(at, pa.array(words.astype(np.int32))),
                        pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.zeros(0, np.int64), *keys]))),
                    ],
                    ["doc_id", "row_key", "lines", "words", "keys"],
                )

    schema = f"doc_id BIGINT, row_key {kind}, lines ARRAY<BIGINT>, words ARRAY<INT>, keys ARRAY<BIGINT>"
    return docs.mapInArrow(read, schema)


def _longest_run(places: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence of ``(i, j)``, given by ascending i, in which j ascends too."""
    tops: list[int] = []
    piles: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(places):
        at = bisect_left(tops, j)
        back.append(piles[at - 1] if at else -1)
        if at == len(tops):
            tops.append(j)
            piles.append(k)
        else:
            tops[at], piles[at] = j, k
    out = []
    k = piles[-1] if piles else -1
    while k >= 0:
        out.append(places[k])
        k = back[k]
    return out[::-1]


def patience_matches(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """Aligned equal lines ``(i, j)`` of two sequences, ascending in both."""
    matches: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            matches.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            matches.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        once = {line: j for j, line in enumerate(b[b0:b1], b0) if in_b[line] == 1 and in_a[line] == 1}
        anchors = _longest_run([(i, once[a[i]]) for i in range(a0, a1) if a[i] in once])
        if not anchors:
            continue
        for (i, j), (p, q) in zip([(a0 - 1, b0 - 1), *anchors], [*anchors, (a1, b1)]):
            todo.append((i + 1, p, j + 1, q))
        matches.extend(anchors)
    return sorted(matches)


def merged(spans: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """What the spans cover, as spans that do not touch."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(x) for x in out]


def repeated_blocks(
    later: np.ndarray, words: np.ndarray, earlier: np.ndarray, earlier_words: np.ndarray, min_words: int
) -> list[tuple[int, int]]:
    """Spans ``(start, end)`` of lines in ``later`` that stand in ``earlier``, in blocks of ``min_words`` words or more."""
    total = np.concatenate(([0], np.cumsum(words)))
    out: list[tuple[int, int]] = []
    begin = before = None
    for i, j in [*patience_matches(later.tolist(), earlier.tolist()), (-1, -1)]:
        if before is None or (i, j) != (before[0] + 1, before[1] + 1):
            if before is not None and total[before[0] + 1] - total[begin] >= min_words:
                out.append((begin, before[0] + 1))
            begin = i
        before = (i, j)
    # Blocks out of order, or of lines that occur more than once.
    run, start, end = shortest_runs(later, words, min_words)
    if len(run):
        known = distinct(shortest_runs(earlier, earlier_words, min_words)[0])
        if len(known):
            at = np.minimum(np.searchsorted(known, run), len(known) - 1)
            both = known[at] == run
            out += zip(start[both].tolist(), end[both].tolist())
    return merged(out)


def repeated_lines(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``(row_key, spans)``: lines (numbers from 0, ends exclusive) that repeat an earlier document's.

    ``lines`` has ``(place, row_key, lines, words, keys)``, where ``place`` orders the documents.
    """
    each = lines.select("place", F.explode("keys").alias("key"))
    owners = each.groupBy("key").agg(F.min("place").alias("owner"), F.max("place").alias("last"))
    owners = owners.where("last <> owner").select("key", "owner")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    owners = owners.select("key", "owner", salts)
    salted = each.withColumn("salt", F.pmod(F.xxhash64("place"), F.lit(SALTS)).cast("int"))
    met = salted.join(owners.hint("merge"), ["key", "salt"]).where("owner < place")
    pairs = met.select(F.col("place.row_key").alias("row_key"), F.col("owner.row_key").alias("owner_key")).distinct()
    pairs = stored(pairs)
    content = lines.select("row_key", "lines", "words").dropDuplicates(["row_key"])
    # Never by broadcast: lines grow with the documents.
    later = pairs.join(content.hint("merge"), "row_key")
    own = {"row_key": "owner_key", "lines": "owner_lines", "words": "owner_words"}
    both = later.join(content.withColumnsRenamed(own).hint("merge"), "owner_key")
    columns = ["lines", "words", "owner_lines", "owner_words"]
    kind = lines.schema["row_key"].dataType.simpleString()

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, found = [], []
            for row in range(batch.num_rows):
                spans = repeated_blocks(*(batch.column(c)[row].values.to_numpy() for c in columns), min_words)
                if spans:
                    at.append(row)
                    found.append([{"start": a, "end": b} for a, b in spans])
            kind_ = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_key").take(pa.array(at, pa.int64())), pa.array(found, kind_)], ["row_key", "found"]
            )

    span = "ARRAY<STRUCT<start: INT, end: INT>>"
    aligned = both.select("row_key", *columns).mapInArrow(align, f"row_key {kind}, found {span}")
    return aligned.groupBy("row_key").agg(F.flatten(F.collect_list("found")).alias("spans"))


def _decided(found: DataFrame, lines: DataFrame) -> DataFrame:
    """``(row_key, removed, removed_words, __kept)``: spans of lines that go, apart from each other, and that stay."""
    given = found.join(lines.select("row_key", "words").dropDuplicates(["row_key"]).hint("merge"), "row_key")
    kind = lines.schema["row_key"].dataType.simpleString()
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, n_words, kept = [], [], []
            for spans, words in zip(batch.column("spans").to_pylist(), batch.column("words")):
                total = np.concatenate(([0], np.cumsum(words.values.to_numpy(), dtype=np.int64)))
                gone = merged([(s["start"], s["end"]) for s in spans])
                ends = [0, *[b for _, b in gone]]
                starts = [*[a for a, _ in gone], len(total) - 1]
                removed.append([{"start": a, "end": b} for a, b in gone])
                kept.append([{"start": a, "end": b} for a, b in zip(ends, starts) if a < b])
                n_words.append(sum(int(total[b] - total[a]) for a, b in gone))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_key"), pa.array(removed, span), pa.array(n_words, pa.int64()), pa.array(kept, span)],
                ["row_key", "removed", "removed_words", "__kept"],
            )

    spans = "ARRAY<STRUCT<start: INT, end: INT>>"
    return given.select("row_key", "spans", "words").mapInArrow(
        decide, f"row_key {kind}, removed {spans}, removed_words BIGINT, __kept {spans}"
    )


def dedup_lines(
    docs: DataFrame, min_words: int = MIN_WORDS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """All columns of ``docs`` with the text less the lines that repeat earlier documents.

    A block of lines with ``min_words`` words or more that stands in any earlier document goes.
    Adds ``removed`` (spans of lines from 0, ends exclusive, NULL for none), ``n_lines`` and
    ``removed_words``; columns of ``docs`` with these names give way.  Documents are ordered by
    id, NULL last, then by hashes of the text.  Lines are equal if their words are (words between
    ASCII white space).  Of documents that repeat another wholly nothing is left: their text is
    empty.  Rows that repeat both id and text are judged alike, as one document.  NULL texts stay
    NULL, texts without a repeat stay as they are.  An empty table gives an empty result.
    """
    own = ["removed", "n_lines", "removed_words"]
    docs = docs.drop(*own)
    key = row_key(doc_id, text)
    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"), key.alias("row_key")
    )
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_key")
    lines = stored(document_lines(rows, min_words).withColumn("place", place))
    decided = stored(_decided(repeated_lines(lines, min_words), lines).withColumnRenamed("row_key", "__key"))
    split = F.split(F.col(text), "\n", -1)
    # The text is split once, and not for each of its parts.
    parts = F.transform(
        F.array(split),
        lambda given: F.flatten(F.transform("__kept", lambda s: F.slice(given, s["start"] + 1, s["end"] - s["start"]))),
    )[0]
    return (
        docs.withColumn("__key", key)
        # Always by a shuffle: the list of what is removed grows with the documents.
        .join(decided.hint("merge"), "__key", "left")
        .withColumn("n_lines", F.size(split).cast("bigint"))
        .withColumn(text, F.when(F.col("removed").isNull(), F.col(text)).otherwise(F.array_join(parts, "\n")))
        .withColumn("removed_words", F.coalesce("removed_words", F.lit(0)))
        .select(*docs.columns, *own)
    )
