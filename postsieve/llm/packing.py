"""Pack documents into sequences: dominance reduction after Martello and Toth, then best fit.

How pieces fit depends only on their lengths, and there are at most as many lengths as a sequence
has tokens.  So the packing is planned on the histogram of lengths, whose size is bounded by the
capacity whatever the corpus: a plan lists layouts (lengths in order) with how many sequences use
each.  Pieces then take the plan's places by their rank among pieces of equal length.  Ranks come
from counts per task and length, so no group of equally long pieces is gathered anywhere.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.llm.common import running_totals, stored
from postsieve.llm.tokens import encoder

PIECES_SCHEMA = (
    "part INT, row BIGINT, doc_id BIGINT, piece INT, start BIGINT, length BIGINT, "
    "ids_crc32 BIGINT, ids BINARY, rank_in_part BIGINT"
)


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int, end_id: int | None,
    doc_id: str = "doc_id", text: str = "text", with_ids: bool = False,
) -> DataFrame:
    """Documents as pieces of at most ``capacity`` tokens; only longer documents are cut.

    ``(part, row)`` tells rows apart whose ids are equal.  ``ids`` holds 32-bit little-endian
    numbers, or NULL without ``with_ids``; ``rank_in_part`` counts the task's earlier pieces of
    this length.  NULL and empty texts have the end id only (and no piece if there is none).
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    columns = [field.split()[0] for field in PIECES_SCHEMA.split(", ")]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.binary(), pa.int64()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, row = encoder(tokenizer), TaskContext.get().partitionId(), 0
        end = b"" if end_id is None else np.array([end_id], encode.dtype).tobytes()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            out = []
            for name, content in zip(batch.column("doc_id"), batch.column("text")):
                data = encode.encode(content.as_py()) + end
                ids = np.frombuffer(data, encode.dtype).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    own = ids[start : start + capacity]
                    n = len(own)
                    kept = own.tobytes() if with_ids else None
                    out.append((part, row, name.as_py(), piece, start, n, zlib.crc32(own), kept, int(seen[n])))
                    seen[n] += 1
                row += 1
            lists = zip(*out) if out else [[] for _ in columns]
            yield pa.RecordBatch.from_arrays([pa.array(list(v), k) for v, k in zip(lists, kinds)], columns)

    return rows.mapInArrow(cut, PIECES_SCHEMA)


class _Lengths:
    """Counts of the lengths that are left, with neighbours by size."""

    def __init__(self, counts: Mapping[int, int]):
        self.counts = {size: n for size, n in counts.items() if n > 0}
        self.sizes = sorted(self.counts)

    def take(self, size: int, n: int = 1) -> None:
        self.counts[size] -= n
        if not self.counts[size]:
            del self.counts[size]
            del self.sizes[bisect_left(self.sizes, size)]

    def put(self, size: int) -> None:
        if size not in self.counts:
            self.counts[size] = 0
            insort(self.sizes, size)
        self.counts[size] += 1

    def largest_up_to(self, room: int) -> int:
        """The largest length that fits in ``room``, or 0."""
        at = bisect_left(self.sizes, room + 1)
        return self.sizes[at - 1] if at else 0

    def smallest(self, n: int) -> list[int]:
        """The ``n`` smallest pieces' lengths (fewer if fewer are left)."""
        out: list[int] = []
        for size in self.sizes:
            out += [size] * min(self.counts[size], n - len(out))
            if len(out) == n:
                break
        return out


def _dominating_set(size: int, left: _Lengths, capacity: int) -> list[int] | None:
    """Companions that are at least as good as any other choice for a piece of ``size``, or None.

    ``left`` excludes the piece itself.  A set dominates another if the other's pieces can be
    dealt to the set's pieces without any dealt group being longer than its piece.  Known cases,
    for sets of up to two companions: nothing fits; one companion fills the rest exactly; only
    one companion ever fits (the longest wins); at most two fit and the longest one is at least
    as long as any pair; at most two fit and one pair covers all others, piece by piece.
    """
    room = capacity - size
    longest = left.largest_up_to(room)
    if not longest:
        return []
    if longest == room:
        return [longest]
    few = left.smallest(3)
    if len(few) < 2 or few[0] + few[1] > room:
        return [longest]
    if len(few) == 3 and sum(few) <= room:
        return None  # three or more companions may fit: not decided here
    best, shorter = (0, 0, 0), 0
    for a in list(left.sizes):
        if a > room:
            break
        left.take(a)
        b = left.largest_up_to(room - a)
        left.put(a)
        if b >= a:
            best, shorter = max(best, (a + b, b, a)), a
    if longest >= best[0]:
        return [longest]
    # The pair dominates if it covers every single companion and every other pair: its longer
    # piece is the longest of all, and no pair has a longer shorter piece.
    if best[1] == longest and best[2] == shorter:
        return [best[1], best[2]]
    return None


def reduce_by_dominance(counts: Mapping[int, int], capacity: int):
    """``(layouts, rest)``: sequences fixed by dominance, and the counts that are left.

    A layout is ``(lengths, n)``: ``n`` sequences with these lengths.  Longest pieces are tried
    first; equal pieces are fixed together while the same set dominates.  A piece left undecided
    stays a possible companion of later ones.
    """
    left, layouts = _Lengths(counts), []
    for size in sorted(counts, reverse=True):
        while left.counts.get(size, 0):
            left.take(size)
            companions = _dominating_set(size, left, capacity)
            if companions is None:
                left.put(size)
                break
            lengths = [size, *companions]
            need = {s: lengths.count(s) for s in set(lengths)}
            have = {s: left.counts.get(s, 0) + (s == size) for s in need}
            times = min(have[s] // need[s] for s in need)
            for s in need:
                used = times * need[s] - (s == size)
                if used:
                    left.take(s, used)
            layouts.append((lengths, times))
    return layouts, left.counts


def best_fit(counts: Mapping[int, int], capacity: int):
    """Best-fit decreasing on counts: the same sequences as placing the pieces one by one.

    Sequences with one layout are handled together; a length splits at most one such group,
    so the number of layouts stays of the order of the number of lengths.
    """
    groups: dict[int, list[list]] = {}  # room left -> [lengths, how many]
    rooms: list[int] = []

    def add(room: int, lengths: tuple, n: int) -> None:
        if room not in groups:
            groups[room] = []
            insort(rooms, room)
        groups[room].append([lengths, n])

    for size in sorted(counts, reverse=True):
        waiting = counts[size]
        while waiting:
            at = bisect_left(rooms, size)
            if at == len(rooms):
                each = capacity // size
                full, rest = divmod(waiting, each)
                if full:
                    add(capacity - each * size, (size,) * each, full)
                if rest:
                    add(capacity - rest * size, (size,) * rest, 1)
                break
            room = rooms[at]
            lengths, n = groups[room].pop()
            if not groups[room]:
                del groups[room], rooms[at]
            each = room // size
            full, rest = divmod(waiting, each)
            used = min(full, n)
            if used:
                add(room - each * size, (*lengths, *(size,) * each), used)
                waiting -= used * each
            if used < n and 0 < waiting < each:
                add(room - waiting * size, (*lengths, *(size,) * waiting), 1)
                used, waiting = used + 1, 0
            if used < n:
                add(room, lengths, n - used)
    return [(list(lengths), n) for found in groups.values() for lengths, n in found]


class Plan:
    """Places of all pieces: per length, ranks in runs, each run in consecutive sequences."""

    def __init__(self, counts: Mapping[int, int], capacity: int):
        fixed, rest = reduce_by_dominance(counts, capacity)
        layouts = fixed + best_fit(rest, capacity)
        self.fixed_sequences = sum(n for _, n in fixed)
        self.sequences = sum(n for _, n in layouts)
        self.lower_bound = -(-sum(s * n for s, n in counts.items()) // capacity)
        runs: dict[int, list[tuple[int, int, int]]] = {}
        used: dict[int, int] = {}
        first = 0
        for lengths, n in layouts:
            offset = 0
            for size in lengths:
                runs.setdefault(size, []).append((used.get(size, 0), first, offset))
                used[size] = used.get(size, 0) + n
                offset += size
            first += n
        self.runs = {size: np.array(r, np.int64) for size, r in runs.items()}

    def places(self, sizes: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(sequence, offset)`` of the pieces with these lengths and ranks."""
        sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        order = np.argsort(sizes, kind="stable")
        for group in np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1) if len(order) else []:
            runs = self.runs[int(sizes[group[0]])]
            at = np.searchsorted(runs[:, 0], ranks[group], side="right") - 1
            sequence[group] = runs[at, 1] + ranks[group] - runs[at, 0]
            offset[group] = runs[at, 2]
        return sequence, offset


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int | None = 1,
    doc_id: str = "doc_id", text: str = "text", with_ids: bool = False,
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids], part, row)`` per piece.

    Every document is tokenised and packed, rows with equal ids or texts each by themselves
    (``part`` and ``row`` tell them apart).  Sequences are numbered from 0 and gapless inside; all
    are at most ``capacity`` long.  NULL and empty texts are one end id.  An empty table gives an
    empty result, as do empty texts without end id.  Other columns are not looked at.
    """
    pieces = stored(token_pieces(docs, tokenizer, capacity, end_id, doc_id, text, with_ids))
    per_part = stored(pieces.groupBy("part", "length").agg(F.count("*").alias("n")))
    # One row per length, at most ``capacity`` of them.
    histogram = per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()
    plan = Plan({row["length"]: row["n"] for row in histogram}, capacity)
    # A row per task and length; never broadcast, since there are more of them with more tasks.
    before = running_totals(per_part, ["n"], ["length"]).hint("merge")
    ranked = pieces.join(before, ["part", "length"]).withColumn(
        "rank", F.col("n_before") + F.col("rank_in_part")
    )
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "rank", "part", "row"]
    if with_ids:
        names.append("ids")
    chosen = ranked.select(*names)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("length").to_numpy()
            sequence, offset = plan.places(sizes, batch.column("rank").to_numpy())
            keep = [n for n in names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in keep], pa.array(sequence), pa.array(offset)],
                [*keep, "sequence_id", "offset"],
            )

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in chosen.schema if f.name != "rank")
    return chosen.mapInArrow(place, f"{kept}, sequence_id BIGINT, offset BIGINT")
