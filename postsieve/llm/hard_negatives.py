"""Hard negatives by exact search, with angular triangle filtering.

Every vector is stored with its norm and its angles to a few reference directions.  The angle
between an anchor and a vector lies between the difference and the sum of their angles to any
reference, so its cosine lies in an interval, which times both norms bounds the score.  Vectors are
taken in small blocks of like angles; a block is scored (in integers) for those anchors only whose
bounds overlap the window of scores they still look for.

Anchors are taken in groups of fixed size, each sent to all executors, which scan the stored
vectors: no vector is shuffled for the search, and a task returns a few rows for each anchor.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postsieve.llm.common import stored

#: Reference directions: vectors of the table itself, those with the smallest hashes.
REFERENCES = 8
#: Anchors that are searched for at a time; what is sent to the executors is this many vectors.
ANCHORS = 4096
#: Vectors of a block, which are scored together or not at all.
ROWS = 128
#: Pairs that a task holds before it sorts out the best ones.
PENDING = 200_000
#: Relative error that angles and norms may have; bounds are widened by it.
SLACK = 1e-6
_FIXED = "vec_id BIGINT, label BIGINT, row_key BIGINT, vector BINARY, norm DOUBLE, angles ARRAY<DOUBLE>"


def _matrix(blobs: pa.Array) -> np.ndarray:
    """Integer vectors as rows; shorter ones are filled up with zeros."""
    rows = [np.frombuffer(b.as_buffer(), np.int64) for b in blobs]
    width = max((len(r) for r in rows), default=0)
    if all(len(r) == width for r in rows):
        return np.concatenate(rows).reshape(len(rows), width) if rows else np.zeros((0, 0), np.int64)
    out = np.zeros((len(rows), width), np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of all rows of ``a`` with all rows of ``b``."""
    width = min(a.shape[1], b.shape[1])  # what one side lacks counts as zero
    a, b = a[:, :width], b[:, :width]
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = float(np.abs(a.astype(float)).max()) * float(np.abs(b.astype(float)).max()) * width
    if most < 2**53:  # every partial sum is an integer that a double holds
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return exact.astype(np.int64)  # raises OverflowError where a score does not fit


def _directions(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    norms = np.sqrt((vectors.astype(float) ** 2).sum(axis=1))
    return vectors / np.where(norms > 0, norms, 1.0)[:, None], norms


def angles_to(vectors: np.ndarray, references: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(norms, angles)``; a vector without length stands at a right angle to all references."""
    units, norms = _directions(vectors)
    width = min(units.shape[1], references.shape[1])
    return norms, np.arccos(np.clip(units[:, :width] @ references[:, :width].T, -1, 1))


def score_bounds(
    norms: np.ndarray, angles: np.ndarray, block_norms: np.ndarray, block_angles: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Per anchor the least and the greatest score that it may have with any vector of the block.

    Arccosines are least exact near 0 and pi, by about the square root of a double's error; the
    slack is far above that.
    """
    low, high = block_angles.min(axis=0), block_angles.max(axis=0)
    nearest = np.maximum(np.maximum(low - angles, angles - high), 0).max(axis=1, initial=0.0)
    farthest = np.minimum(angles + high, 2 * np.pi - angles - low).min(axis=1, initial=np.pi)
    top = np.cos(np.maximum(nearest - SLACK, 0))
    bottom = np.cos(np.minimum(farthest + SLACK, np.pi))
    short, long = norms * block_norms.min(), norms * block_norms.max()
    slack = long * SLACK + 1
    return np.where(bottom < 0, long, short) * bottom - slack, np.where(top < 0, short, long) * top + slack


def described(vectors: DataFrame, references: int = REFERENCES) -> DataFrame:
    """``(vec_id, label, row_key, vector, norm, angles)`` of ``(vec_id, label, ints)``, written."""
    rows = vectors.withColumn("row_key", F.xxhash64("vec_id", "label", "ints"))
    rows = stored(rows.dropDuplicates(["vec_id", "row_key"]))
    chosen = [r["ints"] for r in rows.orderBy("row_key").limit(references).collect()]
    width = max((len(x) for x in chosen), default=0)
    directions = _directions(np.array([x + [0] * (width - len(x)) for x in chosen], float).reshape(len(chosen), width))[0]

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ints")
            blobs = pa.array([np.asarray(x.values, np.int64).tobytes() for x in lists], pa.binary())
            norms, angles = angles_to(_matrix(blobs), directions)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in ("vec_id", "label", "row_key")],
                    blobs,
                    pa.array(norms),
                    pa.array(list(angles), pa.list_(pa.float64())),
                ],
                [x.split()[0] for x in _FIXED.split(", ")],
            )

    return stored(rows.mapInArrow(describe, _FIXED))


class _Best:
    """The first ``most`` vectors of each place: by score, greatest first, then by id, NULL last."""

    def __init__(self, places: int, most: int):
        self.most = most
        self.least = np.full(places, np.iinfo(np.int64).min)  # scores below cannot be among them
        self.held: list[np.ndarray] = []
        self.pending = 0

    def add(self, place: np.ndarray, score: np.ndarray, vec_id: np.ndarray, no_id: np.ndarray) -> None:
        if len(place):
            self.held.append(np.stack((place, score, no_id, vec_id), axis=1))
            self.pending += len(place)
        if self.pending > PENDING:
            self.sort()

    def sort(self) -> np.ndarray:
        table = np.concatenate(self.held) if self.held else np.zeros((0, 4), np.int64)
        table = table[np.lexsort((table[:, 3], table[:, 2], -table[:, 1], table[:, 0]))]
        first = np.searchsorted(table[:, 0], table[:, 0])
        table = table[np.arange(len(table)) - first < self.most]
        place, at, times = np.unique(table[:, 0], return_index=True, return_counts=True)
        full = times == self.most
        self.least[place[full]] = table[at[full] + self.most - 1, 1]
        self.held, self.pending = [table], 0
        return table


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    """``(ids, no id, labels, keys, vectors, norms, angles)`` of a batch's vectors, like angles together."""
    if not batch.num_rows:
        return
    ids = batch.column("vec_id")
    no_id = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
    ids = ids.fill_null(0).to_numpy()
    labels, keys, norms = (batch.column(c).to_numpy() for c in ("label", "row_key", "norm"))
    vectors = _matrix(batch.column("vector"))
    angles = np.array(batch.column("angles").to_pylist(), float).reshape(len(ids), -1)
    near = angles.argmin(axis=1) if angles.shape[1] else np.zeros(len(ids), np.int64)
    own = angles.min(axis=1, initial=np.pi)
    order = np.lexsort((own, near, labels))
    for begin in range(0, len(order), ROWS):
        at = order[begin : begin + ROWS]
        yield ids[at], no_id[at], labels[at], keys[at], vectors[at], norms[at], angles[at]


def _search(rows: DataFrame, places: int, most: int, pairs: Callable) -> DataFrame:
    """The first ``most`` vectors of each place over all tasks: ``(place, score, no_id, id)`` and ``rank``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(places, most)
        for batch in batches:
            for block in _blocks(batch):
                best.add(*pairs(block, best.least))
        table = best.sort()
        names = ["place", "score", "no_id", "id"]
        yield pa.RecordBatch.from_arrays([pa.array(table[:, i]) for i in range(4)], names)

    found = rows.mapInArrow(scan, "place BIGINT, score BIGINT, no_id BIGINT, id BIGINT")
    order = Window.partitionBy("place").orderBy(F.desc("score"), "no_id", "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _group_negatives(
    rows: DataFrame, anchors: list, n_positives: int, n_negatives: int, window: tuple[int, int, int]
) -> DataFrame:
    """The result for one group of anchors."""
    spark = rows.sparkSession
    low, high, of = window
    ids, labels, keys = (np.array([r[c] for r in anchors], np.int64) for c in ("vec_id", "label", "row_key"))
    vectors = _matrix(pa.array([bytes(r["vector"]) for r in anchors], pa.binary()))
    norms = np.array([r["norm"] for r in anchors])
    angles = np.array([r["angles"] for r in anchors], float).reshape(len(anchors), -1)
    sent = spark.sparkContext.broadcast((labels, keys, ids, vectors, norms, angles))

    def like(block, least):
        labels, keys, ids, vectors, norms, angles = sent.value
        x_ids, no_id, x_labels, x_keys, x_vectors, x_norms, x_angles = block
        top = score_bounds(norms, angles, x_norms, x_angles)[1]
        wanted = np.flatnonzero(np.isin(labels, x_labels) & (top >= least))
        scores = products(vectors[wanted], x_vectors)
        good = (labels[wanted][:, None] == x_labels) & (scores >= least[wanted][:, None])
        itself = (keys[wanted][:, None] == x_keys) & (ids[wanted][:, None] == x_ids) & (no_id == 0)
        a, x = np.nonzero(good & ~itself)
        return wanted[a], scores[a, x], x_ids[x], no_id[x]

    positives = _search(rows, len(anchors), n_positives, like).orderBy("place", "rank").collect()
    # A place of the second search is a positive of an anchor: n_positives for each anchor at most.
    anchor = np.array([r["place"] for r in positives], np.int64)
    floor = [-(-low * r["score"] // of) for r in positives]
    ceiling = [high * r["score"] // of for r in positives]
    windows = spark.sparkContext.broadcast((anchor, np.array(floor, np.int64), np.array(ceiling, np.int64)))

    def unlike(block, least):
        labels, _, _, vectors, norms, angles = sent.value
        anchor, floor, ceiling = windows.value
        x_ids, no_id, x_labels, _, x_vectors, x_norms, x_angles = block
        bottom, top = score_bounds(norms, angles, x_norms, x_angles)
        floor = np.maximum(floor, least)
        # Windows that the block's scores may reach.
        place = np.flatnonzero((floor <= ceiling) & (top[anchor] >= floor) & (bottom[anchor] <= ceiling))
        wanted, owner = np.unique(anchor[place], return_inverse=True)
        scores = products(vectors[wanted], x_vectors)
        different = labels[wanted][:, None] != x_labels
        out = []
        for begin in range(0, len(place), ANCHORS):
            part = slice(begin, begin + ANCHORS)
            row = owner[part]
            good = scores[row] >= floor[place[part]][:, None]
            good &= scores[row] <= ceiling[place[part]][:, None]
            w, x = np.nonzero(good & different[row])
            out.append((place[part][w], scores[row[w], x], x_ids[x], no_id[x]))
        if not out:
            return tuple(np.zeros(0, np.int64) for _ in range(4))
        return tuple(np.concatenate(c) for c in zip(*out))

    found = _search(rows, len(positives), n_negatives, unlike)
    named = [
        (i, anchors[r["place"]]["vec_id"], None if r["no_id"] else r["id"], r["score"])
        for i, r in enumerate(positives)
    ]
    schema = "place BIGINT, anchor_id BIGINT, positive_id BIGINT, positive_score BIGINT"
    return found.join(F.broadcast(spark.createDataFrame(named, schema)), "place").select(
        "anchor_id",
        "positive_id",
        "rank",
        F.when(F.col("no_id") == 0, F.col("id")).alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def integer_vectors(
    embeddings: DataFrame, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding", scale: int = 256
) -> DataFrame:
    """``(vec_id, label, ints)``: components as the floor of ``scale`` times their value.

    Rows without a label, a vector, or with a component that is NULL, NaN or infinite are left out.
    """
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    kept = embeddings.where(F.col(label).isNotNull() & F.col(vector).isNotNull() & finite)
    return kept.select(
        F.col(vec_id).cast("bigint").alias("vec_id"),
        F.col(label).cast("bigint").alias("label"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * scale)).alias("ints"),
    )


def hard_negatives(
    vectors: DataFrame, every: int = 50, n_positives: int = 5, n_negatives: int = 3,
    window: tuple[int, int, int] = (50, 95, 100), group: int = ANCHORS,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` of ``(vec_id, label, ints)``.

    Anchors are the rows whose id ``every`` divides.  A score is the integer inner product with the
    anchor; higher ones come first, ties by smaller id, NULL ids last.  An anchor's positives are its
    first ``n_positives`` other rows of its label.  For each, the first ``n_negatives`` rows of other
    labels are returned whose score lies in ``window``: ``window[0]`` to ``window[1]`` parts of
    ``window[2]`` of the positive's score, both ends included.

    All rows are searched, exactly.  Rows that repeat id, label and vector are one row; rows that
    only repeat the id are rows of their own.  A row with a NULL id is no anchor.  Shorter vectors
    count as filled up with zeros, a vector without components scores 0.  Scores that do not fit 64
    bits fail the job.  An empty table gives an empty result; other columns are not looked at.
    """
    rows = described(vectors)
    anchors = rows.where(F.col("vec_id") % every == 0)
    empty = rows.sparkSession.createDataFrame(
        [], "anchor_id BIGINT, positive_id BIGINT, rank INT, negative_id BIGINT, positive_score BIGINT, negative_score BIGINT"
    )
    out, some = empty, []
    ordered = stored(anchors.orderBy("vec_id", "row_key"))

    def searched(out: DataFrame) -> DataFrame:
        return out.union(stored(_group_negatives(rows, some, n_positives, n_negatives, window)))

    for row in ordered.toLocalIterator():  # a group of anchors at a time, never all of them
        some.append(row)
        if len(some) == group:
            out, some = searched(out), []
    return searched(out) if some else out
