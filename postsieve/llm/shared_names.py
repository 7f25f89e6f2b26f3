"""In how many places names occur, counted over all chunks: asked and answered in blocks.

Each chunk sends its ascending, distinct names with their counts, one block per range of names; the blocks
of a range are merged in one task, and each chunk gets the sums of its own names back.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from postsieve.llm.sorted_numbers import grouped, packed_counts, packed_names, unpacked_counts, unpacked_names

COUNTS = "chunk BIGINT, bucket BIGINT, n BIGINT, names BINARY, counts BINARY"
SUMS = "chunk BIGINT, bucket BIGINT, n BIGINT, counts BINARY"


def send_counts(chunk: int, names: np.ndarray, counts: np.ndarray, bits: int, buckets: int) -> pa.Table:
    """Rows of ``COUNTS`` for ascending names of so many bits."""
    width = np.uint64(((1 << bits) - 1) // buckets + 1 if bits < 64 or buckets > 1 else (1 << 64) - 1)
    bucket = np.minimum(names // width, np.uint64(buckets - 1)).astype(np.int64)
    new = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist()
    cuts = list(zip(new, [*new[1:], len(names)]))
    return pa.table(
        [
            pa.array([chunk] * len(cuts), pa.int64()),
            pa.array([int(bucket[a]) for a, _ in cuts], pa.int64()),
            pa.array([b - a for a, b in cuts], pa.int64()),
            pa.array([packed_names(names[a:b]) for a, b in cuts], pa.binary()),
            pa.array([packed_counts(counts[a:b]) for a, b in cuts], pa.binary()),
        ],
        names=["chunk", "bucket", "n", "names", "counts"],
    )


def summed(names: DataFrame) -> DataFrame:
    """Rows of ``SUMS``: for each block of names, their counts in all chunks together."""

    def add(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        every = np.concatenate([unpacked_names(r["names"], r["n"]) for r in rows])
        counts = np.concatenate([unpacked_counts(r["counts"], r["n"]) for r in rows])
        order, group, first = grouped(every)
        sums = np.empty(len(every), np.int64)
        sums[order] = np.add.reduceat(counts[order], first)[group]
        ends = np.cumsum([r["n"] for r in rows])
        return pa.table(
            [
                *[pa.array([r[c] for r in rows], pa.int64()) for c in ("chunk", "bucket", "n")],
                pa.array([packed_counts(sums[e - r["n"] : e]) for e, r in zip(ends, rows)], pa.binary()),
            ],
            names=["chunk", "bucket", "n", "counts"],
        )

    return names.groupBy("bucket").applyInArrow(add, SUMS)


def read_sums(reply: pa.Table, n: int) -> np.ndarray:
    """The sums of the ``n`` names that a chunk has sent, in their order."""
    rows = sorted(reply.to_pylist(), key=lambda r: r["bucket"])
    sums = [np.zeros(0, np.int64), *[unpacked_counts(r["counts"], r["n"]) for r in rows]]
    out = np.concatenate(sums)
    if len(out) != n:
        raise ValueError(f"{len(out)} sums for {n} names")
    return out
