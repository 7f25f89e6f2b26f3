import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from postsieve.llm import hard_negatives as hn
from postsieve.llm.queries import QUERIES

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT"


def plain(rows, every=50):
    """Every score of every anchor, sorted."""
    kept, seen = [], set()
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        ints = tuple(math.floor(256 * float(np.float32(x))) for x in vector)
        if (vec_id, label, ints) not in seen:
            seen.add((vec_id, label, ints))
            kept.append((vec_id, label, ints))
    out = []
    for a, (vec_id, label, ints) in enumerate(kept):
        if vec_id is None or vec_id % every:
            continue
        scored = [
            (sum(x * y for x, y in zip(ints, other[2])), other[0], other[1])
            for i, other in enumerate(kept)
            if i != a
        ]
        scored.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        for score, positive, _ in [s for s in scored if s[2] == label][:5]:
            negatives = [s for s in scored if s[2] != label and 50 * score <= 100 * s[0] <= 95 * score]
            for rank, (found, negative, _) in enumerate(negatives[:3], 1):
                out.append((vec_id, positive, rank, negative, score, found))
    return sorted(map(str, out))


def found(df, **options):
    rows = hn.hard_negatives(hn.integer_vectors(df), **options)
    assert rows.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(str(tuple(r)) for r in rows.collect())


def clustered(n, seed, width=6, scale=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, scale) for _ in range(width)] for _ in range(5)]
    return [
        (i, [c + rng.gauss(0, 0.2 * scale) for c in centres[rng.randrange(5)]], rng.randrange(3))
        for i in range(n)
    ]


@pytest.mark.parametrize("group", [3, 4096])
def test_against_all_scores(spark, group):
    rows = clustered(600, 1)
    assert plain(rows, 10)
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(4), every=10, group=group) == plain(rows, 10)


def test_awkward_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        *clustered(60, 2, 3),
        (100, None, 1), (150, [1.0, None, 2.0], 1), (200, [nan, 1.0, 1.0], 0), (250, [1.0, inf, 0.0], 0),
        (300, [0.5, 0.25, 0.125], None), (None, [0.5, 0.5, 0.5], 1), (None, [0.5, 0.5, 0.5], 2),
        (350, [0.0, 0.0, 0.0], 1), (400, [], 2), (450, [0.7], 0), (500, [1.5] * 5, 1),
        (550, [0.3, 0.1, 0.2], 0), (550, [0.3, 0.1, 0.2], 0), (550, [0.3, 0.1, 0.2], 1), (550, [0.1, 0.9, 0.2], 0),
        *[(600 + i, [0.5, 0.5, 0.5], 0) for i in range(12)],  # ties
        *[(700 + i, [0.3, 0.4, 0.4], 2) for i in range(12)],
        (-50, [0.2, 0.6, 0.1], 2),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    clashing = ["row_key", "norm", "angles", "place", "score", "rank", "vector", "ints", "id"]
    df = df.select("*", *[F.lit("x").alias(c) for c in clashing]).repartition(3)
    assert found(df) == plain(rows)


def test_many_repeats_of_one_row(spark):
    rows = [*clustered(80, 3), *[(1000, [0.5] * 6, 0)] * 400]
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(5)) == plain(rows)


def test_large_components(spark):
    rows = clustered(120, 4, scale=1e6)
    assert found(spark.createDataFrame(rows, SCHEMA), every=10) == plain(rows, 10)


def test_empty_table(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []


def test_bounds_hold():
    rng = np.random.default_rng(5)
    for _ in range(50):
        a, x = (np.floor(rng.normal(0, 40, (n, 5))).astype(np.int64) for n in (30, 20))
        references = hn._directions(x[:4])[0]
        (norms, angles), (x_norms, x_angles) = hn.angles_to(a, references), hn.angles_to(x, references)
        low, high = hn.score_bounds(norms, angles, x_norms, x_angles)
        scores = a @ x.T
        assert (scores.min(axis=1) >= low).all() and (scores.max(axis=1) <= high).all()


def test_query_against_all_scores(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    moved = [(i, v, (l + 1) % 10 if i is not None and i % 7 == 0 and l is not None else l) for i, v, l in rows]
    query = QUERIES["op11_hard_negatives"](spark, sf_dir)
    assert sorted(str(tuple(r)) for r in query.collect()) == plain(moved)
