import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from postsieve.llm import exact_dedup, mixing, sharding
from postsieve.llm.queries import ORACLES, QUERIES

from .conftest import AWKWARD, CLASHING, SPACES, rows_of


def compared(spark, sf_dir, name):
    duck = duckdb.connect()
    for name_ in ("documents", "embeddings"):
        duck.sql(f"CREATE VIEW {name_} AS SELECT * FROM '{sf_dir}/{name_}.parquet'")
    found = QUERIES[name](spark, sf_dir)
    expected = duck.sql(ORACLES[name])
    columns = sorted(found.columns)
    assert columns == sorted(expected.columns)
    rounded = lambda rows: sorted(
        str([round(v, 9) if isinstance(v, float) else v for v in row]) for row in rows
    )
    return rounded(map(tuple, found.select(columns).collect())), rounded(
        expected.select(*columns).fetchall()
    )


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    found, expected = compared(spark, sf_dir, name)
    assert found == expected


# --- exact dedup ---------------------------------------------------------------------


def plain_groups(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[re.sub(SPACES, " ", text or "")].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), i == keep, digest) for i in ids]
    return Counter(out)


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_exact_groups_of_awkward_rows(awkward, limit):
    found = exact_dedup.exact_duplicates(awkward, broadcast_groups=limit, prefix=4, digest=True)
    assert Counter(map(tuple, found.collect())) == plain_groups(AWKWARD)


def test_one_row_of_each_group_stays(awkward):
    kept = exact_dedup.distinct_documents(awkward)
    assert kept.columns == awkward.columns
    texts = Counter(re.sub(SPACES, " ", r.text or "") for r in kept.collect())
    assert set(texts.values()) == {1} and len(texts) == len({k for k in map(lambda r: re.sub(SPACES, " ", r[1] or ""), AWKWARD)})


def test_exact_groups_of_an_empty_table(empty):
    assert exact_dedup.exact_duplicates(empty).count() == 0


# --- mixing ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def many(spark):
    source = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 30 == 1, "rare").otherwise("plain")
    return spark.range(30_000).select(
        F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"), source.alias("source")
    )


def test_mixture_has_the_target_weights(many):
    weights = {"hot": 0.2, "rare": 0.3, "plain": 0.5}
    found = mixing.mix_sources(many, weights, seed=1).cache()
    n = found.count()
    assert abs(n - 30_000) < 900
    shares = {r.source: r["count"] / n for r in found.groupBy("source").count().collect()}
    assert all(abs(shares[s] - w) < 0.02 for s, w in weights.items())
    per_doc = found.groupBy("doc_id").agg(F.count("*").alias("n"), F.max("mix_count").alias("m"), F.max("mix_copy").alias("c"))
    assert per_doc.where("n <> m OR c <> m - 1").count() == 0
    # Counts are Poisson: the variance over all documents, dropped ones too, is the mean.
    rare = [r.n for r in per_doc.join(many, "doc_id").where("source = 'rare'").collect()]
    n_rare = many.where("source = 'rare'").count()
    mean = sum(rare) / n_rare
    variance = sum((x - mean) ** 2 for x in rare) / n_rare + mean**2 * (1 - len(rare) / n_rare)
    assert abs(mean - 9) < 0.6 and abs(variance / mean - 1) < 0.2
    found.unpersist()


def test_large_means_are_sums_of_draws(many):
    found = mixing.mix_sources(many.where("source = 'rare'").limit(500), epochs=100.0, seed=2)
    counts = [r.m for r in found.groupBy("doc_id").agg(F.max("mix_count").alias("m")).collect()]
    assert len(counts) == 500 and abs(sum(counts) / 500 - 100) < 3


def test_mixing_is_repeatable_and_shuffled(many):
    a = [(r.doc_id, r.mix_copy) for r in mixing.mix_sources(many, seed=3, partitions=2).collect()]
    assert a == [(r.doc_id, r.mix_copy) for r in mixing.mix_sources(many.repartition(7), seed=3, partitions=2).collect()]
    assert [x for x, _ in a] != sorted(x for x, _ in a)


def test_mixing_awkward_rows(awkward, empty):
    found = mixing.mix_sources(awkward, epochs=50.0)
    assert set(found.columns) == set(awkward.columns) | {"mix_rate", "mix_copy", "mix_key"}
    counts = Counter((r.doc_id, r.text) for r in found.collect())
    assert set(counts) == {(d, t) for d, t, _ in AWKWARD}
    assert {r.source for r in found.select("source").distinct().collect()} == {"a", "b", "c", None}
    assert mixing.mix_sources(empty).count() == 0
    assert mixing.mix_sources(awkward, {"b": 1.0}).where("source IS NULL OR source <> 'b'").count() == 0


def test_mixing_runs_no_python(many):
    plan = mixing.mix_sources(many)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# --- sharding -----------------------------------------------------------------------------


@pytest.mark.parametrize("n_shards", [1, 3, 8])
def test_shards_are_contiguous_balanced_and_gapless(spark, sf_dir, n_shards):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = sharding.shards_by_bytes(sharding.document_sizes(docs), n_shards).orderBy("doc_id").collect()
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    assert [(r.doc_id, r.size, r.text_crc32) for r in found] == [
        (d, len(texts[d]) + 1, zlib.crc32(texts[d])) for d in sorted(texts)
    ]
    assert [r.shard for r in found] == sorted(r.shard for r in found)
    total, biggest = sum(r.size for r in found), max(r.size for r in found)
    so_far = 0
    for r in found:
        assert r.shard == min((2 * so_far + r.size) * n_shards // (2 * total), n_shards - 1)
        so_far += r.size
    for shard in range(n_shards):
        own = [r for r in found if r.shard == shard]
        assert [r.slot for r in own] == list(range(len(own)))
        assert abs(sum(r.size for r in own) - total / n_shards) <= biggest


def test_shards_of_awkward_rows(awkward, empty):
    found = sharding.shards_by_bytes(sharding.document_sizes(awkward), 4).collect()
    assert Counter(r.doc_id for r in found) == Counter(d for d, *_ in AWKWARD)
    for shard in {r.shard for r in found}:
        assert sorted(r.slot for r in found if r.shard == shard) == list(range(sum(r.shard == shard for r in found)))
    assert sharding.shards_by_bytes(sharding.document_sizes(empty), 4).count() == 0
    clashing = sharding.document_sizes(rows_of(awkward.sparkSession, AWKWARD[:2], CLASHING))
    assert clashing.columns == ["doc_id", "size", "text_crc32"]
