import random

import pytest
from pyspark.sql import functions as F

from postsieve.llm import suffix_dedup

from .conftest import AWKWARD, CLASHING, rows_of


def plain(rows, length):
    """Every string of every document."""
    first = {}
    texts = [(i, (text or "").encode()) for i, text, *_ in rows]
    key = lambda i: (i is None, i or 0)
    for doc_id, text in texts:
        for p in range(len(text) - length + 1):
            s = text[p : p + length]
            first[s] = min(first.get(s, key(doc_id)), key(doc_id))
    out = []
    for doc_id, text in texts:
        covered = bytearray(len(text))
        for p in range(len(text) - length + 1):
            if first[text[p : p + length]] < key(doc_id):
                covered[p : p + length] = b"\1" * length
        edges = [p for p in range(len(text) + 1) if (p < len(text) and covered[p]) != (p > 0 and covered[p - 1] == 1)]
        spans = list(zip(edges[::2], edges[1::2]))
        out.append((doc_id, len(text), spans, bytes(b for b, c in zip(text, covered) if not c)))
    return sorted(map(str, out))


def found(docs, length, **options):
    rows = suffix_dedup.repeated_strings(docs, length, **options).collect()
    return sorted(str((r[0], r[1], [tuple(s) for s in r[2]], bytes(r[3]))) for r in rows)


@pytest.mark.parametrize("length", [1, 2, 7, 12, 50, 80])
def test_cover_takes_any_two_positions_into_it(length):
    v = suffix_dedup.modulus(length)
    chosen = set(suffix_dedup.difference_cover(v))
    assert all(any((a + s) % v in chosen and (b + s) % v in chosen for s in range(v)) for a in range(v) for b in range(v))
    assert 1 <= length - v + 1


@pytest.mark.parametrize("length,chunk", [(7, 200), (12, 2_000), (50, 3_000), (12, 1 << 20)])
def test_random_texts_with_shared_pieces(spark, length, chunk):
    rng = random.Random(length + chunk)
    shared = ["".join(rng.choices("abcdé ", k=rng.randrange(length - 3, 3 * length))) for _ in range(8)]
    rows = []
    for i in range(90):
        parts = [rng.choice(shared) if rng.random() < 0.5 else "".join(rng.choices("abcdé ", k=rng.randrange(40))) for _ in range(6)]
        rows.append((rng.choice([i, i, i % 7, None]) if i % 9 == 0 else i, "".join(parts), "s"))
    docs = rows_of(spark, rows).repartition(4)
    assert found(docs, length, chunk=chunk) == plain(rows, length)


def test_overlapping_and_touching_strings(spark):
    a, b = "0123456789", "abcdefghij"
    rows = [(1, a + "x" + b, "s"), (2, a + b, "s"), (3, a + b + a, "s"), (4, "1234567890", "s"), (5, "zz" + a, "s")]
    assert found(rows_of(spark, rows), 10) == plain(rows, 10)


def test_one_id_with_most_of_the_text(spark):
    rows = [(5, f"{'same words again and again ' * 20}{i}", "s") for i in range(60)]
    rows += [(i, f"{'same words again and again ' * 3}{i}", "s") for i in range(4)]
    rows += [(9, rows[0][1], "s"), (None, rows[1][1], "s")]
    assert found(rows_of(spark, rows).repartition(5), 20, chunk=4_000) == plain(rows, 20)


def test_awkward_rows(awkward):
    assert found(awkward, 12) == plain(AWKWARD, 12)
    assert found(awkward, 50, chunk=5_000) == plain(AWKWARD, 50)


def test_repetitive_text(spark):
    rows = [(1, "a" * 30_000, "s"), (2, "a" * 100_000 + "b", "s"), (3, "ab" * 20_000, "s")]
    got = suffix_dedup.repeated_strings(rows_of(spark, rows)).orderBy("doc_id").collect()
    assert [[tuple(s) for s in r["spans"]] for r in got] == [[], [(0, 100_000)], []]
    assert [bytes(r["kept"]) for r in got] == [b"a" * 30_000, b"b", b"ab" * 20_000]


def test_empty_table(empty):
    assert found(empty.select("doc_id", "text", *CLASHING), 50) == []


def test_texts_travel_once(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = suffix_dedup.repeated_strings(docs.where(F.col("doc_id") >= 0))
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    assert final.count("ReusedExchange") >= 2 and final.count("MapInArrow pack") == 1
