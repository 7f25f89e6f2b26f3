import random
import re
from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from postsieve.llm import quality
from postsieve.llm.queries import QUERIES

from .conftest import AWKWARD, words


def plain_counts(text):
    found = words(text)
    runs = Counter(zip(found, found[1:], found[2:]))
    inside = {i + k for i in range(len(found) - 2) if runs[tuple(found[i : i + 3])] > 1 for k in range(3)}
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            repeated += line in seen
            seen.add(line)
    n = len(found)
    return (
        n, sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text or "")), repeated, len(inside),
        n < 50 or 100 * len(inside) > 50 * n,
    )


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_base_counts_of_awkward_rows(awkward, empty):
    field = quality.LineField(np.zeros((quality.N_FEATURES, 2)), np.zeros((2, 2)))
    found = quality.judge(awkward, field).select("doc_id", *BASE, "kept")
    expected = Counter((d, *plain_counts(t)) for d, t, _ in AWKWARD)
    assert Counter(tuple(r)[:-1] for r in found.collect()) == expected
    assert all(r.kept == (not r.base_failed) for r in found.collect())  # every line is content
    kept = quality.judge(awkward, field, carry=True)
    assert kept.columns == awkward.columns and kept.count() == sum(not plain_counts(t)[-1] for _, t, _ in AWKWARD)
    assert quality.judge(empty, field).count() == 0


def test_base_counts_of_random_texts(spark):
    rng, field = random.Random(5), quality.LineField(np.zeros((quality.N_FEATURES, 2)), np.zeros((2, 2)))
    texts = ["".join(rng.choices(["a", "b ", " c", "\n", "é#", "\t|", "x y ", "\r\n"], k=rng.randint(0, 300))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    for r in quality.judge(df, field).collect():
        assert tuple(r[c] for c in BASE) == plain_counts(texts[r.doc_id])
        assert len(r.labels) == texts[r.doc_id].count("\n") + 1


def test_viterbi_finds_the_best_labelling():
    rng = np.random.default_rng(6)
    for n in range(1, 8):
        field = quality.LineField(np.zeros((1, 2)), rng.normal(size=(2, 2)))
        scores = rng.normal(size=(n, 2))

        def total(labels):
            steps = sum(field.transitions[a, b] for a, b in zip(labels, labels[1:]))
            return scores[np.arange(n), labels].sum() + steps

        assert total(field.viterbi(scores)) == pytest.approx(max(map(total, map(list, product((0, 1), repeat=n)))))
    assert field.viterbi(np.zeros((0, 2))) == []


def test_expectations_equal_enumeration():
    rng = np.random.default_rng(7)
    lengths = [4, 2, 1]
    features = np.stack([rng.integers(0, w, 7) + f for w, f in zip(quality._WIDTHS, quality._FIRST)], axis=1)
    field = quality.LineField(rng.normal(size=(quality.N_FEATURES, 2)), rng.normal(size=(2, 2)))
    grid = np.full((3, 4), -1)
    for row, (start, n) in enumerate(zip((0, 4, 6), lengths)):
        grid[row, :n] = np.arange(start, start + n)
    found = quality._expectations(field, features, grid, [3, 2, 1, 1])
    expected = np.zeros_like(found)
    for start, n in zip((0, 4, 6), lengths):
        own = features[start : start + n]
        scores, options = field.scores(own), [list(x) for x in product((0, 1), repeat=n)]
        value = [sum(scores[i, a] for i, a in enumerate(x)) + sum(field.transitions[a, b] for a, b in zip(x, x[1:])) for x in options]
        chance = np.exp(value - np.logaddexp.reduce(value))
        for x, p in zip(options, chance):
            for i, a in enumerate(x):
                np.add.at(expected[: quality.N_FEATURES, a], own[i], p)
            for a, b in zip(x, x[1:]):
                expected[quality.N_FEATURES + a, b] += p
    assert np.allclose(found, expected)


def test_held_out_documents_are_judged_as_labelled(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    held_out = F.col("doc_id") % 2 == 0
    field = quality.train_field(docs, labels.where(~held_out))
    judged = quality.judge(docs, field).where("NOT base_failed").join(labels.where(held_out), "doc_id").collect()
    good = [r.kept for r in judged if r.quality == 1]
    bad = [r.kept for r in judged if r.quality == 0]
    assert len(good) > 100 and sum(good) / len(good) >= 0.98
    assert len(bad) > 5 and sum(bad) / len(bad) <= 0.3


def test_without_labels_every_line_is_content(spark, awkward):
    none = spark.createDataFrame([], "doc_id BIGINT, quality INT")
    field = quality.train_field(awkward, none)
    assert field.viterbi(field.scores(np.zeros((3, 10), int))) == [1, 1, 1]


def test_query_rejects_only_what_fails(spark, sf_dir):
    found = QUERIES["op5_line_quality"](spark, sf_dir)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in found.collect():
        assert tuple(r[c] for c in BASE) == plain_counts(texts[r.doc_id])
        assert not (r.kept and r.base_failed)
