import random
from collections import Counter

import pytest

from postsieve.llm import near_join
from postsieve.llm.graph import components

from .conftest import AWKWARD, rows_of, words


def plain_components(rows, n, share):
    """Smallest id by links, per row, by comparing all pairs."""
    sets = []
    for _, text, *_ in rows:
        w = words(text, lower=True)
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and share[1] * len(sets[i] & sets[j]) >= share[0] * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (doc_id, *_) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids) if ids else None))
    return Counter(out)


def found_components(df, n, share):
    found = near_join.near_duplicates(df, n, share).select("doc_id", "n_shingles", "component_id")
    return Counter(map(tuple, found.collect()))


def family_rows(seed, size=120):
    """Families of copies with random edits around the threshold, and texts with shared passages."""
    rng = random.Random(seed)
    fresh = lambda n: [f"w{rng.randint(0, 5000)}" for _ in range(n)]
    passage, rows = fresh(40), []
    for base in [fresh(60) for _ in range(3)]:
        for _ in range(size // 3):
            text = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
                text[rng.randrange(len(text))] = fresh(1)[0]
            rows.append(text)
    for _ in range(20):
        rows.append(fresh(rng.randint(1, 30)) + passage)
    return [(i, " ".join(text), "a") for i, text in enumerate(rows)]


@pytest.mark.parametrize("small_group, block, chunk", [(2, 16, 500), (16, 256, 1_000_000)])
@pytest.mark.parametrize("n, share", [(4, (85, 100)), (5, (80, 100))])
def test_families_equal_comparing_all_pairs(spark, monkeypatch, small_group, block, chunk, n, share):
    monkeypatch.setattr(near_join, "SMALL_GROUP", small_group)
    monkeypatch.setattr(near_join, "BLOCK_CLASSES", block)
    monkeypatch.setattr(near_join, "TILE", block // 4)
    for name in ("CHUNK", "COUNTED", "FLUSH_BYTES"):
        monkeypatch.setattr(near_join, name, chunk)
    rows = family_rows(small_group + n)
    assert found_components(rows_of(spark, rows), n, share) == plain_components(rows, n, share)


def test_awkward_rows(awkward, empty):
    assert found_components(awkward, 4, (85, 100)) == plain_components(AWKWARD, 4, (85, 100))
    assert near_join.near_duplicates(empty).count() == 0


def test_one_document_of_each_group_stays(awkward):
    kept = near_join.distinct_documents(awkward, 4, (85, 100))
    assert kept.columns == awkward.columns
    ids = sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect())
    assert ids == [1, 3, 4, 5, 6, 7, 9, 9, 10, 11, 12]


def test_one_row_of_a_component_stays_whatever_its_ids(spark):
    base = [f"w{i}" for i in range(100)]
    edited = " ".join([*base[:-1], "other"])
    rows = [(1, " ".join(base), "a"), (1, edited, "b"), (2, " ".join(base), "c"), (1, edited, "b"),
            (None, "x " + " ".join(f"n{i}" for i in range(90)), "d"), (None, " ".join(f"n{i}" for i in range(90)), "d"),
            (5, None, "e"), (5, "", "e"), (None, " ", "e")]
    kept = near_join.distinct_documents(rows_of(spark, rows, ["row_key", "group", "k1", "__row"]))
    found = sorted((r.doc_id or 0, r.text is None, len(r.text or "")) for r in kept.collect())
    assert [f[0] for f in found] == [0, 0, 1, 5, 5]
    assert kept.columns == ["doc_id", "text", "source", "row_key", "group", "k1", "__row"]


def test_unlike_classes_that_share_a_member_are_not_paired(spark, monkeypatch):
    """A phrase in every text is in no prefix: the others' n-grams are rarer."""
    seen = []
    real = near_join.block_links
    monkeypatch.setattr(near_join, "block_links", lambda groups, *rest: seen.append(groups.count()) or real(groups, *rest))
    phrase = "one phrase that all of them have in common"
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(12)) + " " + phrase, "a") for i in range(20_000)]
    rows += [(30_000, rows[7][1] + " end", "a")]
    found = near_join.near_duplicates(rows_of(spark, rows).repartition(8), 4, (85, 100))
    linked = [r for r in found.collect() if r.doc_id != r.component_id]
    assert [(r.doc_id, r.component_id) for r in linked] == [(30_000, 7)]
    assert seen == [0]


def test_matches_vary_with_the_counts(spark):
    texts = rows_of(spark, family_rows(3, 240)).select("text")
    found = near_join.open_classes(texts, 4, 20_000, (85, 100)).collect()
    assert len({r.matches for r in found}) > 3
    for r in found:
        assert len(r.members) >= -(-85 * r.n // 100) and set(r.prefix) <= set(r.members)


def test_more_matches_are_asked_where_lists_are_long():
    import numpy as np

    assert near_join.choose_matches(np.ones(100, np.int64), 100, 85) == 1
    crowded = np.concatenate((np.ones(5), np.full(95, 1000))).astype(np.int64)
    assert near_join.choose_matches(crowded, 100, 85) > 2


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3)]
    found = components(spark.createDataFrame(edges, "a BIGINT, b BIGINT")).collect()
    assert {r.node: r.component for r in found} == {
        **{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}
    }
