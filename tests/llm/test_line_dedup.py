import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from postsieve.llm import line_dedup

from .conftest import AWKWARD, CLASHING, PROSE, rows_of, words


def test_patience_matches_ascend_and_are_equal():
    rng = random.Random(0)
    for _ in range(500):
        a, b = ([rng.randint(0, rng.choice([3, 12, 40])) for _ in range(rng.randint(0, 30))] for _ in range(2))
        found = line_dedup.patience_matches(a, b)
        assert all(a[i] == b[j] for i, j in found)
        assert all(i < k and j < m for (i, j), (k, m) in zip(found, found[1:]))
    assert line_dedup.patience_matches([1, 2, 3], [1, 2, 3]) == [(0, 0), (1, 1), (2, 2)]
    # Unique lines anchor a moved block of which only one order can be kept.
    assert line_dedup.patience_matches([9, 1, 2, 8], [1, 2, 9, 7]) == [(1, 0), (2, 1)]


def removed_lines(row):
    return [i for span in row.removed or [] for i in range(span.start, span.end)]


def corpus(seed):
    rng = random.Random(seed)
    pool = [" ".join(f"v{rng.randint(0, 50)}" for _ in range(rng.randint(0, 9))) for _ in range(60)]
    rows = []
    for i in range(120):
        if rows and rng.random() < 0.5:
            text = rng.choice(rows)[1].split("\n")
            at = rng.randrange(len(text) + 1)
            text = text[:at] + rng.sample(pool, 2) + text[at + rng.randint(0, 3) :]
        else:
            text = [rng.choice(pool) if rng.random() < 0.3 else f"own {i} {k} words here" for k in range(rng.randint(1, 15))]
        rows.append((i, "\n".join(text), "a"))
    return rows


def test_every_long_line_survives_somewhere(spark):
    rows = corpus(3)
    left = defaultdict(int)
    for r in line_dedup.dedup_lines(rows_of(spark, rows), min_words=4).collect():
        for line in r.text.split("\n"):
            left[tuple(words(line))] += 1
    assert all(left[tuple(words(x))] for _, text, _ in rows for x in text.split("\n"))


def test_awkward_rows(awkward, empty):
    found = line_dedup.dedup_lines(awkward)
    assert set(found.columns) == set(awkward.columns) | {"n_lines", "removed_words"}
    rows = found.collect()
    assert Counter(r.doc_id for r in rows) == Counter(d for d, *_ in AWKWARD)
    texts = {(d, t) for d, t, _ in AWKWARD}
    assert all((r.doc_id, r.text) in texts for r in rows)  # nothing repeats whole lines of 20 words
    assert line_dedup.dedup_lines(empty).count() == 0


def test_copies_lose_everything_and_repeated_rows_agree(spark):
    rows = [(5, PROSE, "a"), (6, PROSE + "\nand more", "a"), (6, PROSE + "\nand more", "a"), (None, PROSE, "a")]
    found = line_dedup.dedup_lines(rows_of(spark, rows, CLASHING)).orderBy(F.col("doc_id").asc_nulls_last())
    assert [(r.doc_id, r.text) for r in found.collect()] == [(5, PROSE), (6, "and more"), (6, "and more"), (None, "")]


def brute_force(rows, min_words):
    """Lines of all blocks with enough words that stand in any earlier document."""
    out, earlier = {}, set()
    for doc_id, text, _ in sorted(rows):
        lines, removed, own = [tuple(words(x)) for x in text.split("\n")], set(), set()
        for i in range(len(lines)):
            for j in range(i + 1, len(lines) + 1):
                if sum(map(len, lines[i:j])) >= min_words:
                    own.add(tuple(lines[i:j]))
                    if tuple(lines[i:j]) in earlier:
                        removed |= set(range(i, j))
        earlier |= own
        out[doc_id] = sorted(removed)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_every_block_of_all_earlier_documents_goes(spark, seed):
    x, y, z = (" ".join(f"{c}{i}" for i in range(7)) for c in "xyz")
    rows = corpus(seed)
    rows += [(200, x, "a"), (201, y, "a"), (202, z, "a"), (203, f"own\n{x}\n{y}\n{z}", "a"), (204, f"{x}\n{y}\n{z}\nother", "a")]
    # Lines of one or two words, and a passage twice in one document.
    short = "\n".join(f"s{i}" for i in range(25))
    rows += [(205, short, "a"), (206, f"{short}\nbetween\n{short}", "a")]
    found = line_dedup.dedup_lines(rows_of(spark, rows), min_words=20).collect()
    expected = brute_force(rows, 20)
    assert {r.doc_id: removed_lines(r) for r in found} == expected
    for r in found:
        lines = dict((i, t) for i, t, _ in rows)[r.doc_id].split("\n")
        assert r.n_lines == len(lines) and r.removed_words == sum(len(words(lines[i])) for i in expected[r.doc_id])
        assert r.text == "\n".join(x for i, x in enumerate(lines) if i not in expected[r.doc_id])
    assert {r.doc_id: r.text for r in found}[204] == "other"
    assert {r.doc_id: r.text for r in found}[206] == "between"


def test_blocks_moved_or_repeated_are_found():
    ids = {c: i + 1 for i, c in enumerate("abcdefghuvwxyz")}
    blocks = lambda x, y, n=2: line_dedup.repeated_blocks(
        *(a for t in (x, y) for a in (np.array([ids[c] for c in t], np.int64), np.full(len(t), 1))), n
    )
    assert blocks("abcd", "abcd") == [(0, 4)]
    assert blocks("abxcd", "abcd") == [(0, 2), (3, 5)]
    assert blocks("cdab", "abcd") == [(0, 4)]  # one of both is out of order
    assert blocks("uabvabw", "sab".replace("s", "x")) == [(1, 3), (4, 6)]
    assert blocks("abab", "uababv", 3) == [(0, 4)]
    assert blocks("abc", "xyz") == []


def test_very_many_blank_lines(spark):
    blank = "\n" * 100_000
    rows = [(1, blank + PROSE, "a"), (2, "own\n" + blank + PROSE + blank, "a"), (3, blank, "a")]
    found = line_dedup.dedup_lines(rows_of(spark, rows)).orderBy("doc_id").collect()
    assert found[0].removed is None and found[2].removed is None
    assert PROSE not in found[1].text and found[1].text.startswith("own")


def test_a_log_of_very_many_lines(spark):
    lines = [f"{i} connection from host {i % 7} was closed after some seconds without any further notice" for i in range(200_000)]
    rows = [(1, "\n".join(lines[::2]), "a"), (2, "\n".join(lines), "a")]
    found = line_dedup.dedup_lines(rows_of(spark, rows), min_words=10).orderBy("doc_id").collect()
    assert found[0].removed is None
    assert found[1].text == "\n".join(lines[1::2])
