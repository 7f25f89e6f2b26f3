import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from postsieve.llm import ngram_lm
from postsieve.llm.elias_fano import Sequence, encode, find_in_ranges, join_ranges

from .conftest import AWKWARD, rows_of, words


def test_sequences_answer_like_the_plain_lists():
    rng = np.random.default_rng(0)
    for _ in range(250):
        n, top = int(rng.integers(0, 200)), int(rng.choice([1, 5, 100, 10**4, 10**9]))
        values = np.sort(rng.integers(0, top + 1, n))
        sequence = Sequence(encode(values))
        assert sequence.access(np.arange(n)).tolist() == values.tolist()
        wanted, begin = rng.integers(0, top + 3, 30), rng.integers(0, n + 1, 30)
        end = np.array([rng.integers(b, n + 1) for b in begin])
        expected = [next((i for i in range(b, e) if values[i] >= x), e) for b, e, x in zip(begin, end, wanted)]
        assert sequence.successor(begin, end, wanted).tolist() == expected


def test_context_ranges_are_searched_relative_to_their_base():
    rng = np.random.default_rng(1)
    for _ in range(250):
        size = int(rng.choice([6, 50, 10**6]))
        lengths = rng.integers(0, 6, int(rng.integers(1, 20)))
        pointers = np.concatenate(([0], np.cumsum(lengths)))
        values = [np.sort(rng.choice(size, n, replace=False)) for n in lengths]
        flat = np.concatenate(values)
        node, wanted = rng.integers(0, len(lengths), 40), rng.integers(0, size, 40)
        found = find_in_ranges(Sequence(encode(pointers)), Sequence(encode(join_ranges(flat, pointers))), node, wanted)
        expected = [next((i for i in range(pointers[a], pointers[a + 1]) if flat[i] == b), -1) for a, b in zip(node, wanted)]
        assert found.tolist() == expected


def plain_scores(rows):
    """The interpolated trigram model with plain counters and exact probabilities."""
    tokens = [([*words(text, lower=True), None]) for _, text, *_ in rows]
    held_out = [zlib.crc32(str(d).encode() if d is not None else b"") % 5 == 1 for d, *_ in rows]
    c1, c2, c3 = Counter(), Counter(), Counter()
    for t, out in zip(tokens, held_out):
        if not out:
            c1.update(t)
            c2.update(zip(t, t[1:]))
            c3.update(zip(t, t[1:], t[2:]))
    t2, t3 = Counter(a for a, _ in c2), Counter((a, b) for a, b, _ in c3)
    total, size = sum(c1.values()), len(c1)
    d2, d3 = ngram_lm.DISCOUNTS
    out = []
    for (doc_id, *_), t, held in zip(rows, tokens, held_out):
        base = score = 0.0
        for i, w in enumerate(t):
            p = (c1[w] + 0.5) / (total + 0.5 * (size + 1))
            base += math.log10(p)
            if i and c1[t[i - 1]]:
                v = t[i - 1]
                p = max(c2[v, w] - d2, 0) / c1[v] + d2 * t2[v] / c1[v] * p
            if i > 1 and c2[t[i - 2], t[i - 1]]:
                n = c2[t[i - 2], t[i - 1]]
                p = max(c3[t[i - 2], t[i - 1], w] - d3, 0) / n + d3 * t3[t[i - 2], t[i - 1]] / n * p
            score += math.log10(p)
        out.append((doc_id, held, len(t), sum(c1[w] > 0 for w in t), total, base, score))
    return out


def key(row):
    return (row[0] is not None, row[0] or 0, row[2], round(row[5], 6))


@pytest.mark.parametrize("shard_tokens", [50, 2_000_000])
def test_scores_equal_the_plain_model(spark, shard_tokens):
    rng = random.Random(2)
    common, rows = [f"c{i}" for i in range(12)], []
    for i in range(150):
        n = rng.choice([0, 1, 2, 15, 40])
        text = " ".join(rng.choice(common) if rng.random() < 0.7 else f"r{rng.randint(0, 300)}" for _ in range(n))
        rows.append((i, text.upper() if i % 7 == 0 else text, "a"))
    rows += [(i + 1000, text, s) for i, (_, text, s) in enumerate(AWKWARD[:12])] + [(None, None, None)]
    found = ngram_lm.score_documents(rows_of(spark, rows).repartition(4), shard_tokens=shard_tokens).collect()
    for row, wanted in zip(sorted(map(tuple, found), key=key), sorted(plain_scores(rows), key=key)):
        assert row[:5] == wanted[:5]
        assert row[5] == pytest.approx(wanted[5], abs=1e-6 * max(1, abs(wanted[5])))
        # Codes have 20 steps per factor of ten: a token is off by half a step at most, or two.
        assert abs(row[6] - wanted[6]) <= 0.05 * row[2]
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_awkward_rows(awkward, empty):
    found = ngram_lm.score_documents(awkward)
    assert Counter(r.doc_id for r in found.collect()) == Counter(d for d, *_ in AWKWARD)
    assert all(r.score <= 1e-9 for r in found.collect())
    assert ngram_lm.score_documents(empty).count() == 0


def test_nothing_to_learn_from(spark):
    rows = [(i, "some text", "a") for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 1]
    found = ngram_lm.score_documents(rows_of(spark, rows)).collect()
    assert len(found) == len(rows)
    assert {(r.held_out, r.n_known, r.train_tokens, r.base_score, r.score) for r in found} == {(True, 0, 0, 0.0, 0.0)}
