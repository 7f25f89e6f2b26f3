import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from postsieve.llm import substring_dedup as sub
from postsieve.llm.words import windows, word_hashes

from .conftest import AWKWARD, CLASHING, LONG, PROSE, rows_of, words


def fresh(rng, n):
    return [f"w{rng.randint(0, 10**6)}" for _ in range(n)]


def tokens(texts):
    hashes, _, counts = word_hashes(pa.array([" ".join(t) for t in texts]), lower=True)
    return windows(hashes, counts, 5)


def test_smallest_values_of_all_windows():
    rng = np.random.default_rng(0)
    for _ in range(80):
        n, width = int(rng.integers(0, 90)), int(rng.integers(1, 30))
        values = rng.integers(0, 40, n).astype(np.uint64)
        expected = [int(values[i : i + width].min()) for i in range(n - width + 1)]
        assert sub.window_minima(values, width).tolist() == expected


def test_signatures_are_of_every_window_and_only_within_texts():
    rng = random.Random(2)
    texts = [fresh(rng, n) for n in (0, 3, 30, 80, 24, 25, 120)]
    texts.append(texts[3][:40] + fresh(rng, 10))
    grams, counts = tokens(texts)
    text, begin, signature = sub.signatures(grams, counts, 21, 3)
    starts = np.cumsum(counts) - counts
    of_window = {}
    for t, (a, n) in enumerate(zip(starts, counts)):
        for j in range(a, a + n - 20):
            k = np.searchsorted(begin, j, side="right") - 1
            assert text[k] == t
            of_window.setdefault(signature[k], set()).add(t)
    # Equal runs of tokens have equal signatures, and no other texts do.
    assert {frozenset(s) for s in of_window.values() if len(s) > 1} == {frozenset((3, 7))}
    place = sub.places_of(grams, begin, 21)
    assert ((place >= begin) & (place < begin + 21)).all()


def edited(rng, passage, edits):
    """With words changed, put in or taken out, wherever."""
    out = list(passage)
    for _ in range(edits):
        i, kind = rng.randrange(len(out)), rng.choice("sid")
        if kind == "s":
            out[i] = fresh(rng, 1)[0]
        elif kind == "i":
            out.insert(i, fresh(rng, 1)[0])
        else:
            del out[i]
    return out


def similarity(a, b):
    x, y = ({tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in (a, b))
    return len(x & y) / len(x | y)


def longest_common_run(a, b):
    x, y = (tokens([t])[0] for t in (a, b))
    best, row = 0, np.zeros(len(y) + 1, np.int64)
    for value in x:
        row = np.concatenate(([0], np.where(y == value, row[:-1] + 1, 0)))
        best = max(best, int(row.max()))
    return best


def test_similar_passages_have_a_long_run_in_common():
    rng = random.Random(5)
    assert sub.seed_tokens(5, 50, 0.8) == 21
    tried = 0
    while tried < 300:
        a = fresh(rng, rng.randint(50, 260))
        b = edited(rng, a, rng.randint(1, 1 + len(a) // 40))
        if min(len(a), len(b)) >= 50 and similarity(a, b) >= 0.8:
            tried += 1
            assert longest_common_run(a, b) >= 21


@pytest.fixture(scope="module")
def near_pairs():
    """Pairs of texts that share one near copy of a passage, by length and number of edits."""
    rng = random.Random(7)
    pairs = []
    for length, edits in ((50, 1), (55, 1), (60, 1), (80, 1), (100, 2), (120, 2), (200, 3), (300, 6)):
        n = 0
        while n < 60:
            a = fresh(rng, length)
            b = edited(rng, a, edits)
            if min(len(a), len(b)) < 50 or similarity(a, b) < 0.8:
                continue
            n += 1
            texts = [fresh(rng, rng.randint(0, 90)) + p + fresh(rng, rng.randint(0, 90)) for p in (a, b)]
            pairs.append((length, edits, *texts))
    return pairs


def test_recall_of_near_copies(spark, near_pairs):
    rows = [(2 * k + i, " ".join(pair[2 + i]), "a") for k, pair in enumerate(near_pairs) for i in range(2)]
    random.Random(1).shuffle(rows)
    found = sub.shared_passages(rows_of(spark, rows).repartition(6)).collect()
    hit = defaultdict(set)
    for r in found:
        assert r.doc_id // 2 == r.other_doc_id // 2 and r.similarity >= 0.8 and r.n_words >= 50
        hit[r.doc_id // 2].add((r.start_word, r.end_word))
    by_kind = defaultdict(list)
    for k, (length, edits, *_) in enumerate(near_pairs):
        by_kind[length, edits].append(k in hit)
    assert {kind: sum(v) / len(v) >= 0.95 for kind, v in by_kind.items()} == dict.fromkeys(by_kind, True)


def planted(seed):
    rng = random.Random(seed)
    kept = [fresh(rng, n) for n in (51, 60, 90, 200)]
    rows, holders = [], defaultdict(list)
    for i in range(160):
        text = fresh(rng, rng.randint(0, 150))
        if i % 2:
            k = i % 8 // 2
            at = rng.randint(0, len(text))
            holders[k].append((i, at, at + len(kept[k])))
            text = text[:at] + kept[k] + text[at:]
        rows.append((i, " ".join(text), "a"))
    return rows, holders


@pytest.mark.parametrize("size", [700, 1_000_000])
def test_planted_passages_are_found_and_nothing_else(spark, monkeypatch, size):
    for name in ("CHUNK_WORDS", "FLUSH_BYTES", "COUNTED"):
        monkeypatch.setattr(sub, name, size)
    rows, holders = planted(1)
    found = sub.shared_passages(rows_of(spark, rows).repartition(5)).collect()
    spans = defaultdict(set)
    for r in found:
        spans[r.doc_id].add((r.start_word, r.end_word))
        spans[r.other_doc_id].add((r.other_start_word, r.other_end_word))
        assert r.n_words == r.end_word - r.start_word >= 50 and r.similarity >= 0.8
    expected = {i: (a, b) for own in holders.values() for i, a, b in own}
    # All are found whole.  Where a signature at an end has a head of its own, a part is found once more.
    assert set(spans) == set(expected) and all(expected[i] in own for i, own in spans.items())
    assert all(expected[i][0] <= a < b <= expected[i][1] for i, own in spans.items() for a, b in own)
    # Not all pairs: each holder is compared with a head or two.
    assert len(found) <= 3 * len(expected)


def test_members_unlike_their_head_find_each_other(spark):
    """A phrase that very many texts have, of which some share the passage about it."""
    rng = random.Random(12)
    phrase = fresh(rng, 30)
    rows = [(i, " ".join(fresh(rng, 60) + phrase + fresh(rng, 60)), "a") for i in range(150)]
    kinds = [(fresh(rng, 25), fresh(rng, 25)) for _ in range(20)]
    for k, (before, after) in enumerate(kinds):
        for i in range(3):
            text = before + phrase + after
            if i:
                text[rng.choice((8, 70))] = "changed"
            rows.append((1000 + 3 * k + i, " ".join(fresh(rng, 40) + text + fresh(rng, 40)), "a"))
    found = sub.shared_passages(rows_of(spark, rows).repartition(4)).collect()
    assert all(min(r.doc_id, r.other_doc_id) >= 1000 for r in found)
    assert all((r.doc_id - 1000) // 3 == (r.other_doc_id - 1000) // 3 for r in found)
    linked = {x for r in found for x in (r.doc_id, r.other_doc_id)}
    assert len(linked) >= 57


def exact_repeats(rows, n=50):
    first, out = {}, defaultdict(set)
    for doc_id, text in rows:
        own = words(text, lower=True)
        for i in range(len(own) - n + 1):
            seen = first.setdefault(tuple(own[i : i + n]), (doc_id, i))
            if seen[0] != doc_id:
                out[doc_id] |= set(range(i, i + n))
                out[seen[0]] |= set(range(seen[1], seen[1] + n))
    return out


def test_recall_on_the_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    expected = exact_repeats([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    covered = defaultdict(set)
    for r in sub.shared_passages(docs).collect():
        covered[r.doc_id] |= set(range(r.start_word, r.end_word))
        covered[r.other_doc_id] |= set(range(r.other_start_word, r.other_end_word))
    assert len(set(expected) & set(covered)) >= 0.99 * len(expected) > 100
    hits = sum(len(expected[d] & covered[d]) for d in expected)
    assert hits >= 0.99 * sum(map(len, expected.values()))


def test_awkward_rows(awkward, empty):
    found = sub.shared_passages(awkward).collect()
    pairs = {frozenset((r.doc_id, r.other_doc_id)) for r in found}
    assert frozenset((7, 8)) in pairs and pairs <= {frozenset((7, 8)), frozenset((9, 10))}
    spans = [r for r in found if {r.doc_id, r.other_doc_id} == {7, 8}]
    assert max(r.n_words for r in spans) >= len(LONG.split()) and len(PROSE.split()) < 70
    assert sub.shared_passages(empty).count() == 0
    assert len(AWKWARD) == 16


def test_copies_are_linked_to_the_smallest_id(spark):
    text = " ".join(f"w{i}" for i in range(70))
    other = " ".join([*(f"w{i}" for i in range(70)), "and", "more"])
    rows = [(5, text, "a"), (3, text, "a"), (3, text, "a"), (None, text, "b"), (8, other, "b"), (9, "short", "b"), (10, "short", "b")]
    found = sub.shared_passages(rows_of(spark, rows, CLASHING)).collect()
    copies = {(r.doc_id, r.other_doc_id, r.n_words) for r in found if 8 not in (r.doc_id, r.other_doc_id)}
    assert copies == {(5, 3, 70), (None, 3, 70)}
    assert {frozenset((r.doc_id, r.other_doc_id)) for r in found if 8 in (r.doc_id, r.other_doc_id)} == {frozenset((3, 8))}


def test_texts_with_single_runs_of_the_passage_take_no_partner(spark):
    rng = random.Random(11)
    rows = []
    for k in range(3):
        passage = fresh(rng, 52)
        # Twelve other texts have all of its five-word runs, each far from the next.
        for i in range(12):
            text = [x for j in range(48) for x in (*fresh(rng, 45), *passage[j : j + 5])]
            rows.append((100 * k + 10 + i, " ".join(text), "a"))
        for i in range(2):
            rows.append((100 * k + i, " ".join(fresh(rng, 30) + passage + fresh(rng, 30)), "a"))
    found = sub.shared_passages(rows_of(spark, rows).repartition(3)).collect()
    assert {frozenset((r.doc_id, r.other_doc_id)) for r in found} == {
        frozenset((100 * k, 100 * k + 1)) for k in range(3)
    }


def test_one_word_repeated_very_often(spark):
    rows = [(1, "word " * 200_000, "a"), (2, "word " * 150_000 + "end", "a"), (3, "ab cd " * 60_000, "a")]
    found = sub.shared_passages(rows_of(spark, rows)).collect()
    assert {frozenset((r.doc_id, r.other_doc_id)) for r in found} == {frozenset((1, 2))}


def test_a_quotation_before_the_passage(spark):
    rng = random.Random(13)
    passage = fresh(rng, 100)
    quoting = fresh(rng, 20) + passage[:60] + fresh(rng, 200) + passage + fresh(rng, 20)
    rows = [(1, " ".join(fresh(rng, 30) + passage + fresh(rng, 30)), "a"), (2, " ".join(quoting), "a")]
    found = sub.shared_passages(rows_of(spark, rows)).collect()
    assert max(r.n_words for r in found) == 100


def classes_of(pairs):
    """The smallest number that pairs lead to, of all numbers in pairs."""
    least = {x: x for pair in pairs for x in pair}
    for _ in least:
        for pair in pairs:
            low = min(least[x] for x in pair)
            least.update(dict.fromkeys(pair, low))
    return least


def classes_by_rows(found):
    return {x: r.class_id for r in found for x in (r.doc_id, r.other_doc_id)}


@pytest.mark.parametrize(("block", "asking"), [(2048, 4096), (12, 7)])
def test_every_pair_of_different_texts_is_in_one_class(spark, monkeypatch, block, asking):
    """Texts with words of one changed, and texts that have no more than a phrase of it; a row links two of one class."""
    for name, value in (("BLOCK", block), ("ASKING", asking)):
        monkeypatch.setattr(sub, name, value)
    rng = random.Random(17)
    base, texts = fresh(rng, 130), []
    for i in range(60):
        own = list(base)
        for at in rng.sample(range(130), rng.randint(1, 6) if i % 3 else rng.randint(6, 13)):
            own[at] = fresh(rng, 1)[0]
        texts.append(own if i % 4 else fresh(rng, 50) + own[50:82] + fresh(rng, 48))
    grams = [tokens([t])[0] for t in texts]
    expected = set()
    for i in range(60):
        for j in range(i):
            sums = np.concatenate(([0], np.cumsum(grams[i] == grams[j])))
            for n in range(46, len(grams[0]) + 1):
                same = int((sums[n:] - sums[:-n]).max())
                if same >= 0.8 * (2 * n - same):
                    expected.add(frozenset((i, j)))
    assert 300 < len(expected) < 1000
    found = sub.shared_passages(rows_of(spark, [(i, " ".join(t), "a") for i, t in enumerate(texts)]).repartition(3)).collect()
    assert {frozenset((r.doc_id, r.other_doc_id)) for r in found} <= expected
    assert classes_by_rows(found) == classes_of(expected)
    for r in found:
        a, b = texts[r.doc_id][r.start_word : r.end_word], texts[r.other_doc_id][r.other_start_word : r.other_end_word]
        assert min(len(a), len(b)) >= 50 and r.similarity == pytest.approx(similarity(a, b)) and r.similarity >= 0.8


def segment(number, text):
    values = (tokens([text])[0] >> np.uint64(32)).astype(np.uint32)
    at = np.arange(0, len(values), 3, dtype=np.int32)
    columns = {"tokens": values.tobytes(), "signatures": values[at].astype(np.int64).tobytes(), "places": at.tobytes()}
    return sub.Segment({"text": number, "doc_id": number, "begin": 0} | columns)


@pytest.mark.parametrize(("tile", "few"), [(256, 64), (7, 0), (9, 10**9)])
def test_no_pair_with_a_passage_is_left_out_by_counting(monkeypatch, tile, few):
    for name, value in (("TILE", tile), ("FEW", few), ("COLUMNS", 50)):
        monkeypatch.setattr(sub, name, value)
    rng = random.Random(37)
    base = fresh(rng, 90) + ["again"] * 20 + fresh(rng, 20)
    texts = [edited(rng, base[rng.randint(0, 60) :], rng.randint(0, 14)) for _ in range(70)]
    members = [segment(i, t) for i, t in enumerate(texts)]
    pairs = [(i, j) for i in range(70) for j in range(i) if list(sub.met_passages(members[i], members[j], 46, 0.8))]
    every = np.tri(70, k=-1, dtype=bool)
    likely = sub.may_be_similar(members, members, every, 46, 0.8)
    assert all(likely[i, j] for i, j in pairs) and 100 < len(pairs) <= likely.sum() < 0.9 * every.sum()
    classes = sub.Classes({i: i for i in range(70)})
    found = list(sub.linking_passages(members, members, lambda a, b: every[a, b], classes, 46, 0.8))
    assert {(x.text, y.text) for x, y, _ in found} <= set(pairs)
    expected = classes_of({frozenset(p) for p in pairs})
    assert {i: classes.of(i) for i in range(70)} == {i: i for i in range(70)} | expected
    # One pair for each text but the first of its class.
    assert len({(x.text, y.text) for x, y, _ in found}) == len(expected) - len(set(expected.values()))


def test_members_that_are_linked_with_each_other_only(spark, monkeypatch):
    """A common phrase, and by twos and threes what is about it; they are dealt into many blocks."""
    monkeypatch.setattr(sub, "BLOCK", 4)
    monkeypatch.setattr(sub, "ASKING", 6)
    rng = random.Random(23)
    phrase, rows, expected = fresh(rng, 30), [], {}
    for k in range(14):
        before, after = fresh(rng, 25), fresh(rng, 25)
        for i in range(k % 3 + 1):
            rows.append((10 * k + i, " ".join(fresh(rng, 30) + before + phrase + after + fresh(rng, 30)), "a"))
            if k % 3:
                expected[10 * k + i] = 10 * k
    found = sub.shared_passages(rows_of(spark, rows).repartition(3)).collect()
    assert classes_by_rows(found) == expected


def test_rows_grow_with_the_texts_and_not_with_their_pairs(spark):
    """Near copies, each with changes of its own."""
    rng = random.Random(29)
    base = fresh(rng, 120)
    sizes = []
    for n in (60, 240):
        rows = []
        for i in range(n):
            own = list(base)
            for at in rng.sample(range(120), rng.randint(1, 6)):
                own[at] = fresh(rng, 1)[0]
            rows.append((i, " ".join(own), "a"))
        found = sub.shared_passages(rows_of(spark, rows).repartition(3)).collect()
        # Some few differ too much from all others.
        assert set(classes_by_rows(found).values()) == {min(classes_by_rows(found))} and len(classes_by_rows(found)) > 0.95 * n
        sizes.append(len(found))
    assert sizes[1] < 6 * sizes[0]


def test_a_text_without_an_id_links_others(spark):
    """It is in no class itself, and no other such text is taken for it."""
    rng = random.Random(31)
    rows, expected = [], {}
    for k in range(6):
        one, other = fresh(rng, 70), fresh(rng, 70)
        rows += [(10 * k + 1, " ".join(one), "a"), (10 * k + 2, " ".join(other), "a"), (None, " ".join(one + other), "a")]
        expected |= {10 * k + 1: 10 * k + 1, 10 * k + 2: 10 * k + 1}
    rows += [(None, rows[2][1], "a"), (None, " ".join(both := fresh(rng, 80)), "a"), (None, " ".join([*both, "end"]), "a")]
    found = sub.shared_passages(rows_of(spark, rows).repartition(3)).collect()
    of = classes_by_rows(found)
    of.pop(None)
    assert of == expected
    assert [r.class_id for r in found if r.doc_id is None and r.other_doc_id is None] == [None]


def test_a_phrase_that_the_head_has_twice(spark):
    """The passage is about the second, and one change in the phrase's neighbourhood leaves no other run."""
    rng = random.Random(19)
    phrase, before, after = fresh(rng, 30), fresh(rng, 14), fresh(rng, 14)
    head = fresh(rng, 60) + phrase + fresh(rng, 400) + before + phrase + after + fresh(rng, 60)
    other = fresh(rng, 60) + before + phrase + after + fresh(rng, 60)
    found = sub.shared_passages(rows_of(spark, [(1, " ".join(head), "a"), (2, " ".join(other), "a")])).collect()
    assert {frozenset((r.doc_id, r.other_doc_id)) for r in found} == {frozenset((1, 2))}
