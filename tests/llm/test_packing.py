import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from postsieve.llm.packing import Plan, best_fit, pack, reduce_by_dominance

from .conftest import AWKWARD

PATH = public_tokenizers.path("word_bpe_49k.json")


def fewest(items, capacity):
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for k in {b: k for k, b in enumerate(bins)}.values():
            if bins[k] + items[i] <= capacity:
                bins[k] += items[i]
                go(i + 1, bins)
                bins[k] -= items[i]
        bins.append(items[i])
        go(i + 1, bins)
        bins.pop()

    go(0, [])
    return best[0]


def placed_one_by_one(items, capacity):
    bins = []
    for size in sorted(items, reverse=True):
        fits = [b for b in bins if sum(b) + size <= capacity]
        if fits:
            max(fits, key=sum).append(size)
        else:
            bins.append([size])
    return sorted(map(sum, bins))


def cases(n, seed):
    rng = random.Random(seed)
    for _ in range(n):
        capacity, least = rng.choice([10, 20, 31]), rng.choice([1, 1, 2, 4, 6])
        yield [rng.randint(least, capacity) for _ in range(rng.randint(0, 11))], capacity


def counts_of(items):
    return {x: items.count(x) for x in items}


def test_fixed_sets_never_cost_a_sequence():
    fixed_in_all = 0
    for items, capacity in cases(400, 1):
        layouts, rest = reduce_by_dominance(counts_of(items), capacity)
        fixed = [x for lengths, n in layouts for _ in range(n) for x in lengths]
        left = [x for x, n in rest.items() for _ in range(n)]
        assert sorted(fixed + left) == sorted(items) and all(sum(x) <= capacity for x, _ in layouts)
        n_fixed = sum(n for _, n in layouts)
        assert n_fixed + fewest(left, capacity) == fewest(items, capacity)
        fixed_in_all += n_fixed
    assert fixed_in_all > 400


def test_counted_best_fit_equals_placing_one_by_one():
    for items, capacity in cases(400, 2):
        layouts = best_fit(counts_of(items), capacity)
        assert sorted(sum(x) for x, n in layouts for _ in range(n)) == placed_one_by_one(items, capacity)


def test_plans_are_gapless_and_near_the_optimum():
    extra = 0
    for items, capacity in cases(200, 3):
        plan, held = Plan(counts_of(items), capacity), {}
        for size, n in counts_of(items).items():
            for s, o in zip(*plan.places(np.full(n, size), np.arange(n))):
                held.setdefault(int(s), []).append((int(o), size))
        assert sorted(held) == list(range(plan.sequences))
        for pieces in held.values():
            end = 0
            for offset, size in sorted(pieces):
                assert offset == end
                end += size
            assert end <= capacity
        extra += plan.sequences - fewest(items, capacity)
    assert extra <= 4


@pytest.mark.parametrize("capacity", [64, 4096])
def test_packing_awkward_rows(awkward, capacity):
    found = pack(awkward, PATH, capacity, with_ids=True).collect()
    tokenizer = Tokenizer.from_file(PATH)
    documents = {}
    for r in found:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length <= 4 * capacity
        documents.setdefault((r.part, r.row), []).append(r)
    wanted = sorted(
        (str(d), *tokenizer.encode(t or "", add_special_tokens=False).ids, 1) for d, t, _ in AWKWARD
    )
    joined = []
    for pieces in documents.values():
        pieces.sort(key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(len(pieces)))
        assert [r.start for r in pieces] == [capacity * i for i in range(len(pieces))]
        assert all(r.length == capacity for r in pieces[:-1])
        ids = np.frombuffer(b"".join(r.ids for r in pieces), "<u4").tolist()
        joined.append((str(pieces[0].doc_id), *ids))
    assert sorted(joined) == wanted
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(sequences) == list(range(len(sequences)))
    for pieces in sequences.values():
        assert all(o == sum(n for _, n in sorted(pieces)[:i]) for i, (o, _) in enumerate(sorted(pieces)))
        assert sum(n for _, n in pieces) <= capacity


def test_packing_nothing(empty, awkward):
    assert pack(empty, PATH).count() == 0
    assert pack(awkward.where("text IS NULL"), PATH, end_id=None).count() == 0
