"""Near-duplicate passages that documents share, found by compact windows.

Tokens are runs of five words.  For a hash function, the subsequences of a text whose smallest hash
stands at one place form a compact window, a node of the Cartesian tree over the hashes.  Passages
of the wanted length and similarity share an unbroken run of tokens (``seed_tokens``: an edit costs
about as many tokens on either side as a token has words less one, so there are few), and within that run
every hash function has its smallest value at the same token in both.  So windows are cut to the
length of such a run, the windows of several functions are joined where they overlap, and the
signature of an interval is all their smallest values.  Signatures that one text has alone are dropped.

Texts with one signature are a group, its first text is the head.  Each member is compared with the
head: the tokens of both are aligned about the place of the smallest hash, from there to both sides, and
the best stretches of the wanted similarity and length are the result.  The members of all groups that have
their head's signature within one stretch of it are a family.  Its members need not be like the head, so those with
a signature in common are compared with each other too, but no two that passages link already: first in
blocks, then those that are not linked with the head with all other blocks.  So a family has as many links as
members and not as pairs of them.  Pairs with too few tokens in common for a passage, or too far apart, are left
out by counting.
What passages link, in however many steps, is a class of documents.

Texts are dealt into chunks that keep their place; what is compared comes to the chunk of the
member, as the stretch of the head that is asked for.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.llm.common import input_tasks, stored
from postsieve.llm.graph import components
from postsieve.llm.shared_names import COUNTS, read_sums, send_counts, summed
from postsieve.llm.words import distinct, mix, small_batches, windows, word_hashes

#: Words in a token, and in the shortest passage of interest.
N_WORDS = 5
MIN_WORDS = 50
SIMILARITY = 0.8
#: Hash functions whose smallest values are a signature.
FUNCTIONS = 3
#: Tokens beyond the common signatures that a passage is looked for, and places to which stretches
#: are rounded, so that many members ask for the same.
ROOM, GRID = 160, 64
#: Tokens by which an alignment may shift.
DRIFT = 48
#: Tokens of a head about which a family meets, members of it that are sent as one block at first and
#: when they ask other blocks, members and columns of a matrix, and pairs that are aligned without counting.
CELL, BLOCK, ASKING, TILE, COLUMNS, FEW = 1024, 512, 1024, 256, 1 << 14, 64
#: Words of the texts in a chunk, about, and bytes of text that a task holds before it sends them.
CHUNK_WORDS = 1_000_000
FLUSH_BYTES = 8 << 20
#: Signatures that one task counts, about.
COUNTED = 2_000_000
SPARE_BITS = 12
#: Numbers of texts without an id, as nodes, come after all ids.
NO_ID = "CAST(100000000000000000000 AS DECIMAL(21, 0))"

_SEEDS = mix(np.arange(1, 65, dtype=np.uint64))


def seed_tokens(n_words: int, min_words: int, similarity: float) -> int:
    """Tokens in a row that two passages of at least this length and similarity share at least.

    Of their union 1 - s is not common, and to end a common run costs n - 1 tokens in each passage.
    """
    shortest, least = min_words - n_words + 1, None
    common = int(np.ceil(2 * similarity * shortest / (1 + similarity) - 1e-9))
    for both in range(common, 50 * shortest):
        breaks = int(both * (1 - similarity) / similarity / (2 * n_words - 2) + 1e-9)
        run = -(-both // (breaks + 1))
        least = run if least is None else min(least, run)
    return least


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest value of each window, in linear time whatever the values.

    A window is the end of one block of its width and the beginning of the next.
    """
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    blocks = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    blocks[: len(values)] = values
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def signatures(tokens: np.ndarray, counts: np.ndarray, width: int, functions: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text, begin, signature)`` of all intervals of windows with the same smallest hashes.

    ``tokens`` are those of all texts, ``counts`` how many each has; ``begin`` is a place in them.
    """
    n = len(tokens) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    joined = np.zeros(n, np.uint64)
    for function in range(functions):
        joined = mix(joined + window_minima(mix(tokens ^ _SEEDS[function]), width))
    ends = np.cumsum(counts)
    text = np.repeat(np.arange(len(counts)), counts)[:n]
    inside = np.arange(n) + width <= ends[text]
    new = inside.copy()
    new[1:] &= (joined[1:] != joined[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(new)
    return text[begin], begin, joined[begin]


def places_of(tokens: np.ndarray, begin: np.ndarray, width: int) -> np.ndarray:
    """Where the first function's smallest hash stands in the windows that begin there."""
    out = [np.zeros(0, np.int64)]
    for i in range(0, len(begin), 1 << 16):
        at = begin[i : i + (1 << 16), None] + np.arange(width)
        out.append(at[:, 0] + mix(tokens[at].ravel() ^ _SEEDS[0]).reshape(at.shape).argmin(axis=1))
    return np.concatenate(out)


def aligned(
    mine: np.ndarray, low: int, high: int, other: np.ndarray, shift: int, seed: int
) -> tuple[np.ndarray, np.ndarray]:
    """Ascending places of equal tokens, ``(in mine, in other)``, that follow the alignment ``mine - other = shift``.

    Of equal tokens in ``other`` the nearest to the alignment counts.
    """
    at = np.arange(low, high)
    order = np.argsort(other, kind="stable")
    values = other[order]
    group = np.cumsum(np.concatenate(([0], values[1:] != values[:-1])))
    size = len(other) + 1
    keys = group * size + order
    left = np.searchsorted(values, mine[low:high])
    found = values[np.minimum(left, len(values) - 1)] == mine[low:high]
    at, left = at[found], left[found]
    if not len(at):
        return at, at
    wanted = at - shift
    own = group[left]
    near = np.searchsorted(keys, own * size + np.clip(wanted, 0, size - 1))
    after = keys[np.minimum(near, len(keys) - 1)]
    before = keys[np.maximum(near - 1, 0)]
    far = np.int64(1) << 40
    after = np.where(after // size == own, after % size, far)
    before = np.where(before // size == own, before % size, -far)
    place = np.where(np.abs(after - wanted) <= np.abs(wanted - before), after, before)
    close = np.abs(place - wanted) <= DRIFT
    at, place = at[close], place[close]
    # From the seed to both sides, what would go back is left out.
    middle = int(np.searchsorted(at, seed))
    keep = np.ones(len(at), bool)
    right, left_side = place[middle:], place[:middle][::-1]
    if len(right) > 1:
        keep[middle + 1 :] = right[1:] > np.maximum.accumulate(right)[:-1]
    if len(left_side):
        start = right[0] if len(right) else np.int64(1) << 40
        bound = np.minimum.accumulate(np.concatenate(([start], left_side)))[:-1]
        keep[:middle] = (left_side < bound)[::-1]
    return at[keep], place[keep]


def best_stretches(at: np.ndarray, place: np.ndarray, shortest: int, similarity: float) -> Iterator[tuple[int, int]]:
    """``(first, last)`` of aligned tokens: stretches of the wanted similarity and length, apart from each other.

    Of m aligned tokens over a and b places, the similarity is m / (a + b - m).  That is at least s
    where a sum over the tokens is not negative; the stretch with the greatest sum is taken, or
    the longest one where that is too short.  One that is short by so little that it may go on over
    tokens that are not aligned counts too.
    """
    todo = [(0, len(at))]
    while todo:
        begin, end = todo.pop()
        if end - begin < 2:
            continue
        i, j = at[begin:end], place[begin:end]
        gains = np.concatenate(([0.0], 1 + similarity - similarity * (np.diff(i) + np.diff(j))))
        sums = np.cumsum(gains)
        lows = np.minimum.accumulate(sums)
        last = int((sums - lows).argmax())
        first = int(sums[: last + 1].argmin())

        def long_enough(a: int, b: int) -> bool:
            # As it is, or with what is unlike beyond its ends.
            same = b - a + 1
            sizes = max(i[b] - i[a] + 1, shortest) + max(j[b] - j[a] + 1, shortest)
            return same >= similarity * (sizes - same) - 1e-9

        if not long_enough(first, last):
            firsts = np.searchsorted(-lows, -(sums + 1 - similarity) - 1e-9)
            lengths = i - i[np.minimum(firsts, np.arange(len(i)))]
            last = int(lengths.argmax())
            first = min(int(firsts[last]), last)
            if not long_enough(first, last):
                continue
        yield begin + first, begin + last
        todo += [(begin, begin + first), (begin + last + 1, end)]


def passages(
    mine: np.ndarray, other: np.ndarray, shift: int, first: int, last: int, shortest: int, similarity: float
) -> list[tuple[int, int, int, int, float]]:
    """``(start, end, other start, other end, similarity)`` of the passages about an alignment, ends exclusive."""
    out = []
    at, place = aligned(mine, max(0, first - ROOM), min(len(mine), last + ROOM), other, shift, first)
    for a, b in best_stretches(at, place, shortest, similarity):
        start, end, to_start, to_end = int(at[a]), int(at[b]) + 1, int(place[a]), int(place[b]) + 1
        short = max(0, shortest - min(end - start, to_end - to_start))
        before = min(short, start, to_start)
        after = short - before
        if after > min(len(mine) - end, len(other) - to_end):
            continue
        start, end, to_start, to_end = start - before, end + after, to_start - before, to_end + after
        x, y = (np.unique(v) for v in (mine[start:end], other[to_start:to_end]))
        same = len(np.intersect1d(x, y, assume_unique=True))
        found = same / (len(x) + len(y) - same)
        if found >= similarity:
            out.append((start, end, to_start, to_end, found))
    return out


class Segment:
    """A stretch of a text in a family; places are those in the whole text."""

    def __init__(self, row: dict):
        self.text, self.doc_id, self.begin = (row[c] for c in ("text", "doc_id", "begin"))
        self.tokens = np.frombuffer(row["tokens"], np.uint32)
        signatures, places = np.frombuffer(row["signatures"], np.int64), np.frombuffer(row["places"], np.int32)
        order = np.argsort(signatures, kind="stable")
        self.signatures, self.places = signatures[order], places[order].astype(np.int64)

    @cached_property
    def names(self) -> np.ndarray:
        return distinct(self.signatures)

    @cached_property
    def different(self) -> np.ndarray:
        return distinct(self.tokens)

    @cached_property
    def numbered(self) -> np.ndarray:
        return numbered(self.tokens)

    def meets(self, other: Segment) -> list[tuple[int, int, int]]:
        """``(shift, first, last)``: the alignments by equal signatures, and between which places they hold."""
        left = np.searchsorted(other.signatures, self.signatures)
        times = np.searchsorted(other.signatures, self.signatures, side="right") - left
        mine = np.repeat(self.places, times)
        theirs = np.arange(len(mine)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(left, times)
        order = np.lexsort((mine, mine - other.places[theirs]))
        mine, shift = mine[order], (mine - other.places[theirs])[order]
        cuts = np.flatnonzero(np.diff(shift)) + 1
        return [(int(s[0]), int(m[0]), int(m[-1])) for s, m in zip(np.split(shift, cuts), np.split(mine, cuts)) if len(s)]

    def same_runs(self, other: Segment, shift: int, shortest: int) -> list[tuple[int, int]]:
        """``(start, end)`` in this text of the runs of equal tokens of that length."""
        low = max(self.begin, other.begin + shift)
        high = min(self.begin + len(self.tokens), other.begin + shift + len(other.tokens))
        if high - low < shortest:
            return []
        same = self.tokens[low - self.begin : high - self.begin] == other.tokens[low - shift - other.begin : high - shift - other.begin]
        edges = np.flatnonzero(np.diff(same.astype(np.int8), prepend=0, append=0))
        return [(low + a, low + b) for a, b in edges.reshape(-1, 2).tolist() if b - a >= shortest]


def incidence(values: list[np.ndarray], columns: np.ndarray) -> np.ndarray:
    """Which of the ascending ``columns`` each of the lists has, as a matrix of 0 and 1."""
    out = np.zeros((len(values), len(columns)), np.float32)
    if len(columns):
        row = np.repeat(np.arange(len(values)), [len(v) for v in values])
        every = np.concatenate(values)
        at = np.minimum(np.searchsorted(columns, every), len(columns) - 1)
        hit = columns[at] == every
        out[row[hit], at[hit]] = 1
    return out


def in_common(some: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    """How many values each two of the lists have in common."""
    total = np.zeros((len(some), len(others)), np.float32)
    columns = np.intersect1d(np.concatenate(some), np.concatenate(others))
    for i in range(0, len(columns), COLUMNS):
        part = columns[i : i + COLUMNS]
        total += incidence(some, part) @ incidence(others, part).T
    return total


def numbered(tokens: np.ndarray) -> np.ndarray:
    """Each token with the number of times that it has come before, so that none comes twice."""
    values = np.sort(tokens).astype(np.uint64)
    new = np.concatenate(([True], values[1:] != values[:-1])) if len(values) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    return (values << np.uint64(32)) + (np.arange(len(values)) - first[np.cumsum(new) - 1]).astype(np.uint64)


def met_passages(
    mine: Segment, other: Segment, shortest: int, similarity: float
) -> Iterator[tuple[int, int, int, int, float]]:
    """The passages of two segments about all their alignments, by places in the whole texts."""
    for shift, first, last in mine.meets(other):
        found = passages(
            mine.tokens, other.tokens, shift - mine.begin + other.begin, first - mine.begin, last - mine.begin, shortest, similarity
        )
        for start, end, to_start, to_end, similar in found:
            yield start + mine.begin, end + mine.begin, to_start + other.begin, to_end + other.begin, similar


def has_stretches(mine: np.ndarray, others: list[np.ndarray], shortest: int, shares: tuple[float, ...]) -> np.ndarray:
    """For each of the others and each share, if it has that share of the tokens of a stretch that is long enough."""
    out = np.zeros((len(shares), len(others)), bool)
    if len(mine) >= shortest:
        values, at = np.unique(mine, return_inverse=True)
        step = max(1, (1 << 20) // len(mine))
        for i in range(0, len(others), step):
            has = incidence(others[i : i + step], values)[:, at].astype(np.float64)
            for k, share in enumerate(shares):
                sums = np.pad(np.cumsum(has - share, axis=1), ((0, 0), (1, 0)))
                lows = np.minimum.accumulate(sums[:, : len(mine) - shortest + 1], axis=1)
                out[k, i : i + step] = (sums[:, shortest:] - lows >= -1e-6).any(axis=1)
    return out


def may_be_similar(some: list[Segment], others: list[Segment], todo: np.ndarray, shortest: int, similarity: float) -> np.ndarray:
    """Which pairs of ``todo`` may have a passage, by the tokens of either side that the other has anywhere.

    Of m aligned tokens over a and b places, m / a and m / b are at least s, and one of them 2s / (1 + s), as
    m >= s (a + b - m), a >= m and b >= m.
    """
    shares = similarity, 2 * similarity / (1 + similarity)
    mine, theirs = np.zeros((2, *todo.shape), bool), np.zeros((2, *todo.shape), bool)
    for x in np.flatnonzero(todo.any(axis=1)).tolist():
        at = np.flatnonzero(todo[x])
        mine[:, x, at] = has_stretches(some[x].tokens, [others[y].different for y in at.tolist()], shortest, shares)
    left = todo & mine[0]
    for y in np.flatnonzero(left.any(axis=0)).tolist():
        at = np.flatnonzero(left[:, y])
        theirs[:, at, y] = has_stretches(others[y].tokens, [some[x].different for x in at.tolist()], shortest, shares)
    return left & theirs[0] & (mine[1] | theirs[1])


class Classes:
    """Texts and what links them; a class is named by its smallest text."""

    def __init__(self, names: dict[int, int]):
        self.names = names

    def of(self, text: int) -> int:
        while self.names[text] != text:
            text = self.names[text] = self.names[self.names[text]]
        return text

    def link(self, one: int, other: int) -> None:
        low, high = sorted((self.of(one), self.of(other)))
        self.names[high] = low


def head_passages(members: list[Segment], head: int, classes: Classes, shortest: int, similarity: float) -> Iterator[tuple]:
    """``(segment, other, passage)`` of the members that have a passage of their head."""
    heads = [s for s in members if s.text == head]
    for mine in members:
        for other in heads:
            if classes.of(mine.text) == classes.of(head):
                break
            runs = ((a, b, a - s, b - s, 1.0) for s, _, _ in mine.meets(other) for a, b in mine.same_runs(other, s, shortest))
            found = list(runs) or list(met_passages(mine, other, shortest, similarity))
            if found:
                classes.link(mine.text, head)
            for passage in found:
                yield mine, other, passage


def linking_passages(
    some: list[Segment], others: list[Segment], wanted: Callable[[slice, slice], np.ndarray], classes: Classes,
    shortest: int, similarity: float,
) -> Iterator[tuple]:
    """``(segment, other, passage)`` of pairs that are not in one class until then; the other's text is the smaller.

    ``wanted`` says which pairs of a tile are to be compared, unless they have no signature in common.
    """
    least = int(np.ceil(2 * similarity * shortest / (1 + similarity) - 1e-9))
    for i in range(0, len(some), TILE):
        for j in range(0, len(others), TILE):
            rows, columns = slice(i, i + TILE), slice(j, j + TILE)
            of_rows, of_columns = (np.array([classes.of(s.text) for s in x]) for x in (some[rows], others[columns]))
            todo = wanted(rows, columns) & (of_rows[:, None] != of_columns[None])
            for values, enough, several in (("names", 1, 0), ("numbered", least, FEW)):
                a, b = np.flatnonzero(todo.any(axis=1)), np.flatnonzero(todo.any(axis=0))
                if np.count_nonzero(todo) > several:
                    sides = [[getattr(x[k + y], values) for k in at.tolist()] for x, y, at in ((some, i, a), (others, j, b))]
                    todo[np.ix_(a, b)] &= in_common(*sides) >= enough
            if np.count_nonzero(todo) > FEW:
                todo = may_be_similar(some[rows], others[columns], todo, shortest, similarity)
            for x, y in np.argwhere(todo).tolist():
                one, other = sorted((some[i + x], others[j + y]), key=lambda s: -s.text)
                if classes.of(one.text) == classes.of(other.text):
                    continue
                found = list(met_passages(one, other, shortest, similarity))
                if found:
                    classes.link(one.text, other.text)
                for passage in found:
                    yield one, other, passage


class Texts:
    """The different texts of a chunk, numbered in the order of their keys."""

    def __init__(self, table: pa.Table, n_words: int):
        parts = [pa.ipc.open_stream(pa.py_buffer(blob.as_py())).read_all() for blob in table.column("texts")]
        rows = pa.concat_tables(parts).to_pydict()
        known: dict[bytes, tuple[int | None, str]] = {}
        for key, doc_id, text in zip(rows["key"], rows["doc_id"], rows["text"]):
            if key not in known or doc_id is not None and (known[key][0] is None or doc_id < known[key][0]):
                known[key] = (doc_id, text)
        self.chunk = table.column("chunk")[0].as_py()
        self.n_words = n_words
        self.docs, self.texts = zip(*(known[key] for key in sorted(known)))

    def tokens(self, numbers: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """``(tokens, counts)`` of the texts, or of those with these numbers."""
        texts = self.texts if numbers is None else [self.texts[i] for i in numbers]
        found, times = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        batch = pa.record_batch([pa.array(texts, pa.large_string())], ["text"])
        for part in small_batches(batch):
            hashes, _, counts = word_hashes(part.column("text"), lower=True)
            grams, per_text = windows(hashes, counts, self.n_words)
            found.append(grams)
            times.append(per_text)
        return np.concatenate(found), np.concatenate(times)


def _packed(rows: DataFrame, chunks: int, shortest_text: int) -> DataFrame:
    """``(chunk, texts)``: compressed blocks of different texts, with their smallest id."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        held: dict[bytes, list] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            dealt: dict[int, list[bytes]] = {}
            for key in held:
                dealt.setdefault(int.from_bytes(key[:8], "big") % chunks, []).append(key)
            for chunk, keys in dealt.items():
                columns = [
                    pa.array(keys, pa.binary()),
                    pa.array([held[k][0] for k in keys], pa.int64()),
                    pa.array([held[k][1] for k in keys], pa.large_string()),
                ]
                block = pa.record_batch(columns, ["key", "doc_id", "text"])
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, block.schema, options=options) as writer:
                    writer.write_batch(block)
                blob = pa.array([sink.getvalue().to_pybytes()], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), blob], ["chunk", "texts"])
            held.clear()

        for batch in batches:
            for key, doc_id, text in zip(*(batch.column(c) for c in ("key", "doc_id", "text"))):
                key, doc_id = key.as_py(), doc_id.as_py()
                before = held.get(key)
                if before is not None:
                    if doc_id is not None and (before[0] is None or doc_id < before[0]):
                        before[0] = doc_id
                    continue
                held[key] = [doc_id, text.as_py()]
                size += len(held[key][1]) + 64
                if size > FLUSH_BYTES:
                    yield from flush()
                    size = 0
        yield from flush()

    return rows.where(F.octet_length("text") >= shortest_text).mapInArrow(pack, "chunk BIGINT, texts BINARY")


_POSTS = "signature BIGINT, text BIGINT, place INT"
_SEGMENTS = (
    "head BIGINT, cell INT, n BIGINT, text BIGINT, doc_id BIGINT, begin INT, "
    "tokens BINARY, signatures BINARY, places BINARY"
)
_PASSAGES = (
    "text BIGINT, other_text BIGINT, doc_id BIGINT, other_doc_id BIGINT, start_word INT, end_word INT, "
    "other_start_word INT, other_end_word INT, similarity DOUBLE"
)
#: Where there is a label, the row is a member of a family in several blocks; else, a passage.
_MET = f"head BIGINT, cell INT, block INT, label BIGINT, {_PASSAGES}"
_RESULT = [
    "doc_id", "start_word", "end_word", "end_word - start_word AS n_words",
    "other_doc_id", "other_start_word", "other_end_word", "similarity", "class_id",
]


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


_KINDS = {"BIGINT": pa.int64(), "INT": pa.int32(), "DOUBLE": pa.float64(), "BINARY": pa.binary()}


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = [_KINDS[x.split()[1]] for x in schema.split(", ")]
    lists = list(zip(*rows)) if rows else [[]] * len(kinds)
    return pa.table([pa.array(list(v), k) for v, k in zip(lists, kinds)], names=_names(schema))


def _rows(found: Iterator[tuple], n_words: int) -> list[tuple]:
    """Rows of ``_PASSAGES``, in words."""
    out = []
    for mine, other, (start, end, to_start, to_end, similar) in found:
        ends = start, end + n_words - 1, to_start, to_end + n_words - 1
        out.append((mine.text, other.text, mine.doc_id, other.doc_id, *ends, similar))
    return out


def _groups(posts: DataFrame) -> DataFrame:
    """``(signature, text, place, head, several)``: with each group's first text and the first place in it."""
    heads = posts.groupBy("signature").agg(
        F.min(F.struct("text", "place")).alias("head"), F.max("text").alias("highest"), (F.count("*") > 2).alias("several")
    )
    heads = heads.where("head.text < highest").select("signature", "head", "several")
    return posts.join(heads, "signature")


def _links(groups: DataFrame) -> DataFrame:
    """``(text, head, shift, first, last)``: members and the heads of their groups, and where they meet."""
    met = groups.where("text <> head.text")
    return met.groupBy("text", F.col("head.text").alias("head"), (F.col("place") - F.col("head.place")).alias("shift")).agg(
        F.min("place").alias("first"), F.max("place").alias("last")
    )


def _members(groups: DataFrame) -> DataFrame:
    """``(head, cell, text, place, signature, n)``: families of the members that have one head about one stretch of it.

    ``n`` are the texts of the family.  Only groups in which there is more to meet than the head's first place.
    """
    cell = F.floor(F.col("head.place") / CELL).cast("int")
    rows = groups.where("several").select(F.col("head.text").alias("head"), cell.alias("cell"), "text", "place", "signature")
    sizes = rows.select("head", "cell", "text").distinct().groupBy("head", "cell").agg(F.count("*").alias("n"))
    return rows.join(sizes.hint("merge"), ["head", "cell"])


class _Job:
    """The chunks of a run and what is done with them."""

    def __init__(self, texts, n_words: int, min_words: int, similarity: float, functions: int):
        self.texts = texts
        self.n_words, self.similarity, self.functions = n_words, similarity, functions
        self.shortest = min_words - n_words + 1
        self.width = seed_tokens(n_words, min_words, similarity)

    def posts(self, n_tokens: int) -> DataFrame:
        """``_POSTS``: all intervals whose signature another text has too."""
        width, functions, n_words = self.width, self.functions, self.n_words
        shift = np.uint64(max(0, 64 - n_tokens.bit_length() - SPARE_BITS))
        buckets = 1 + n_tokens // 4 // COUNTED

        def found(own: Texts) -> tuple[np.ndarray, ...]:
            tokens, counts = own.tokens()
            return tokens, counts, *signatures(tokens, counts, width, functions)

        def send(table: pa.Table) -> pa.Table:
            own = Texts(table, n_words)
            _, _, text, _, signature = found(own)
            # Once for each text.
            pairs = np.unique(np.stack((signature >> shift, text.astype(np.uint64)), axis=1), axis=0)
            names, times = np.unique(pairs[:, 0], return_counts=True)
            return send_counts(own.chunk, names, times, 64 - int(shift), buckets)

        def post(table: pa.Table, reply: pa.Table) -> pa.Table:
            own = Texts(table, n_words)
            tokens, counts, text, begin, signature = found(own)
            names = distinct(signature >> shift)
            sums = read_sums(reply, len(names))
            several = sums[np.searchsorted(names, signature >> shift)] > 1 if len(names) else np.zeros(0, bool)
            text, begin, signature = text[several], begin[several], signature[several]
            place = places_of(tokens, begin, width) - (np.cumsum(counts) - counts)[text]
            # A text's intervals with one signature and place are one.
            rows = np.unique(np.stack((signature.view(np.int64), text, place), axis=1), axis=0)
            columns = [rows[:, 0], rows[:, 1] + (own.chunk << 32), rows[:, 2].astype(np.int32)]
            return pa.table([pa.array(c) for c in columns], names=_names(_POSTS))

        sums = summed(self.texts.applyInArrow(send, COUNTS))
        return self.texts.cogroup(sums.groupBy("chunk")).applyInArrow(post, _POSTS)

    def segments(self, members: DataFrame) -> DataFrame:
        """``_SEGMENTS``: the stretches of each member of a family about its places, with its signatures."""
        n_words, apart = self.n_words, 2 * (ROOM + DRIFT)

        def cut(table: pa.Table, asked: pa.Table) -> pa.Table:
            out = []
            if asked.num_rows:
                own = Texts(table, n_words)
                head, cell, text, place, signature, n = (
                    asked.column(c).to_numpy() for c in ("head", "cell", "text", "place", "signature", "n")
                )
                numbers = np.unique(text & 0xFFFFFFFF)
                tokens, counts = own.tokens(numbers.tolist())
                tokens = (tokens >> np.uint64(32)).astype(np.uint32)
                texts = np.split(tokens, np.cumsum(counts)[:-1])
                order = np.lexsort((place, text, cell, head))
                head, cell, text, place, signature, n = (v[order] for v in (head, cell, text, place, signature, n))
                new = np.ones(len(head), bool)
                same = (head[1:] == head[:-1]) & (cell[1:] == cell[:-1]) & (text[1:] == text[:-1])
                new[1:] = ~same | (np.diff(place) > apart)
                starts = np.flatnonzero(new)
                at = np.searchsorted(numbers, text[starts] & 0xFFFFFFFF)
                for i, k, which in zip(starts.tolist(), [*starts[1:].tolist(), len(head)], at.tolist()):
                    begin = max(0, int(place[i]) - apart // 2)
                    out.append(
                        (
                            int(head[i]), int(cell[i]), int(n[i]), int(text[i]), own.docs[numbers[which]], begin,
                            texts[which][begin : int(place[k - 1]) + apart // 2].tobytes(),
                            signature[i:k].tobytes(), place[i:k].astype(np.int32).tobytes(),
                        )
                    )
            return _table(out, _SEGMENTS)

        asked = members.withColumn("chunk", F.shiftright("text", 32))
        return self.texts.cogroup(asked.groupBy("chunk")).applyInArrow(cut, _SEGMENTS)

    def blocks(self, segments: DataFrame) -> DataFrame:
        """``_MET``: each block of a family among itself and with the head."""
        n_words, shortest, similarity = self.n_words, self.shortest, self.similarity
        dealt = segments.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
        own = F.pmod(F.xxhash64("text"), F.col("blocks")).cast("int")
        # The head comes to every block.
        every = F.when(F.col("text") == F.col("head"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(own))
        dealt = dealt.withColumn("block", F.explode(every)).drop("n")

        def compare(table: pa.Table) -> pa.Table:
            rows = table.to_pylist()
            head, cell, block = (rows[0][c] for c in ("head", "cell", "block"))
            members = [Segment(r) for r in sorted(rows, key=lambda r: (r["text"], r["begin"]))]
            text = np.array([s.text for s in members])
            classes = Classes({s.text: s.text for s in members})

            def wanted(a: slice, b: slice) -> np.ndarray:
                return text[a, None] > text[None, b]

            found = _rows(head_passages(members, head, classes, shortest, similarity), n_words)
            found += _rows(linking_passages(members, members, wanted, classes, shortest, similarity), n_words)
            out = [(head, cell, block, None, *r) for r in found]
            if rows[0]["blocks"] > 1:
                out += [(head, cell, block, classes.of(t), t, *[None] * 8) for t in np.unique(text).tolist()]
            return _table(out, _MET)

        # Few bytes and much work: in as many tasks as there may be.
        keys = ["head", "cell", "block"]
        return dealt.repartition(input_tasks(dealt.sparkSession), *keys).groupBy(*keys).applyInArrow(compare, _MET)

    def across(self, segments: DataFrame, labels: DataFrame, alone: DataFrame) -> DataFrame:
        """``_PASSAGES`` of members that are not linked with their head, with members of all other blocks.

        ``labels`` are the members, classes and blocks of the first comparison, ``alone`` how many of a family are to ask.
        """
        n_words, shortest, similarity = self.n_words, self.shortest, self.similarity
        keys = ["head", "cell"]
        dealt = segments.join(labels.hint("merge"), [*keys, "text"]).join(alone, keys)
        dealt = dealt.withColumn("askers", F.ceil(F.col("m") / ASKING).cast("int"))
        dealt = dealt.withColumn("blocks", F.ceil(F.col("n") / ASKING).cast("int"))
        asked = "transform(sequence(0, askers - 1), i -> named_struct('asks', false, 'low', i, 'high', int(pmod(xxhash64(text, 1), blocks))))"
        asking = "transform(sequence(0, blocks - 1), i -> named_struct('asks', true, 'low', int(pmod(xxhash64(text, 2), askers)), 'high', i))"
        roles = F.explode(F.expr(f"CASE WHEN label = head THEN {asked} ELSE concat({asked}, {asking}) END"))
        dealt = dealt.withColumn("role", roles).select("*", "role.asks", "role.low", "role.high").drop("role", "blocks", "askers", "n", "m")

        def compare(table: pa.Table) -> pa.Table:
            rows = sorted(table.to_pylist(), key=lambda r: (r["text"], r["begin"]))
            sides = [[r for r in rows if r["asks"] is asks] for asks in (True, False)]
            (text, block, label), (to_text, to_block, to_label) = (
                [np.array([r[c] for r in side], np.int64) for c in ("text", "block", "label")] for side in sides
            )
            head = rows[0]["head"]
            # Labels are texts of their class, though they may not be here.
            classes = Classes({r["label"]: r["label"] for r in rows} | {r["text"]: r["label"] for r in rows})

            def wanted(a: slice, b: slice) -> np.ndarray:
                # Of two that ask, the later one does.
                once = (to_label[None, b] == head) | (text[a, None] > to_text[None, b])
                return once & (block[a, None] != to_block[None, b])

            some, others = ([Segment(r) for r in side] for side in sides)
            return _table(_rows(linking_passages(some, others, wanted, classes, shortest, similarity), n_words), _PASSAGES)

        keys += ["low", "high"]
        return dealt.repartition(input_tasks(dealt.sparkSession), *keys).groupBy(*keys).applyInArrow(compare, _PASSAGES)

    def met(self, members: DataFrame) -> DataFrame:
        """``_PASSAGES`` that link the members of each family: whoever have one are in one class then."""
        rows = stored(self.blocks(self.segments(members)))
        found = rows.where("label IS NULL").select(*_names(_PASSAGES))
        labels = rows.where("label IS NOT NULL").select("head", "cell", "text", "label", "block")
        # The head is in each of the blocks.
        labels = labels.dropDuplicates(["head", "cell", "text"])
        alone = stored(labels.where("label <> head").groupBy("head", "cell").agg(F.count("*").alias("m")))
        if alone.isEmpty():
            return found
        asked = members.join(alone.hint("merge"), ["head", "cell"], "left_semi")
        return found.union(stored(self.across(self.segments(asked), labels, alone.hint("merge"))))

    def compared(self, links: DataFrame) -> DataFrame:
        """``_PASSAGES`` of linked texts."""
        n_words, shortest, similarity = self.n_words, self.shortest, self.similarity
        begin = F.greatest(F.floor((F.col("first") - F.col("shift") - ROOM - DRIFT) / GRID) * GRID, F.lit(0))
        end = F.ceil((F.col("last") - F.col("shift") + ROOM + DRIFT) / GRID) * GRID
        links = links.select("*", begin.cast("int").alias("begin"), end.cast("int").alias("end"))
        asked = links.select("head", "begin", "end", F.shiftright("head", 32).alias("chunk")).distinct()

        def cut(table: pa.Table, wanted: pa.Table) -> pa.Table:
            rows = sorted(wanted.select(["head", "begin", "end"]).to_pylist(), key=lambda r: r["head"])
            docs, slices = [], []
            if rows:
                own = Texts(table, n_words)
                numbers = sorted({r["head"] & 0xFFFFFFFF for r in rows})
                tokens, counts = own.tokens(numbers)
                tokens = (tokens >> np.uint64(32)).astype(np.uint32)
                starts = dict(zip(numbers, zip((np.cumsum(counts) - counts).tolist(), counts.tolist())))
                for r in rows:
                    number = r["head"] & 0xFFFFFFFF
                    start, n = starts[number]
                    docs.append(own.docs[number])
                    slices.append(tokens[start + min(r["begin"], n) : start + min(r["end"], n)].tobytes())
            return pa.table(
                [
                    *[pa.array([r[c] for r in rows], k) for c, k in (("head", pa.int64()), ("begin", pa.int32()), ("end", pa.int32()))],
                    pa.array(docs, pa.int64()),
                    pa.array(slices, pa.binary()),
                ],
                names=["head", "begin", "end", "other_doc_id", "tokens"],
            )

        slices = self.texts.cogroup(asked.groupBy("chunk")).applyInArrow(
            cut, "head BIGINT, begin INT, end INT, other_doc_id BIGINT, tokens BINARY"
        )
        # Never by broadcast: both sides grow with the documents.
        given = links.join(slices.hint("merge"), ["head", "begin", "end"])
        given = given.select("text", "head", "shift", "first", "last", "begin", "other_doc_id", "tokens", F.shiftright("text", 32).alias("chunk"))

        def compare(table: pa.Table, wanted: pa.Table) -> pa.Table:
            out = []
            if wanted.num_rows:
                own = Texts(table, n_words)
                numbers = np.unique(wanted.column("text").to_numpy() & 0xFFFFFFFF).tolist()
                tokens, counts = own.tokens(numbers)
                tokens = (tokens >> np.uint64(32)).astype(np.uint32)
                cuts = dict(zip(numbers, np.split(tokens, np.cumsum(counts)[:-1])))
                for r in wanted.to_pylist():
                    number = r["text"] & 0xFFFFFFFF
                    other = np.frombuffer(r["tokens"], np.uint32)
                    found = passages(cuts[number], other, r["shift"] + r["begin"], r["first"], r["last"], shortest, similarity)
                    for start, end, to_start, to_end, similar in found:
                        out.append(
                            (
                                r["text"], r["head"], own.docs[number], r["other_doc_id"], start, end + n_words - 1,
                                to_start + r["begin"], to_end + r["begin"] + n_words - 1, similar,
                            )
                        )
            return _table(out, _PASSAGES)

        return self.texts.cogroup(given.groupBy("chunk")).applyInArrow(compare, _PASSAGES)


def _described(rows: DataFrame) -> DataFrame:
    """``(key, doc_id, n)``: words of each document."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches(batch):
                n = word_hashes(part.column("text"))[2]
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("doc_id"), pa.array(n.astype(np.int32))], ["key", "doc_id", "n"]
                )

    return rows.mapInArrow(count, "key BINARY, doc_id BIGINT, n INT")


def _classes(found: DataFrame) -> DataFrame:
    """Rows with ``class_id``, the smallest id that they lead to; a text without an id is a node of its own."""
    node = f"coalesce(CAST(%s AS DECIMAL(21, 0)), CAST({NO_ID} + %s AS DECIMAL(21, 0)))"
    other = node % ("other_doc_id", "other_text")
    rows = found.withColumn("node", F.expr(f"coalesce({node % ('doc_id', 'text')}, {other})"))
    labels = components(rows.select(F.col("node").alias("a"), F.expr(other).alias("b")))
    # Two texts with one id are no link, and have no label.
    rows = rows.join(labels.hint("merge"), "node", "left").withColumn("label", F.coalesce("component", "node"))
    return rows.withColumn("class_id", F.expr(f"CASE WHEN label < {NO_ID} THEN CAST(label AS BIGINT) END"))


def shared_passages(
    docs: DataFrame, n_words: int = N_WORDS, min_words: int = MIN_WORDS, functions: int = FUNCTIONS,
    similarity: float = SIMILARITY, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``(doc_id, start_word, end_word, n_words, other_doc_id, other_start_word, other_end_word, similarity, class_id)``.

    A row says that words ``start_word`` to ``end_word`` (exclusive, from 0) of a document stand,
    with at least the given Jaccard similarity of their ``n_words``-word runs, in the other
    document; passages have ``min_words`` words or more on both sides.  ``class_id`` is the smallest id
    that rows lead to from there.  Every two different texts that share a passage have rows, and these
    one class, but not every two have a row of their own: where very many are alike, they have
    rows with one of them.  Of documents with the same text, the one with the smallest id stands for
    all, and each of the others has one row that links its whole text to it.

    Words are runs of bytes other than ASCII white space, A-Z lower-cased.  NULL, empty and shorter
    texts have no passages.  Repeats within one document are not reported, rows that repeat both id
    and text count as one; a NULL id stands for a text only if it has no other.  An empty table gives
    an empty result; other columns are not looked at.
    """
    hashes = [F.lpad(F.hex(F.xxhash64(*x)), 16, "0") for x in ((F.col(text),), (F.lit(1), F.col(text)))]
    rows = docs.where(F.col(text).isNotNull()).select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.col(text).alias("text"),
        F.unhex(F.concat(*hashes)).alias("key"),
    )
    described = stored(_described(rows).where(F.col("n") >= min_words))
    known = described.groupBy("key").agg(F.min("doc_id").alias("first"), F.count("*").alias("times"), F.max("n").alias("n"))
    n_tokens = known.agg(F.sum("n").alias("n")).first()["n"] or 0
    texts = _packed(rows, 1 + n_tokens // CHUNK_WORDS, 2 * min_words - 1).groupBy("chunk")
    job = _Job(texts, n_words, min_words, similarity, functions)
    groups = stored(_groups(stored(job.posts(n_tokens))))
    found = stored(job.compared(stored(_links(groups))))
    found = found.union(job.met(_members(groups)))
    copies = described.join(known.where("times > 1").drop("n").hint("merge"), "key")
    copies = copies.where(~F.col("doc_id").eqNullSafe(F.col("first"))).select(
        "doc_id", F.col("first").alias("other_doc_id"), F.lit(0).alias("start_word"), F.col("n").alias("end_word"),
        F.lit(0).alias("other_start_word"), F.col("n").alias("other_end_word"), F.lit(1.0).alias("similarity"),
    )
    return _classes(found.unionByName(stored(copies), allowMissingColumns=True)).selectExpr(*_RESULT).dropDuplicates()
