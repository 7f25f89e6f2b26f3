"""Score texts with a trigram model kept in an Elias-Fano trie.

Training counts word hashes (a Spark aggregate), then trigrams: tasks sort and count their own,
and send them compressed to the shard that holds their context.  Each shard is built by one
task and written as one file: for each first word a monotone pointer to its range of second words,
for each pair a monotone pointer to its range of third words, word numbers raised range by range
to one monotone sequence per level, and one-byte codes of smoothed probabilities.  Scoring tasks
map the files into memory and find the n-grams of a batch of texts in ascending order, each by
a successor search within its context's range.  Only touched pages are read, and nothing is
broadcast but the shards' bounds.

Probabilities are interpolated with absolute discounting: an n-gram seen c times after a
context seen n times with t successors has ``(c - d) / n``, plus ``d * t / n`` times the
probability after the shorter context.  Below that are the words' own frequencies with 0.5 added.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postsieve.llm.common import in_doc_order, scratch_dir, stored
from postsieve.llm.elias_fano import Sequence, encode, find_in_ranges, join_ranges
from postsieve.llm.words import mix, small_batches, word_hashes

#: Different words that a model may have: their numbers are 31 bits, and two of them 62.
MOST_WORDS = (1 << 31) - 8
#: Discounts of pairs and of triples.
DISCOUNTS = (0.75, 0.9)
#: Tokens of training text per shard of the trie.
SHARD_TOKENS = 2_000_000
#: Tokens that a task counts before it sends them on.
FLUSH_TOKENS = 2_000_000
#: Steps of a code per factor of ten, and the code of what is absent.
CODE_STEPS = 20
ABSENT = 255
#: Hash of the end of a text, a token that no word's hash equals but by chance.
END = int(mix(np.array([0x656E64], np.uint64))[0])
#: In place of a third word, where a text ends at the second.
NO_WORD = -1

_VALUES = np.append(10.0 ** (-np.arange(255) / CODE_STEPS), 0.0)


def _codes(values: np.ndarray) -> np.ndarray:
    steps = np.round(-np.log10(np.clip(values, 1e-300, 1.0)) * CODE_STEPS)
    return np.minimum(steps, ABSENT - 1).astype(np.uint8)


# --- files ------------------------------------------------------------------------


def write_arrays(folder: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    """One file with a JSON header and all arrays, each at a multiple of 64 bytes."""
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    header, at, parts = {}, 0, []
    for key, array in arrays.items():
        array = np.ascontiguousarray(array)
        header[key] = [array.dtype.str, len(array), at]
        padded = -(-array.nbytes // 64) * 64
        parts += [array.tobytes(), bytes(padded - array.nbytes)]
        at += padded
    text = json.dumps(header).encode()
    text += b" " * (-(len(text) + 8) % 64)
    work = posixpath.join(root, f"_{name}-{uuid.uuid4().hex}")
    with store.open_output_stream(work) as stream:
        stream.write(len(text).to_bytes(8, "little"))
        stream.write(text)
        for part in parts:
            stream.write(part)
    store.move(work, posixpath.join(root, name))


def map_arrays(folder: str, name: str) -> dict[str, np.ndarray]:
    """The arrays of a file, mapped into memory where the store is a file system."""
    store, root = fs.FileSystem.from_uri(folder)
    path = posixpath.join(root, name)
    if isinstance(store, fs.LocalFileSystem):
        buffer = pa.memory_map(path).read_buffer()
    else:
        with store.open_input_file(path) as stream:
            buffer = stream.read_buffer()
    size = int.from_bytes(buffer[:8], "little")
    header = json.loads(bytes(buffer[8 : 8 + size]))
    return {
        key: np.frombuffer(buffer, kind, n, 8 + size + at) for key, (kind, n, at) in header.items()
    }


# --- level 1: words ---------------------------------------------------------------


def is_training(doc_id: str = "doc_id", held_out: int = 1, of: int = 5):
    """Whether a document is learned from, by the checksum of its id as text (NULL: as '')."""
    name = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(name.cast("binary")) % of != held_out


def _token_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, each text's words and then its end, and tokens per text."""
    hashes, _, counts = word_hashes(texts, lower=True)
    return np.insert(hashes, np.cumsum(counts), np.uint64(END)), counts + 1


def _counted(values: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if weights is None:
        values = np.sort(values)
    else:
        order = np.argsort(values, kind="stable")
        values, weights = values[order], weights[order]
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, int)
    if weights is None:
        return values[first], np.diff(np.append(first, len(values)))
    return values[first], np.add.reduceat(weights, first) if len(first) else weights


def word_counts(texts: DataFrame) -> DataFrame:
    """``(word, n)`` of ``(text)``: signed word hashes and their counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def row() -> pa.RecordBatch:
            words, n = _counted(*(np.concatenate(x) for x in zip(*held)))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], ["word", "n"])

        for batch in batches:
            for part in small_batches(batch):
                held.append(_counted(_token_hashes(part.column("text"))[0]))
                if sum(len(words) for words, _ in held) > FLUSH_TOKENS:
                    yield row()
        if held:
            yield row()

    found = texts.mapInArrow(count, "word BIGINT, n BIGINT")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Mapped files of sorted word hashes and counts; a word's number is its place over all files."""

    folder: str
    bounds: list[int]  # first hash of each file, unsigned
    offsets: list[int]  # words in earlier files
    names: list[str]
    size: int
    tokens: int
    _files: list = field(default_factory=list, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_files": []}

    def _open(self) -> None:
        if not self._files:
            self._files = [map_arrays(self.folder, name) for name in self.names]

    def counts_from(self, low: int, n: int) -> np.ndarray:
        """Counts of the ``n`` words with numbers from ``low``."""
        self._open()
        out = []
        for file, offset in zip(self._files, self.offsets):
            a, b = max(low - offset, 0), min(low + n - offset, len(file["counts"]))
            if a < b:
                out.append(file["counts"][a:b])
        return np.concatenate(out)

    def lookup(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers (-1 if unknown) and counts of word hashes."""
        self._open()
        numbers, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        if not self.size or not len(hashes):
            return numbers, counts
        known, back = np.unique(hashes, return_inverse=True)
        number, count = np.full(len(known), -1, np.int64), np.zeros(len(known), np.int64)
        cuts = [0, *np.searchsorted(known, np.array(self.bounds[1:], np.uint64)).tolist(), len(known)]
        for file, offset, a, b in zip(self._files, self.offsets, cuts[:-1], cuts[1:]):
            if a < b:
                at = np.searchsorted(file["words"], known[a:b])
                at = np.minimum(at, len(file["words"]) - 1)
                hit = file["words"][at] == known[a:b]
                number[a:b][hit] = offset + at[hit]
                count[a:b][hit] = file["counts"][at[hit]]
        return number[back], count[back]


def write_vocabulary(counts: DataFrame, folder: str) -> Vocabulary:
    """Write files of words in order of unsigned hash, and describe them."""
    unsigned = F.col("word").bitwiseXOR(F.lit(-(1 << 63)))
    placed = in_doc_order(counts.withColumn("order", unsigned), ["order"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts_, part = [], [], None
        for batch in batches:
            words.append(batch.column("word").to_numpy().view(np.uint64))
            counts_.append(batch.column("n").to_numpy())
            part = batch.column("part")[0].as_py() if batch.num_rows else part
        if part is not None:
            all_words, all_counts = np.concatenate(words), np.concatenate(counts_)
            name = f"words-{part:05d}"
            write_arrays(folder, name, {"words": all_words, "counts": all_counts})
            found = [[part], [name], [int(all_words[:1].view(np.int64)[0])], [len(all_words)], [int(all_counts.sum())]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(found, [pa.int32(), pa.string(), *[pa.int64()] * 3])],
                ["part", "name", "first", "n_words", "n_tokens"],
            )

    files = stored(placed.mapInArrow(write, "part INT, name STRING, first BIGINT, n_words BIGINT, n_tokens BIGINT"))
    rows = files.orderBy("part").collect()  # a row per file
    sizes = [r["n_words"] for r in rows]
    if sum(sizes) >= MOST_WORDS:
        raise ValueError(f"{sum(sizes)} different words; their numbers have 31 bits")
    return Vocabulary(
        folder,
        [r["first"] % (1 << 64) for r in rows],
        (np.cumsum(sizes) - sizes).astype(int).tolist() if rows else [],
        [r["name"] for r in rows],
        sum(sizes),
        sum(r["n_tokens"] for r in rows),
    )


# --- levels 2 and 3 -----------------------------------------------------------------


def shard_bounds(vocabulary: Vocabulary, frequent: list[tuple[int, int]], shard_tokens: int) -> np.ndarray:
    """First context (first word * number of words + second word) of each shard.

    Word numbers are in order of hash, so equal ranges of them hold about equal text, but for
    ``frequent`` words ``(number, count)``: such a word has shards of its own, by second word.
    """
    size = max(vocabulary.size, 1)
    n = max(1, -(-vocabulary.tokens // shard_tokens))
    bounds = {size * k // n * size for k in range(n)}
    for number, count in frequent:
        pieces = -(-count // shard_tokens) + 1
        bounds |= {number * size + size * k // pieces for k in range(pieces)} | {(number + 1) * size}
    return np.array(sorted(b for b in bounds if b < size * size), np.int64)


def _sorted_triples(context: np.ndarray, word: np.ndarray, n: np.ndarray):
    order = np.lexsort((word, context))
    context, word, n = context[order], word[order], n[order]
    if not len(context):
        return context, word, n
    new = np.concatenate(([True], (context[1:] != context[:-1]) | (word[1:] != word[:-1])))
    first = np.flatnonzero(new)
    return context[first], word[first], np.add.reduceat(n, first)


def _triples(numbers: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """``(context, third word)`` of all texts; a text's last pair has no third word."""
    last = np.zeros(len(numbers), bool)
    last[np.cumsum(counts) - 1] = True
    first = np.flatnonzero(~last)  # every token but a text's last begins a pair
    context = numbers[first] * size + numbers[first + 1]
    ends = last[first + 1]
    third = np.where(ends, NO_WORD, numbers[np.minimum(first + 2, len(numbers) - 1)])
    return context, third


def triple_counts(texts: DataFrame, vocabulary: Vocabulary, bounds: np.ndarray) -> DataFrame:
    """``(shard, data)``: compressed sorted triples with counts, for the shards they belong to."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        packer = zstandard.ZstdCompressor(level=3)

        def send() -> pa.RecordBatch:
            context, word = (np.concatenate(x) for x in zip(*held))
            held.clear()
            context, word, n = _sorted_triples(context, word, np.ones(len(word), np.int64))
            cuts = np.append(np.searchsorted(context, bounds), len(context)).tolist()
            shards, blobs = [], []
            for shard, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                if a < b:
                    steps = np.diff(context[a:b], prepend=context[a])
                    planes = [
                        np.ascontiguousarray(x).view(np.uint8).reshape(b - a, -1).T.tobytes()
                        for x in (steps, word[a:b].astype(np.int32), n[a:b].astype(np.uint32))
                    ]
                    head = np.array([b - a, context[a]], np.int64).tobytes()
                    shards.append(shard)
                    blobs.append(head + packer.compress(b"".join(planes)))
            return pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), pa.array(blobs, pa.binary())], ["shard", "data"])

        waiting = 0
        for batch in batches:
            for part in small_batches(batch):
                hashes, counts = _token_hashes(part.column("text"))
                numbers, _ = vocabulary.lookup(hashes)
                held.append(_triples(numbers, counts, vocabulary.size))
                waiting += len(hashes)
                if waiting > FLUSH_TOKENS:
                    yield send()
                    waiting = 0
        if held:
            yield send()

    return texts.mapInArrow(count, "shard INT, data BINARY")


def _open_triples(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, first = np.frombuffer(data, np.int64, 2).tolist()
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[16:]), np.uint8)
    steps = np.ascontiguousarray(raw[: 8 * n].reshape(8, n).T).view(np.int64)[:, 0]
    word = np.ascontiguousarray(raw[8 * n : 12 * n].reshape(4, n).T).view(np.int32)[:, 0]
    count = np.ascontiguousarray(raw[12 * n :].reshape(4, n).T).view(np.uint32)[:, 0]
    return first + np.cumsum(steps), word.astype(np.int64), count.astype(np.int64)


def shard_arrays(
    context: np.ndarray, word: np.ndarray, n: np.ndarray, vocabulary: Vocabulary,
    discounts: tuple[float, float],
) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """The levels of one shard from its sorted triples; its first words and their successors.

    How often a word stands before another one is its own count, so a shard that holds only
    some of a frequent word's pairs still knows their probabilities.
    """
    size = vocabulary.size
    new = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1])))
    pair = context[new]
    pair_count = np.add.reduceat(n, new)
    first, second = pair // size, pair % size
    real = word != NO_WORD
    owner = np.repeat(np.arange(len(pair)), np.diff(np.append(new, len(context))))[real]
    followers = np.bincount(owner, minlength=len(pair))
    pointers3 = np.concatenate(([0], np.cumsum(followers)))
    third = word[real]
    low = int(first[0])
    nodes = int(first[-1]) - low + 1
    pointers2 = np.searchsorted(first, np.arange(low, low + nodes + 1))
    counts = np.maximum(vocabulary.counts_from(low, nodes), 1)
    successors = np.diff(pointers2)
    d2, d3 = discounts
    arrays = {
        "range": np.array([low, nodes], np.int64),
        "a2": _codes((pair_count - d2) / counts[first - low]),
        "g2": _codes(d2 * successors / counts),
        "a3": _codes((n[real] - d3) / pair_count[owner]),
        "g3": _codes(d3 * followers / pair_count),
    }
    for name, values in (
        ("pointers2", pointers2), ("pointers3", pointers3),
        ("level2", join_ranges(second, pointers2)), ("level3", join_ranges(third, pointers3)),
    ):
        arrays |= {f"{name}.{key}": array for key, array in encode(values).items()}
    return arrays, np.arange(low, low + nodes), successors


class Shard:
    """One mapped file of the trie."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.low, self.nodes = arrays["range"].tolist()
        part = lambda name: Sequence(
            {k.partition(".")[2]: v for k, v in arrays.items() if k.startswith(name + ".")}
        )
        self.pointers2, self.level2 = part("pointers2"), part("level2")
        self.pointers3, self.level3 = part("pointers3"), part("level3")
        self.a2, self.a3, self.g3 = arrays["a2"], arrays["a3"], arrays["g3"]
        self.g2 = arrays["g2"]

    def pairs(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Places of pairs in level 2, or -1."""
        out = np.full(len(first), -1, np.int64)
        inside = np.flatnonzero((first >= self.low) & (first < self.low + self.nodes))
        out[inside] = find_in_ranges(self.pointers2, self.level2, first[inside] - self.low, second[inside])
        return out

    def triples(self, pair: np.ndarray, third: np.ndarray) -> np.ndarray:
        """Places in level 3 of ``third`` after pairs given by place, or -1."""
        return find_in_ranges(self.pointers3, self.level3, pair, third)


@dataclass
class Model:
    """The mapped trie and its vocabulary."""

    vocabulary: Vocabulary
    folder: str
    bounds: np.ndarray
    built: list[int]  # shards that have a file
    frequent: np.ndarray  # words with more than one shard, ascending
    frequent_g2: np.ndarray  # weight of the shorter context behind each of them
    _open: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_open": {}}

    def shard(self, number: int) -> Shard:
        if number not in self._open:
            self._open[number] = Shard(map_arrays(self.folder, f"shard-{number:06d}"))
        return self._open[number]

    def token_scores(self, texts: pa.Array) -> tuple[np.ndarray, ...]:
        """Per token its log10 base probability, log10 probability and count; tokens per text."""
        vocabulary, size = self.vocabulary, self.vocabulary.size
        hashes, per_text = _token_hashes(texts)
        numbers, counts = vocabulary.lookup(hashes)
        total = vocabulary.tokens + 0.5 * (size + 1)
        p = (counts + 0.5) / total
        base = np.log10(p)
        if not size:
            return base, base, counts, per_text
        start = np.zeros(len(hashes), bool)
        start[np.cumsum(per_text) - per_text] = True
        # Pairs (previous word, word), then triples, each distinct one looked up once, in order.
        at = np.flatnonzero(~start & (np.roll(numbers, 1) >= 0))
        previous = numbers[at - 1]
        keys = previous * size + np.maximum(numbers[at], 0)
        unique, back = np.unique(keys, return_inverse=True)
        place, a2, g2 = self._look_up_pairs(unique)
        unknown = numbers[at] < 0
        p[at] = np.where(unknown, 0.0, _VALUES[a2[back]]) + g2[back] * p[at]
        pair_place = np.full(len(hashes), -1, np.int64)
        pair_place[at] = np.where(unknown, -1, place[back])
        pair_key = np.full(len(hashes), -1, np.int64)
        pair_key[at] = keys
        # A triple's context is the pair that ends at the previous token.
        at = np.flatnonzero(~start & (np.roll(pair_place, 1) >= 0))
        context, where = pair_key[at - 1], pair_place[at - 1]
        order = np.lexsort((numbers[at], context))
        context, where, third = context[order], where[order], numbers[at][order]
        shards = np.searchsorted(self.bounds, context, side="right") - 1
        a3, g3 = np.full(len(at), ABSENT, np.uint8), np.full(len(at), ABSENT, np.uint8)
        for number, run in _runs(shards):
            shard = self.shard(number)
            g3[run] = shard.g3[where[run]]
            known = np.flatnonzero(third[run] >= 0) + run.start
            found = shard.triples(where[known], third[known])
            hit = found >= 0
            a3[known[hit]] = shard.a3[found[hit]]
        chosen = at[order]
        p[chosen] = _VALUES[a3] + _VALUES[g3] * p[chosen]
        return base, np.log10(np.minimum(p, 1.0)), counts, per_text

    def _look_up_pairs(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        place, a2 = np.full(len(keys), -1, np.int64), np.full(len(keys), ABSENT, np.uint8)
        g2 = np.ones(len(keys))
        shards = np.searchsorted(self.bounds, keys, side="right") - 1
        built = set(self.built)
        for number, run in _runs(shards):
            first, second = keys[run] // self.vocabulary.size, keys[run] % self.vocabulary.size
            if number in built:
                shard = self.shard(number)
                found = shard.pairs(first, second)
                place[run] = found
                a2[run] = np.where(found >= 0, shard.a2[np.maximum(found, 0)], ABSENT)
                inside = (first >= shard.low) & (first < shard.low + shard.nodes)
                g2[run] = np.where(inside, _VALUES[shard.g2[np.clip(first - shard.low, 0, shard.nodes - 1)]], 1.0)
        if len(self.frequent):
            first = keys // self.vocabulary.size
            at = np.minimum(np.searchsorted(self.frequent, first), len(self.frequent) - 1)
            g2 = np.where(self.frequent[at] == first, self.frequent_g2[at], g2)
        return place, a2, g2


def _runs(sorted_values: np.ndarray) -> Iterator[tuple[int, slice]]:
    if len(sorted_values):
        cuts = [0, *(np.flatnonzero(np.diff(sorted_values)) + 1).tolist(), len(sorted_values)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield int(sorted_values[a]), slice(a, b)


def train(
    texts: DataFrame, discounts: tuple[float, float] = DISCOUNTS, shard_tokens: int = SHARD_TOKENS
) -> Model:
    """Count ``(text)`` and write the trie to the shared folder."""
    spark: SparkSession = texts.sparkSession
    folder = scratch_dir(spark)
    counts = stored(word_counts(texts))
    vocabulary = write_vocabulary(counts, folder)
    # Fewer than four of these per shard.
    often = counts.where(F.col("n") * 4 > shard_tokens).collect()
    numbers, _ = vocabulary.lookup(np.array([r["word"] for r in often], np.int64).view(np.uint64))
    split = sorted(zip(numbers.tolist(), [r["n"] for r in often]))
    bounds = shard_bounds(vocabulary, split, shard_tokens)
    frequent = np.array([number for number, _ in split], np.int64)

    def build(table: pa.Table) -> pa.Table:
        parts = [_open_triples(x.as_buffer().to_pybytes()) for x in table.column("data")]
        triples = _sorted_triples(*(np.concatenate(x) for x in zip(*parts)))
        arrays, first, successors = shard_arrays(*triples, vocabulary, discounts)
        shard = table.column("shard")[0].as_py()
        write_arrays(folder, f"shard-{shard:06d}", arrays)
        known = np.isin(first, frequent)
        return pa.table(
            {
                "shard": pa.array([shard], pa.int32()),
                "frequent": pa.array([first[known]], pa.list_(pa.int64())),
                "successors": pa.array([successors[known]], pa.list_(pa.int64())),
                "n_pairs": pa.array([len(arrays["a2"])], pa.int64()),
                "n_triples": pa.array([len(arrays["a3"])], pa.int64()),
            }
        )

    schema = "shard INT, frequent ARRAY<BIGINT>, successors ARRAY<BIGINT>, n_pairs BIGINT, n_triples BIGINT"
    built = stored(triple_counts(texts, vocabulary, bounds).groupBy("shard").applyInArrow(build, schema))
    rows = built.collect()  # a row per shard
    successors = np.zeros(len(frequent))
    for row in rows:
        np.add.at(successors, np.searchsorted(frequent, row["frequent"]), row["successors"])
    g2 = discounts[0] * successors / np.maximum([n for _, n in split], 1)
    return Model(vocabulary, folder, bounds, sorted(r["shard"] for r in rows), frequent, g2)


SCHEMA = (
    "doc_id BIGINT, held_out BOOLEAN, n_tokens BIGINT, n_known BIGINT, train_tokens BIGINT, "
    "base_score DOUBLE, score DOUBLE"
)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``SCHEMA`` per row of ``(doc_id, held_out, text)``: sums over the tokens of each text."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches(batch):
                base, best, counts, per_text = model.token_scores(part.column("text"))
                first = np.cumsum(per_text) - per_text
                sums = [np.add.reduceat(x, first) for x in ((counts > 0).astype(np.int64), base, best)]
                train_tokens = np.full(len(first), model.vocabulary.tokens, np.int64)
                columns = [part.column("doc_id"), part.column("held_out"), per_text, sums[0], train_tokens, *sums[1:]]
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c) for c in columns],
                    [f.split()[0] for f in SCHEMA.split(", ")],
                )

    return docs.mapInArrow(read, SCHEMA)


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Learn from the documents that are not held out and score all; see ``SCHEMA``.

    A-Z is lower-cased, tokens are the words between ASCII white space and one end per text; NULL
    and empty texts are that end alone.  Scores are sums of log10 probabilities.  NULL ids count
    as '' when texts are held out.  Repeated rows are learned from, and scored, once each.  With
    nothing to learn from every token has probability one.  An empty table gives an empty result.
    """
    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        (~is_training(doc_id)).alias("held_out"),
        F.col(text).alias("text"),
    )
    model = train(rows.where(~F.col("held_out")).select("text"), **options)
    return score(rows, model)
