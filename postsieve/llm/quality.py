"""Quality rules: base counts, and a linear-chain conditional random field over lines.

Each line of a text gets a few discrete features (length, signs, capitals, repeats, place).  The
field labels lines as content or boilerplate; Viterbi decoding finds the most probable labelling
of the whole text, and the share of words in content lines decides whether the text stays.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.llm.words import mix, small_batches, text_buffer, windows, word_hashes

#: Labelled documents that the field is fitted on at most, those with the smallest hash of the id,
#: and lines of each that are used at most.
MAX_TRAIN_DOCS = 2_000
MAX_TRAIN_LINES = 200
#: A document stays if at least this share of its words is in content lines.
MIN_CONTENT = 0.5
#: Fixed values of the base rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"

CONTENT, BOILERPLATE = 1, 0
# Edges of the classes that a line's figures fall into; each figure has one more class than edges.
_EDGES = {
    "words": [1, 3, 6, 16, 41],
    "symbols_per_word": [0.001, 0.1, 0.5, 1.5],
    "capitals_share": [0.02, 0.1, 0.3, 0.6],
    "exclamations_per_word": [0.001, 0.1, 0.5],
    "digits_share": [0.001, 0.05, 0.2],
    "mean_length": [3, 5, 7, 10],
    "stops_per_word": [0.001, 0.05, 0.2, 0.5],
    "repeats_in_text": [0.5],
    "is_first": [0.5],
    "is_last": [0.5],
}
_WIDTHS = [len(edges) + 1 for edges in _EDGES.values()]
_FIRST = np.concatenate(([0], np.cumsum(_WIDTHS)[:-1]))
N_FEATURES = int(sum(_WIDTHS))


def _class_of(characters: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[ord(c) for c in characters]] = True
    return table


_IS_SYMBOL = _class_of(SYMBOLS)
_IS_CAPITAL = _class_of("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_IS_EXCLAMATION = _class_of("!")
_IS_DIGIT = _class_of("0123456789")
_IS_STOP = _class_of(".?;:,")
_IS_SPACE = _class_of("\t\n\x0b\x0c\r ")


@dataclass
class TextFigures:
    """Base counts per text, and per line of all texts its features and words."""

    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    n_lines: np.ndarray
    line_words: np.ndarray
    line_features: np.ndarray


def _repeat_words(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per text, words inside 3-word windows that the text has at least twice."""
    grams, per_text = windows(hashes, counts, 3)
    owner = np.repeat(np.arange(len(counts)), per_text)
    keyed = mix(grams + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keyed)
    same = keyed[order][1:] == keyed[order][:-1]
    again = np.zeros(len(keyed), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    # Windows of a text start at its first words, in order.
    first_word = np.cumsum(counts) - counts
    first_gram = np.cumsum(per_text) - per_text
    at = np.arange(len(keyed)) - first_gram[owner] + first_word[owner]
    covered = np.zeros(len(hashes), bool)
    for i in range(3):
        covered[at[again] + i] = True
    return np.bincount(np.repeat(np.arange(len(counts)), counts)[covered], minlength=len(counts))


def text_figures(texts: pa.Array) -> TextFigures:
    """Figures of a batch of texts; a NULL text has no words, symbols or lines."""
    flat, offsets = text_buffer(texts)
    hashes, starts, counts = word_hashes(texts)
    has_text = texts.is_valid().to_numpy(zero_copy_only=False)
    feeds = np.flatnonzero(flat == 10)
    begins = np.concatenate((offsets[:-1][has_text], feeds + 1))
    owner = np.concatenate((np.flatnonzero(has_text), np.searchsorted(offsets, feeds, side="right") - 1))
    order = np.lexsort((begins, owner))
    begins, owner = begins[order], owner[order]
    n_lines = np.bincount(owner, minlength=len(counts))
    ends = np.append(begins[1:], len(flat))
    first = np.searchsorted(starts, begins)
    words = np.searchsorted(starts, ends) - first

    def sums(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        total = np.concatenate(([0], np.cumsum(marks)))
        return total[ends] - total[begins], total[offsets[1:]] - total[offsets[:-1]]

    # A code point is a byte that does not continue another.
    characters, word_chars = sums(~_IS_SPACE[flat] & ((flat & 0xC0) != 0x80))
    symbols, n_symbols = sums(_IS_SYMBOL[flat])
    capitals, _ = sums(_IS_CAPITAL[flat])
    exclamations, _ = sums(_IS_EXCLAMATION[flat])
    digits, _ = sums(_IS_DIGIT[flat])
    stops, _ = sums(_IS_STOP[flat])

    repeats = np.zeros(len(begins), np.int64)
    view, seen, last = flat.tobytes(), set(), -1
    for line, (a, b, text, n) in enumerate(zip(begins.tolist(), ends.tolist(), owner.tolist(), words.tolist())):
        if text != last:
            seen, last = set(), text
        if n:
            content = view[a : b - 1] if view[b - 1 : b] == b"\n" else view[a:b]
            if content in seen:
                repeats[line] = 1
            seen.add(content)
    n_dup_lines = np.bincount(owner, weights=repeats, minlength=len(counts)).astype(np.int64)

    per_word, per_char = np.maximum(words, 1), np.maximum(characters, 1)
    is_first = np.append(True, owner[1:] != owner[:-1]) if len(owner) else np.zeros(0, bool)
    is_last = np.append(owner[1:] != owner[:-1], True) if len(owner) else np.zeros(0, bool)
    figures = {
        "words": words,
        "symbols_per_word": symbols / per_word,
        "capitals_share": capitals / per_char,
        "exclamations_per_word": exclamations / per_word,
        "digits_share": digits / per_char,
        "mean_length": characters / per_word,
        "stops_per_word": stops / per_word,
        "repeats_in_text": repeats,
        "is_first": is_first,
        "is_last": is_last,
    }
    features = [np.digitize(figures[k], edges) + f for (k, edges), f in zip(_EDGES.items(), _FIRST)]
    return TextFigures(
        counts, word_chars, n_symbols, n_dup_lines, _repeat_words(hashes, counts), n_lines,
        words, np.stack(features, axis=1),
    )


@dataclass
class LineField:
    """A linear-chain field with two labels: weights of features, and of neighbouring labels."""

    weights: np.ndarray  # (N_FEATURES, 2)
    transitions: np.ndarray  # (2, 2), from row to column

    def scores(self, features: np.ndarray) -> np.ndarray:
        return self.weights[features].sum(axis=1) if len(features) else np.zeros((0, 2))

    def viterbi(self, scores: np.ndarray) -> list[int]:
        """The most probable labels of one text's lines; on a tie, content."""
        if not len(scores):
            return []
        (bb, bc), (cb, cc) = self.transitions.tolist()
        rows = scores.tolist()
        bad, good = rows[0]
        back = []
        for emit_bad, emit_good in rows[1:]:
            bad_bad, good_bad, bad_good, good_good = bad + bb, good + cb, bad + bc, good + cc
            back.append((good_bad >= bad_bad, good_good >= bad_good))
            bad, good = max(bad_bad, good_bad) + emit_bad, max(bad_good, good_good) + emit_good
        label = CONTENT if good >= bad else BOILERPLATE
        labels = [label]
        for step in reversed(back):
            label = int(step[label])
            labels.append(label)
        return labels[::-1]


def fit_field(
    texts: list[tuple[np.ndarray, int]], rounds: int = 150, rate: float = 0.1, penalty: float = 1.0
) -> LineField:
    """Fit the field to texts given as ``(features of lines, quality 0 or 1)``.

    Lines of good documents are content.  A bad document also has ordinary lines, so features
    alone are fitted first, and the lines of bad documents that look like content to that fit
    keep that label; the whole field is then fitted to the labelled sequences by gradient ascent
    on the log-likelihood.  Without both kinds of documents every line is content.
    """
    texts = [(f, q) for f, q in texts if len(f)]
    field = LineField(np.zeros((N_FEATURES, 2)), np.zeros((2, 2)))
    if len({quality for _, quality in texts}) < 2:
        return field
    features = np.concatenate([f for f, _ in texts])
    quality = np.repeat([q for _, q in texts], [len(f) for f, _ in texts])
    share = np.where(quality == 1, 0.5 / max(quality.sum(), 1), 0.5 / max((1 - quality).sum(), 1))
    odds = np.zeros(N_FEATURES)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-odds[features].sum(axis=1)))
        gap = share * (quality - p)
        step = sum(np.bincount(column, weights=gap, minlength=N_FEATURES) for column in features.T)
        odds += 4.0 * (step - 1e-3 * odds)
    looks = odds[features].sum(axis=1) > 0
    labels = np.where((quality == 1) | looks, CONTENT, BOILERPLATE)

    lengths = np.array([len(f) for f, _ in texts])
    order = np.argsort(-lengths, kind="stable")
    n, most = len(texts), int(lengths.max())
    begins = (np.cumsum(lengths) - lengths)[order]
    lengths = lengths[order]
    grid = np.full((n, most), -1, np.int64)
    for row, (begin, length) in enumerate(zip(begins.tolist(), lengths.tolist())):
        grid[row, :length] = np.arange(begin, begin + length)
    alive = [int(np.count_nonzero(lengths > t)) for t in range(most)]
    moments = [np.zeros((N_FEATURES + 2, 2)) for _ in range(2)]
    theta = np.zeros((N_FEATURES + 2, 2))
    truth = _counts(features, np.eye(2)[labels])
    for t in range(1, most):
        k = alive[t]
        np.add.at(truth, (N_FEATURES + labels[grid[:k, t - 1]], labels[grid[:k, t]]), 1.0)
    for step in range(1, rounds + 1):
        field = LineField(theta[:N_FEATURES], theta[N_FEATURES:])
        expected = _expectations(field, features, grid, alive)
        gradient = (truth - expected - penalty * theta) / n
        for moment, value, decay in zip(moments, (gradient, gradient**2), (0.9, 0.999)):
            moment *= decay
            moment += (1 - decay) * value
        scale = np.sqrt(moments[1] / (1 - 0.999**step)) + 1e-8
        theta = theta + rate * (moments[0] / (1 - 0.9**step)) / scale
    return LineField(theta[:N_FEATURES], theta[N_FEATURES:])


def _counts(features: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """Expected feature counts, with two empty rows for transitions."""
    out = np.zeros((N_FEATURES + 2, 2))
    for label in range(2):
        for column in features.T:
            out[:N_FEATURES, label] += np.bincount(column, weights=chance[:, label], minlength=N_FEATURES)
    return out


def _expectations(field: LineField, features: np.ndarray, grid: np.ndarray, alive: list[int]) -> np.ndarray:
    """Expected counts under the field, by forward-backward over all texts side by side."""
    scores, moves = field.scores(features), field.transitions
    most = grid.shape[1]
    ahead = [scores[grid[:, 0]]]
    for t in range(1, most):
        k = alive[t]
        into = np.logaddexp(*[ahead[-1][:k, [i]] + moves[i] for i in range(2)])
        ahead.append(into + scores[grid[:k, t]])
    chance = np.zeros_like(scores)
    pairs = np.zeros((2, 2))
    behind = np.zeros((alive[-1], 2))
    for t in range(most - 1, -1, -1):
        k = alive[t]
        behind = np.concatenate((behind, np.zeros((k - len(behind), 2))))
        joint = ahead[t] + behind
        total = np.logaddexp(joint[:, 0], joint[:, 1])
        chance[grid[:k, t]] = np.exp(joint - total[:, None])
        if t:
            after = scores[grid[:k, t]] + behind
            for i in range(2):
                for j in range(2):
                    pairs[i, j] += np.exp(ahead[t - 1][:k, i] + moves[i, j] + after[:, j] - total).sum()
            behind = np.logaddexp(*[moves[:, j][None, :] + after[:, [j]] for j in range(2)])
    out = _counts(features, chance)
    out[N_FEATURES:] = pairs
    return out


def train_field(
    docs: DataFrame, labels: DataFrame, max_docs: int = MAX_TRAIN_DOCS, max_lines: int = MAX_TRAIN_LINES,
    doc_id: str = "doc_id", text: str = "text",
) -> LineField:
    """Fit the field on at most ``max_docs`` labelled documents (``labels``: doc_id, quality 0/1)."""
    marked = labels.select(F.col("doc_id").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    marked = marked.where("doc_id IS NOT NULL AND quality IN (0, 1)").dropDuplicates(["doc_id"])
    # Half of the sample is of either kind, where there are as many.
    chosen = marked.where("quality = 0").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs // 2)
    chosen = chosen.union(
        marked.where("quality = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs - max_docs // 2)
    )
    sample = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where("text IS NOT NULL")
    sample = sample.join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", "text")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches(batch):
                found = text_figures(part.column("text"))
                lists = np.split(found.line_features, np.cumsum(found.n_lines)[:-1])
                flat = [f[:max_lines].ravel().tolist() for f in lists]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("quality"), pa.array(flat, pa.list_(pa.int32()))],
                    ["doc_id", "quality", "features"],
                )

    rows = sample.mapInArrow(describe, "doc_id BIGINT, quality INT, features ARRAY<INT>")
    # At most max_docs rows of max_lines lines; repeated ids count once.
    found = rows.dropDuplicates(["doc_id"]).orderBy("doc_id").collect()
    width = len(_EDGES)
    return fit_field([(np.array(r["features"], np.int64).reshape(-1, width), r["quality"]) for r in found])


SCHEMA = (
    "doc_id BIGINT, n_words BIGINT, word_chars BIGINT, n_symbols BIGINT, n_dup_lines BIGINT, "
    "n_repeat_words BIGINT, base_failed BOOLEAN, kept BOOLEAN, content_words BIGINT, labels ARRAY<TINYINT>"
)


def judge(
    docs: DataFrame, field: LineField, min_content: float = MIN_CONTENT,
    doc_id: str = "doc_id", text: str = "text", carry: bool = False,
) -> DataFrame:
    """Counts, line labels (1 content, 0 boilerplate) and verdict per document; see ``SCHEMA``.

    A text with fewer than ``MIN_WORDS`` words, or more than half of whose words are in repeated
    3-word windows, fails the base rules and is not kept; of others at least ``min_content`` of
    the words have to be in content lines.  NULL and empty texts have no words and fail.  Each
    row is judged by itself, so ties, repeated rows and NULL ids need no rule; an empty table
    gives an empty result.  With ``carry`` the result is instead the kept rows of ``docs``.
    """
    names = [f.split()[0] for f in SCHEMA.split(", ")]

    def verdicts(batch: pa.RecordBatch, column: str) -> list[np.ndarray | list]:
        found = text_figures(batch.column(column))
        scores = field.scores(found.line_features)
        labels, content, at = [], [], 0
        for n in found.n_lines.tolist():
            own = field.viterbi(scores[at : at + n])
            content.append(int(found.line_words[at : at + n][np.array(own, bool)].sum()) if n else 0)
            labels.append(own)
            at += n
        failed = (found.n_words < MIN_WORDS) | (100 * found.n_repeat_words > MAX_REPEAT_PERCENT * found.n_words)
        kept = ~failed & (np.array(content) >= min_content * found.n_words)
        return [
            found.n_words, found.word_chars, found.n_symbols, found.n_dup_lines, found.n_repeat_words,
            failed, kept, np.array(content), labels,
        ]

    if carry:

        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in small_batches(batch, text):
                    yield part.filter(pa.array(verdicts(part, text)[6]))

        return docs.mapInArrow(keep, docs.schema)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches(batch):
                *plain, labels = verdicts(part, "text")
                columns = [part.column("doc_id"), *[pa.array(v) for v in plain], pa.array(labels, pa.list_(pa.int8()))]
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(describe, SCHEMA)
