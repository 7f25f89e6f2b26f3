"""Small tables with every awkward case, and plain versions to compare with."""

import re

import pytest

SPACES = "[\x20\x09-\x0d]+"
LONG = " ".join(f"w{i % 997}x{i // 997}" for i in range(30_000))
PROSE = (
    "the quick brown fox jumps over the lazy dog while seven wizards quietly brew a potion of "
    "elderberries and moonlight behind an old mill where nobody ever looks before the first frost "
    "of a long winter that everyone in the valley has been waiting for since the harvest ended"
)
AWKWARD = [
    (1, "One two  three\tfour five.", "a"),
    (2, "One two three four five.", "a"),
    (3, None, "a"),
    (4, "", "b"),
    (5, " \n\t ", "b"),
    (6, "single", None),
    (7, LONG, "a"),
    (8, LONG + " end", "a"),
    (9, PROSE, "b"),
    (10, PROSE.replace("seven", "eight"), "b"),
    (11, "Ünïcödé ÉÈ 日本語 \U0001f600 text\nwith lines\n\nwith lines\n", "c"),
    (12, "<|endoftext|> is a string here", "c"),
    (9, PROSE, "b"),  # a repeated row
    (9, "other text under the same id", "b"),
    (None, "a text without an id", "c"),
    (None, None, None),
]
#: Extra columns whose names the operators use themselves.
CLASHING = [
    "keep_id", "shard", "part", "row_key", "component_id", "class_id", "removed", "mix_count", "n",
    "size", "group", "word", "token", "start", "place", "n_words", "kept", "labels", "length",
]


def rows_of(spark, rows, extra=()):
    schema = ["doc_id BIGINT", "text STRING", "source STRING", *[f"{name} STRING" for name in extra]]
    return spark.createDataFrame([(*row, *(["x"] * len(extra))) for row in rows], ", ".join(schema))


@pytest.fixture(scope="session")
def awkward(spark):
    return rows_of(spark, AWKWARD, CLASHING).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return rows_of(spark, [], CLASHING)


@pytest.fixture
def sf_dir():
    return "/root/testdata/sf0.001"


def words(text, lower=False):
    text = text or ""
    if lower:
        text = text.translate({c: c + 32 for c in range(65, 91)})
    return [w for w in re.split(SPACES, text) if w]
