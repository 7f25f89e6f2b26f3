"""Text blocks of small Markdown texts (all expected values are literal)."""

import pytest

from postsieve.operators.blocks import text_blocks
from postsieve.operators.folds import text_blocks_by_fold

CASES = [
    ("text\r\n\r\n    code\r\n\r\nmore", ["text", "more"]),
    ("text\n\n    code\n\nmore", ["text\n    code\nmore"]),
    ("text\n\n\n    code\n\n\nmore", ["text", "more"]),
    ("text\r\n    code", ["text\n    code"]),
    ("a\r\n```\r\ncode\r\n```\r\nb", ["a"]),
    ("a\r\n``````\r\nb", ["a\n\nb"]),
    ("a\r\n```x```\r\nb", ["a"]),
    ("<pre><code>x</code></pre>\r\nafter", []),
    ("<pre>\r\na\r\n</pre>\r\nb", ["b"]),
    ("<code>q\r\n</code>tail\r\nafter", ["after"]),
    ("</code> tail", [" tail"]),
    ("abc\r\n\r\n    }\r\n\r\ndef", ["abc\n    }\ndef", "def"]),
    ("---\r\n\r\n    x=1", ["---"]),
    ("привет\r\n\r\n    x=1\r\n", ["привет"]),
    ("use\r\n`npm i`\r\nnow", ["use", "now"]),
    ("<!-- language: lang-js -->\r\n\r\n    x\r\n\r\ntext", ["text"]),
    ("    a\r\n<!-- -->\r\n    b\r\n\r\nend", ["end"]),
    (
        "hi\r\n<!-- begin snippet: js hide: false -->\r\nvar a\r\n<!-- end snippet -->\r\nbye",
        ["hi", "bye"],
    ),
    ("<script>\r\nx", ["<script>\nx"]),
    ("<script a>\r\nx\r\n</script>\r\ny", ["y"]),
    ("  <code>x", ["  <code>x"]),
    ("text\r\n   \r\n    code", ["text\n   "]),
    ("", []),
    ("   \r\n", []),
    (None, []),
    # Blank lines of other kinds of space, and odd first characters.
    ("text\r\n\u00a0\r\n    code", ["text\n\u00a0"]),
    ("text\r\n\u2003\x1c\r\n\tcode\r\nmore", ["text\n\u2003\x1c", "more"]),
    ("\u3000```\r\ncode", []),
    ("\ufefftext\r\n\r\n    code", ["\ufefftext"]),
    ("<!--\u00a0language: lang-js\u2003-->\r\nx", ["x"]),
    ("a\rb\r\n\r\n    c", ["a\rb"]),
]


@pytest.fixture(scope="module", params=[text_blocks, text_blocks_by_fold])
def found(spark, request):
    rows = [(i, text) for i, (text, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "id bigint, text string")
    return {r.id: r.text_blocks for r in request.param(df, ["id"]).collect()}


def test_fold_needs_no_shuffle_and_no_key(spark):
    df = spark.createDataFrame([(1, "a\r\n\r\n    x\r\n\r\nb", "s")] * 2, "id bigint, text string, site string")
    found = text_blocks_by_fold(df, ["id"], carry=["site"])
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in found.collect()] == [(1, "s", ["a", "b"])] * 2


@pytest.mark.parametrize("n", [255, 256, 257, 5000])
def test_long_texts_by_either_form(spark, n):
    lines = ["word", "", "    code", "", "`x`", "more words", "---"]
    text = "\r\n".join(lines[i % 7] for i in range(n))
    df = spark.createDataFrame([(1, text)], "id bigint, text string")
    assert text_blocks(df, ["id"]).collect() == text_blocks_by_fold(df, ["id"]).collect()


@pytest.mark.parametrize("case", range(len(CASES)))
def test_case(found, case):
    assert found[case] == CASES[case][1]


CLOSED = [
    ("a\r\n```\r\ncode\r\n```\r\nb", ["a", "b"]),
    ("```\r\ncode\r\n  ```  \r\nb\r\n```\r\nmore code\r\n```\r\nc", ["b", "c"]),
    ("a\r\n``` x\r\ncode\r\n``` y\r\ncode\r\n```\r\nb", ["a", "b"]),
    ("a\r\n```\r\ncode\r\n``````\r\nb\r\n```\r\ncode", ["a", "b"]),
    ("a\r\n    ```\r\nb", ["a\n    ```\nb"]),
    ("a\r\n```\r\ncode", ["a"]),
]


def test_lone_fences_close_if_asked(spark):
    rows = [(i, text) for i, (text, _) in enumerate(CLOSED)]
    df = spark.createDataFrame(rows, "id bigint, text string")
    found = text_blocks(df, ["id"], close_fences=True).orderBy("id").collect()
    assert [r.text_blocks for r in found] == [blocks for _, blocks in CLOSED]


MERGED = [
    ("abc\r\n\r\n    }\r\n\r\ndef", ["abc\n    }\ndef"]),
    ("---\r\n\r\n    x=1\r\n\r\nend", ["end"]),
    ("привет", ["привет"]),
    ("one\r\n\r\n    x = 1\r\n\r\ntwo", ["one", "two"]),
    ("", []),
]


def test_merged_blocks_leave_if_asked(spark):
    rows = [(i, text) for i, (text, _) in enumerate(MERGED)]
    df = spark.createDataFrame(rows, "id bigint, text string")
    found = text_blocks(df, ["id"], drop_merged=True).orderBy("id").collect()
    assert [r.text_blocks for r in found] == [blocks for _, blocks in MERGED]
