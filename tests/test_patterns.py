"""The patterns mean the same in Spark as in Python's ``re``, also outside ASCII."""

import random
import re

from pyspark.sql import functions as F

from postsieve.functions import patterns as p

LINE_PATTERNS = {
    "row": p.ROW_ELEMENT,
    "indented": p.INDENTED_LINE,
    "inline": p.INLINE_CODE_LINE,
    "space": p.WHITESPACE_LINE,
    "language": p.LANGUAGE_LINE,
    "divider": p.DIVIDER_LINE,
    "snippet_begin": p.at_start(p.SNIPPET_BEGIN),
    "snippet_end": p.at_start(p.SNIPPET_END),
    "code_begin": p.at_start(p.CODE_TAG_BEGIN),
    "code_end": p.at_start(p.CODE_TAG_END),
    "script_begin": p.SCRIPT_TAG_BEGIN,
    "script_end": p.SCRIPT_TAG_END,
    "fence": p.FENCE_BEGIN,
    "alnum": p.ASCII_LETTER_OR_DIGIT,
    "special": rf"\A{p.SPECIAL_FIRST_CHARACTER}",
    "non_space": p.NON_SPACE,
}
REMOVALS = {
    "snippet_begin": p.SNIPPET_BEGIN,
    "snippet_end": p.SNIPPET_END,
    "code_begin": p.CODE_TAG_BEGIN,
    "code_end": p.CODE_TAG_END,
    "fence": p.FENCE_BEGIN,
}
PIECES = [
    *"abZ09 \t\r\x0b\x0c\x1c\x1f\x85\xa0  ​ 　﻿",
    *"`<>!?-/}éж漢ſKİı",
    *["```", "    ", "<row ", "<!--", " -->", " language:", " begin snippet", " end snippet"],
    *["<pre>", "<PRE x>", "</pre>", "<code>", "</CODE>", "<script a>", "<ſcrıpt a>", "</script>"],
    *["<br/>", "<br >", " ```", "<!-- language: x-->", "<!-- -->", "<!-- end ſnippet -->"],
]


def in_python(pattern):
    body = pattern.replace(p.SPACE[1:-1], r"\s").replace(r"\z", r"\Z")
    return re.compile(body.replace("(?iu)", ""), re.IGNORECASE if "(?iu)" in pattern else 0)


def random_lines(n):
    rng = random.Random(5)
    return ["".join(rng.choices(PIECES, k=rng.randint(1, 6))) for _ in range(n)]


def test_space_is_python_whitespace():
    spelled_out = re.compile(p.SPACE)
    for code in range(0x110000):
        assert bool(spelled_out.match(chr(code))) == chr(code).isspace(), hex(code)


def test_matches(spark):
    lines = random_lines(30_000)
    df = spark.createDataFrame([(line,) for line in lines], "line string")
    names = list(LINE_PATTERNS)
    compiled = {name: in_python(pattern) for name, pattern in LINE_PATTERNS.items()}
    found = df.select("line", *(F.col("line").rlike(LINE_PATTERNS[n]).alias(n) for n in names))
    hits = dict.fromkeys(names, 0)
    for row in found.collect():
        for name in names:
            expected = compiled[name].search(row.line) is not None
            hits[name] += expected
            assert row[name] == expected, (name, row.line)
    assert all(hits.values()), hits


def test_removals(spark):
    df = spark.createDataFrame([(line,) for line in random_lines(30_000)], "line string")
    names = list(REMOVALS)
    compiled = {name: in_python(pattern) for name, pattern in REMOVALS.items()}
    found = df.select(
        "line", *(F.regexp_replace("line", REMOVALS[n], "").alias(n) for n in names)
    )
    for row in found.collect():
        for name in names:
            assert row[name] == compiled[name].sub("", row.line), (name, row.line)


def test_line_breaks(spark):
    rng = random.Random(6)
    texts = ["".join(rng.choices("a\r\n", k=rng.randint(0, 9))) for _ in range(5000)]
    from postsieve.operators.lines import split_lines

    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    found = {}
    for row in split_lines(df, ["id"]).orderBy("id", "pos").collect():
        found.setdefault(row.id, []).append(row.raw)
    for i, text in enumerate(texts):
        assert found[i] == re.split(p.LINE_BREAK, text), repr(text)
