import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from postsieve.llm import merkle

from .conftest import CLASHING

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SCHEMA = "doc_id BIGINT, text STRING, source STRING, lang STRING, n_chars BIGINT"
NAMES = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row, text):
    values = [*(row[name] for name in NAMES[:-1]), text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i : i + 8])) for i in range(0, len(below), 8)])
    return levels


def plain_path(levels, place):
    out = []
    for level in levels[:-1]:
        run = place // 8 * 8
        out.append(("".join(level[run:place]), "".join(level[place + 1 : run + 8])))
        place //= 8
    return out


def plain_manifest(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append((row["doc_id"], plain_leaf(row, row["text"]), row))
    trees = {}
    for lang, members in groups.items():
        members.sort(key=lambda m: ((m[0] is not None, m[0] or 0), m[1]))
        trees[lang] = plain_tree([m[1] for m in members])
    order = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    forest = plain_tree([trees[lang][-1][0] for lang in order])
    root = forest[-1][0] if order else None
    out = []
    for place, lang in enumerate(order):
        for i, (doc_id, leaf, row) in enumerate(groups[lang]):
            path = plain_path(trees[lang], i) + plain_path(forest, place)
            text = row["text"]
            if text is not None and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0:
                text = text.translate({ord(c): c.lower() for c in UPPER})
            node = plain_leaf(row, text)
            for left, right in path:
                node = sha(left + node + right)
            proof = sha("".join(left + right for left, right in path))
            out.append((doc_id, leaf, trees[lang][-1][0], root, proof, node, node == root))
    return sorted(map(str, out))


def found(docs):
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    rows = merkle.manifest(docs, changed, F.translate("text", UPPER, UPPER.lower()))
    return sorted(str(tuple(row)) for row in rows.drop("group", "path").collect())


def table(spark, rows, extra=()):
    schema = ", ".join([SCHEMA, *[f"{name} STRING" for name in extra]])
    return spark.createDataFrame([(*row, *["x"] * len(extra)) for row in rows], schema)


AWKWARD = [
    (1, "Some Text", "a", "en", 9),
    (2, None, "a", "en", None),
    (3, "", None, "en", 0),
    (4, "Ünïcödé ÉA 日本語", "c", None, 14),
    (5, "W " * 300_000, "b", "", 600_000),
    (3, "the same id", "b", "en", 11),
    (1, "Some Text", "a", "en", 9),  # a repeated row
    (None, "No id", "b", "de", 5),
    (None, None, None, None, None),
    (-7, "Negative", "b", "Zz", 8),
]
HELPERS = ["pos", "block", "members", "digest", "named", "key", "root", "path", "level0", "top", "n", "at"]


def test_awkward_rows(spark):
    docs = table(spark, AWKWARD, [*CLASHING, *HELPERS])
    assert found(docs) == plain_manifest(docs.collect())


@pytest.mark.parametrize("n", [1, 7, 8, 9, 64, 65, 512, 513, 520, 4097])
def test_one_group_of_any_size(spark, n):
    docs = table(spark, [(i * 3, f"Text {i}", "s", "en", 6) for i in range(n)]).repartition(3)
    assert found(docs) == plain_manifest(docs.collect())


def test_many_groups(spark):
    docs = table(spark, [(i, f"Text {i}", "s", f"l{i % 700}", 6) for i in range(2000)])
    assert found(docs) == plain_manifest(docs.collect())


def test_empty_table(spark):
    assert found(table(spark, [], CLASHING)) == []


def test_untouched_table_verifies(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = merkle.manifest(docs)
    assert rows.count() == docs.count() and rows.where("NOT verified").isEmpty()
