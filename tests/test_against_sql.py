"""Every query against its SQL, and text blocks of random Markdown against SQL.

The SQL for text blocks reads a text line by line with variables, so agreement
on random texts checks the window form of the rules.
"""

import itertools
import random

import duckdb
import pytest

import __spark_entry__ as entry_module
from postsieve.operators.blocks import text_blocks
from postsieve.operators.folds import text_blocks_by_fold
from postsieve.suite import oracles
from postsieve.suite.oracles import ORACLES
from postsieve.suite.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("documents", "events", "conversations")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(row[i] for i in order) for row in rows)


def test_every_query_is_registered():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(entry_module.queries())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    found = entry_module.queries()[name](spark, SF_DIR)
    expected = duck.execute(entry_module.oracle_sql()[name])
    sql_columns = [column[0] for column in expected.description]
    assert comparable(found.columns, found.collect()) == comparable(
        sql_columns, expected.fetchall()
    )


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).count() > 0


FRAGMENTS = [
    "",
    " ",
    "   ",
    "word",
    "two words",
    "  indented word",
    "    code",
    "\tcode",
    "  \tcode",
    "    }",
    "}",
    "---",
    "слово",
    "`x`",
    "  `y` <br/>",
    "`z`<BR>",
    "`a` b",
    "```",
    "``````",
    "```x```",
    "``` x",
    "  ```lang",
    "<!-- language: lang-js -->",
    "<!-- Language: all -->",
    "<!-- language: x --> tail",
    "<!-- -->",
    "<?-- -->  ",
    "    <!-- -->",
    "<!-- begin snippet: js -->",
    "<!-- begin snippet: js -->var a",
    "<!-- BEGIN snippet: js --><!-- end snippet -->",
    "<!-- end snippet -->",
    "<!-- end snippet --> rest",
    "<pre>",
    "  <pre><code>",
    "<PRE class='a'>x",
    "<pre><code>x</code></pre>",
    "<code>",
    "<code>x<code>y",
    "<code></code>",
    "  <code>x",
    "</code>",
    "</code></pre>",
    "</code>tail",
    "</code></pre> tail",
    "</pre>",
    "</pre>x",
    "</code><script a>",
    "</code>```",
    "<script>",
    "<script a='b'>",
    "<script a>x</script>",
    "<script a></script>",
    "</script>",
    "</script>  ",
    "</script> x",
    "<script a>```",
    "a\rb",
]


def random_texts(n, seed):
    rng = random.Random(seed)
    for i in range(n):
        pool = rng.sample(FRAGMENTS, rng.randint(2, 12))
        lines = rng.choices(pool, k=rng.randint(0, 14))
        breaks = rng.choice([["\r\n"], ["\n"], ["\r\n", "\n", "\n\n", "\r\n\r\n"]])
        text = "".join(itertools.chain(*((line, rng.choice(breaks)) for line in lines)))
        yield i, text + rng.choice(["", "end", "    end", "\r"])


def document_sql(name):
    """SQL of the documents' text blocks by each set of rules."""
    if name.endswith("closed_fences"):
        return ORACLES["document_text_blocks"].replace(oracles.READER, oracles.CLOSING_READER)
    if name.endswith("without_merged"):
        return ORACLES["document_text_blocks"].replace(
            "unnest(types) AS block_type,", "generate_subscripts(texts, 1) AS i, gone, unnest(types) AS block_type,"
        ).replace("m.block_type = 'text'", "m.block_type = 'text' AND NOT list_contains(m.gone, m.i)")
    return ORACLES["document_text_blocks"]


RULES = [
    ("document_text_blocks", {}),
    ("document_text_blocks_closed_fences", {"close_fences": True}),
    ("document_text_blocks_without_merged", {"drop_merged": True}),
]


@pytest.mark.parametrize("name,rules", RULES)
@pytest.mark.parametrize("seed", range(3))
def test_random_texts(spark, seed, name, rules):
    texts = list(random_texts(6000, seed))
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    import pandas as pd

    frame = pd.DataFrame(texts, columns=["doc_id", "text"])  # noqa: F841 (read by DuckDB)
    connection.execute("INSERT INTO documents SELECT * FROM frame")
    expected = {
        row[0]: (row[1], row[2])
        for row in connection.execute(document_sql(name)).fetchall()
    }
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    for form in (text_blocks, text_blocks_by_fold):
        rows = form(df, ["doc_id"], **rules).collect()
        assert len(rows) == len(texts)
        for row in rows:
            found = (len(row.text_blocks), "\n~\n".join(row.text_blocks))
            assert found == expected[row.doc_id], (form, dict(texts)[row.doc_id])
