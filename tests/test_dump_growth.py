"""Dumps whose lines, texts and paths are many or long: what is done for each line stays small."""

import time
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from postsieve.functions import patterns as p
from postsieve.sources.dumps import dataset_of, read_elements
from postsieve.suite import views


def test_the_site_is_found_in_linear_time(spark):
    """The pattern used to be tried from every character of every folder in the path."""
    folder = F.lit("file:/" + "x" * 60_000 + "/")
    paths = spark.range(20).select(F.concat(folder, F.col("id").cast("string"), F.lit("%20+/Posts.xml/part-0")).alias("path"))
    start = time.monotonic()
    found = [r[0] for r in paths.select(dataset_of(F.col("path"))).collect()]
    assert found == [f"{i} +" for i in range(20)]
    assert time.monotonic() - start < 8


@pytest.mark.parametrize(
    ("path", "site"),
    [
        ("file:/a/s.example.com/Posts.xml", "s.example.com"),
        ("s.example.com/Comments.xml/part-1", "s.example.com"),
        ("file:/Posts.xml/s/PostHistory.xml/part-1", "s"),
        ("file:/a/Posts.xml/Posts.xml", "a"),
        ("file:/a/s/xPosts.xml", ""),
        ("file:/a/s/Posts.xml/b/c", ""),
    ],
)
def test_sites_of_paths(spark, path, site):
    assert spark.range(1).select(dataset_of(F.lit(path))).first()[0] == site


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_elements_are_matched_once(spark, tmp_path):
    path = tmp_path / "s.example.com" / "Posts.xml"
    path.parent.mkdir()
    path.write_text("<posts>\n<row\n Id='1'\n/> x\n<row/><row />y<row Id=\"2\" ></row>\n<row Id=\"3</posts>", encoding="utf-8")
    found = read_elements(spark, str(tmp_path), None, "posts")
    # Not once to see whether they match and once more to take them out.
    assert _plan(found).count(p.ROW_ATTRIBUTES) == 1
    assert sorted(r.value for r in found.collect()) == sorted(
        ["<row\n Id='1'\n/>", "<row/>", "<row />", '<row Id="2" />', '<row Id="3</posts>']
    )


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Thirty documents with what XML escapes, and ten events for each, some without a date or user."""
    folder = str(tmp_path_factory.mktemp("tables"))
    text = "\n".join(f'a & b <i>"{k}"</i>\t Name="x" of the line' for k in range(60))
    docs = [(i, f"{i} {text}" if i != 3 else None, 10 + i) for i in range(30)]
    spark.createDataFrame(docs, "doc_id bigint, text string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
    kinds = ["signup", "view", "purchase", "click", None]
    events = [(i, datetime(2024, 1, 1, 0, i % 60) if i % 7 else None, i % 20 if i % 11 else None, kinds[i % 5]) for i in range(300)]
    spark.createDataFrame(events, "event_id bigint, ts timestamp, user_id bigint, event_type string").write.parquet(f"{folder}/events.parquet")
    return folder


def test_texts_are_escaped_before_they_are_joined(spark, tables):
    plain = views.xml_lines(views.raw_history(spark, tables))
    once = views.xml_lines(views.raw_history(spark, tables, escaped=True), ["Text"])
    assert sorted(map(str, once.collect())) == sorted(map(str, plain.collect()))
    above, joined, _ = _plan(once).partition("Join")
    # Of the columns printed for each event, only the date is a string that may need it.
    assert joined and "Text#" in above and "replace(Text" not in above


def test_attributes_on_lines_of_their_own(spark, tables):
    history = views.raw_history(spark, tables)
    spread = {r.value for r in views.xml_lines(history, before=views.OVER_LINES).collect()}
    one_line = views.xml_lines(history).withColumn("value", F.regexp_replace("value", r' ([A-Z][A-Za-z]*="[^"]*")', "\n       $1"))
    assert spread == {r.value for r in one_line.collect()}


def test_a_dump_takes_less_room_than_its_texts(spark, tables):
    root = views.write_dump(spark, tables, ["post_history"])
    files = [f for f in Path(root.removeprefix("file://")).rglob("*") if f.is_file()]
    printed = views.xml_lines(views.raw_history(spark, tables))
    assert sum(f.stat().st_size for f in files) < 0.6 * printed.agg(F.sum(F.length("value"))).first()[0]
