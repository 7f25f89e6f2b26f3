"""Posts, comments and history on small tables with all the awkward rows."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from postsieve.operators.assemble import (
    cogroup,
    orphan_keys,
    post_records,
    record_items,
    record_rows,
)
from postsieve.operators.comments import comments_per_post, project_comments
from postsieve.operators.history import (
    latest_version,
    latest_version_by_max,
    post_edits,
    project_history,
)
from postsieve.operators.posts import (
    duplicate_posts,
    positive_score,
    project_posts,
    single_score_per_post,
)
from postsieve.operators.reports import required_attribute_report, unique_score_violations

POSTS = [
    ("a", "1", "5"),
    ("a", "2", "0"),
    ("a", "3", "-2"),
    ("a", "4", "7"),
    ("a", "4", "7"),  # repeated id
    ("b", "1", "9"),  # same id on another site
    ("b", "6", "1"),  # neither comments nor history
]
COMMENTS = [
    ("a", "11", "1", "2", "second"),
    ("a", "10", "1", "1", "first"),
    ("a", "12", "1", "0", "unscored"),
    ("a", "13", "2", "3", "on a dropped post"),
    ("b", "10", "1", "1", ""),
    ("b", "14", "99", "4", "orphan"),
]
HISTORY = [
    ("a", "20", "2", "1", "2020-01-01T00:00:00.000", "old"),
    ("a", "21", "5", "1", "2021-01-01T00:00:00.000", "new"),
    ("a", "22", "5", "1", "2021-01-01T00:00:00.000", "same date, later id"),
    ("a", "23", "4", "1", "2022-01-01T00:00:00.000", "a title edit"),
    ("a", "24", "2", "4", "2020-01-01T00:00:00.000", "ambiguous"),
    ("b", "25", "8", "1", "2020-01-01T00:00:00.000", None),
    ("b", "26", "2", "77", "2020-01-01T00:00:00.000", "orphan"),
]


@pytest.fixture(scope="module")
def posts(spark):
    return project_posts(spark.createDataFrame(POSTS, "dataset string, Id string, Score string"))


@pytest.fixture(scope="module")
def comments(spark):
    schema = "dataset string, Id string, PostId string, Score string, Text string"
    return project_comments(spark.createDataFrame(COMMENTS, schema))


@pytest.fixture(scope="module")
def edits(spark):
    schema = (
        "dataset string, Id string, PostHistoryTypeId string, PostId string, "
        "CreationDate string, Text string"
    )
    return project_history(post_edits(spark.createDataFrame(HISTORY, schema)))


def rows(df):
    return sorted(tuple(row) for row in df.collect())


def test_score_is_null_for_repeated_ids(posts):
    scores = {(r.dataset, r.post_id): r.score for r in single_score_per_post(posts).collect()}
    assert scores == {
        ("a", 1): 5,
        ("a", 2): 0,
        ("a", 3): -2,
        ("a", 4): None,
        ("b", 1): 9,
        ("b", 6): 1,
    }


def test_only_positive_scores_stay(posts):
    kept = positive_score(single_score_per_post(posts))
    assert rows(kept) == [("a", 1, 5), ("b", 1, 9), ("b", 6, 1)]


def test_repeated_ids_are_reported(posts):
    assert rows(duplicate_posts(posts)) == [("a", 4, 2)]
    assert rows(unique_score_violations(posts)) == [(1, 2)]


def test_strict_mode_fails_on_repeated_ids(posts):
    with pytest.raises(PySparkException, match="more than one score"):
        single_score_per_post(posts, strict=True).collect()


def test_comments_keep_positive_scores_in_id_order(comments):
    assert rows(comments_per_post(comments)) == [
        ("a", 1, ["first", "second"]),
        ("a", 2, ["on a dropped post"]),
        ("b", 1, [""]),
        ("b", 99, ["orphan"]),
    ]


@pytest.mark.parametrize("find", [latest_version, latest_version_by_max])
def test_newest_version_ties_go_to_the_lowest_id(edits, find):
    assert rows(find(edits).select("dataset", "post_id", "text")) == [
        ("a", 1, "new"),
        ("a", 4, "ambiguous"),
        ("b", 1, ""),
        ("b", 77, "orphan"),
    ]


def test_records(posts, comments, edits):
    assert rows(post_records(posts, comments, edits)) == [
        ("a", 1, 5, ["new"], ["first", "second"]),
        ("b", 1, 9, [], [""]),
        ("b", 6, 1, [], []),
    ]


def test_records_equal_the_filtered_cogroup(posts, comments, edits):
    blocks = latest_version(edits).select(
        "dataset", "post_id", F.array("text").alias("text_blocks")
    )
    grouped = cogroup(single_score_per_post(posts), blocks, comments_per_post(comments))
    assert grouped.count() == 8
    assert grouped.where("score IS NULL").count() == 3
    kept = rows(positive_score(grouped).select("dataset", "post_id", "score", "comments"))
    records = post_records(posts, comments, edits)
    assert kept == rows(records.select("dataset", "post_id", "score", "comments"))


def test_filtered_cogroup_becomes_left_joins(posts, comments, edits):
    blocks = latest_version(edits).select(
        "dataset", "post_id", F.array("text").alias("text_blocks")
    )
    grouped = cogroup(single_score_per_post(posts), blocks, comments_per_post(comments))
    plan = positive_score(grouped)._jdf.queryExecution().optimizedPlan().toString()
    assert "FullOuter" not in plan and "LeftOuter" in plan


def test_orphans(posts, comments, edits):
    assert rows(orphan_keys(posts, comments, edits)) == [("b", 77), ("b", 99)]


def test_missing_and_bad_attributes_are_counted(spark):
    found = spark.createDataFrame(
        [("1", "x"), (None, "2"), ("3", None), ("1.5", "4")], "Id string, Score string"
    )
    report = required_attribute_report(found, {"Id": "bigint", "Score": "bigint"})
    assert rows(report) == [("Id", 4, 1, 1), ("Score", 4, 1, 1)]


@pytest.mark.parametrize("bad", [(None, "1"), ("1", None), ("one", "1")])
def test_missing_or_bad_attributes_fail_the_job(spark, bad):
    found = spark.createDataFrame([("a", *bad)], "dataset string, Id string, Score string")
    with pytest.raises(PySparkException):
        project_posts(found).collect()


def test_missing_attributes_fail_without_ansi_mode_too(spark):
    found = spark.createDataFrame([("a", "one", "1")], "dataset string, Id string, Score string")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(PySparkException, match="malformed attribute Id"):
            project_posts(found).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


# --- posts with many comments, missing ids, ties --------------------------------------


@pytest.fixture(scope="module")
def crowded(spark):
    """Post 0 has a third of all comments, some without id; the rest have few each."""
    n = 900
    post = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 100 + 1)
    return spark.range(n).select(
        F.lit("a").alias("dataset"),
        post.cast("bigint").alias("post_id"),
        F.when(F.col("id") % 10 != 3, F.col("id")).alias("comment_id"),
        F.format_string("text %03d", "id").alias("text"),
    )


def expected_texts(crowded):
    expected = {}
    for row in crowded.orderBy(F.col("comment_id").asc_nulls_last(), "text").collect():
        expected.setdefault(row.post_id, []).append(row.text)
    return expected


def test_comments_without_id_are_kept_and_come_last(crowded):
    found = comments_per_post(crowded).collect()
    assert {r.post_id: r.comments for r in found} == expected_texts(crowded)
    assert len(found) == 101


@pytest.fixture(scope="module")
def scored(spark):
    return spark.range(101).select(
        F.lit("a").alias("dataset"), F.col("id").alias("post_id"), F.lit(3).cast("bigint").alias("score")
    )


@pytest.fixture(scope="module")
def one_edit(spark):
    return spark.createDataFrame(
        [("a", 0, 1, "2020", "prose")],
        "dataset string, post_id bigint, event_id bigint, creation_date string, text string",
    )


def test_every_post_has_one_record(scored, crowded, one_edit):
    records = post_records(scored, crowded, one_edit).collect()
    assert sorted(r.post_id for r in records) == list(range(101))
    assert {r.post_id: r.comments for r in records} == expected_texts(crowded)
    assert [r.text_blocks for r in records if r.post_id == 0] == [["prose"]]


def test_long_form_has_the_same_content(scored, crowded, one_edit):
    found = record_rows(scored, crowded, one_edit).collect()
    assert sorted(r.post_id for r in found if r.part == "post") == list(range(101))
    assert [(r.post_id, r.position, r.text) for r in found if r.part == "text_block"] == [(0, 0, "prose")]
    comments = [r for r in found if r.part == "comment"]
    assert len(comments) == 900 and {r.score for r in found} == {3}
    expected = {(r.post_id, r.comment_id, r.text) for r in crowded.collect()}
    assert {(r.post_id, r.position, r.text) for r in comments} == expected


TIES = [
    ([(None, "a"), (7, "b")], "b"),
    ([(7, "b"), (None, "a"), (3, "c")], "c"),
    ([(None, "a"), (None, "b")], "b"),
    ([(5, "x"), (5, "y")], "y"),
]


@pytest.mark.parametrize("versions, winner", TIES)
@pytest.mark.parametrize("find", [latest_version, latest_version_by_max])
def test_ties_of_versions_are_fixed(spark, find, versions, winner):
    for rows_in in (versions, versions[::-1]):
        edits = spark.createDataFrame(
            [("a", 1, event_id, "2020", text) for event_id, text in rows_in],
            "dataset string, post_id bigint, event_id bigint, creation_date string, text string",
        )
        assert [r.text for r in find(edits).collect()] == [winner]


def test_empty_lists_are_one_row_each(spark):
    records = spark.createDataFrame(
        [("a", 1, 2, ["x", "y"], []), ("a", 2, 3, [], ["z"])],
        "dataset string, post_id bigint, score bigint, text_blocks array<string>, comments array<string>",
    )
    found = record_items(records).select("post_id", "part", "ord", "text")
    assert set(map(tuple, found.collect())) == {
        (1, "text_block", 0, "x"), (1, "text_block", 1, "y"), (1, "comment", None, None),
        (2, "text_block", None, None), (2, "comment", 0, "z"),
    }
