"""Shuffles and scans the plans must, and must not, have."""

import pytest

from postsieve.operators.assemble import post_records
from postsieve.operators.blocks import text_blocks
from postsieve.operators.history import latest_version
from postsieve.suite import views

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    """Plan as for big inputs: no side of a join is small enough to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def initial_plan(df):
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


def final_plan(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("Initial Plan")[0].splitlines()


def shuffles(plan):
    return [
        line for line in plan if "Exchange hashpartitioning" in line and "Reused" not in line
    ]


@pytest.fixture
def inputs(spark, tmp_path):
    """Posts, comments and edits as tables, so that plans hold nothing else."""
    found = []
    for name, view in (("posts", views.posts), ("comments", views.comments), ("edits", views.edits)):
        view(spark, SF_DIR).write.parquet(str(tmp_path / name))
        found.append(spark.read.parquet(str(tmp_path / name)))
    return found


def test_text_blocks_shuffle_texts_once(spark):
    documents = views.table(spark, SF_DIR, "documents")
    plan = initial_plan(text_blocks(documents, ["doc_id"]))
    assert len(shuffles(plan)) == 1
    # The shuffle comes before the lines do: texts move, not lines.
    generate = next(i for i, line in enumerate(plan) if "Generate posexplode" in line)
    assert any("Exchange" in line for line in plan[generate:])
    assert sum("Sort [" in line for line in plan) == 1


def test_text_blocks_read_only_their_columns(spark):
    documents = views.table(spark, SF_DIR, "documents")
    scan = [line for line in initial_plan(text_blocks(documents, ["doc_id"])) if "FileScan" in line]
    assert len(scan) == 1 and "ReadSchema: struct<doc_id:bigint,text:string>" in scan[0]


def test_text_blocks_reuse_the_placement_of_versions(inputs, no_broadcast):
    newest = latest_version(inputs[2])
    assert len(shuffles(initial_plan(text_blocks(newest, ["dataset", "post_id"])))) == 1


def test_versions_are_cut_down_before_the_shuffle(inputs):
    plan = initial_plan(latest_version(inputs[2]))
    exchange = next(i for i, line in enumerate(plan) if "Exchange" in line)
    assert any("WindowGroupLimit" in line for line in plan[exchange:])


def test_records_shuffle_every_table_once(inputs, no_broadcast):
    """Posts, history and comments; the list of posts to keep reuses the posts' shuffle."""
    plan = final_plan(post_records(*inputs))
    assert len(shuffles(plan)) == 3
    assert not any("CartesianProduct" in line or "BroadcastNestedLoop" in line for line in plan)
    assert not any("Broadcast" in line for line in plan)


def test_comments_of_other_posts_are_not_gathered(inputs, no_broadcast):
    plan = final_plan(post_records(*inputs))
    gather = next(i for i, line in enumerate(plan) if "collect_list" in line)
    assert any("LeftSemi" in line for line in plan[gather:])


def test_dropped_posts_are_not_taken_apart(inputs, no_broadcast):
    plan = final_plan(post_records(*inputs))
    explode = next(i for i, line in enumerate(plan) if "Generate posexplode" in line)
    assert any("only_score" in line and "Filter" in line for line in plan[explode:])


def test_no_python_in_any_plan(inputs):
    plan = "\n".join(final_plan(post_records(*inputs)))
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan

