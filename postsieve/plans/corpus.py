"""From site dumps to a text corpus: all datasets in one job."""

from __future__ import annotations

from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, Row, SparkSession

from postsieve.operators.assemble import post_records, record_rows
from postsieve.operators.comments import project_comments
from postsieve.operators.history import post_edits, project_history
from postsieve.operators.posts import duplicate_posts, project_posts
from postsieve.sinks.json_files import write_json_array, write_jsonl, write_streamed
from postsieve.sources.dumps import dataset_names, read_table
from postsieve.sources.faults import site_faults


def _ambiguous_posts(observation: Observation) -> int:
    """How many posts were counted; none where Spark has dropped the metric with a plan without rows.

    That case is an assertion in Spark.  Anything else that goes wrong is raised.
    """
    try:
        return observation.get["ambiguous_posts"]
    except Py4JJavaError as error:
        if error.java_exception.getClass().getName() != "java.lang.AssertionError":
            raise
        return 0


def _tables(
    spark: SparkSession, input_dir: str, names: Iterable[str], layout: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Posts, comments and edits of the datasets, projected."""
    posts, comments, history = (
        read_table(spark, input_dir, names, table, layout=layout)
        for table in ("posts", "comments", "post_history")
    )
    return project_posts(posts), project_comments(comments), project_history(post_edits(history))


def corpus(
    spark: SparkSession,
    input_dir: str,
    datasets: Iterable[str] | None = None,
    strict: bool = False,
    observation: Observation | None = None,
    layout: str = "line",
    **rules: bool,
) -> DataFrame:
    """Lazy records of the given (or all) datasets under ``input_dir``.

    ``layout`` is that of the files (``sources/dumps.py``), ``rules`` are options of ``text_blocks``.
    """
    names = dataset_names(spark, input_dir, datasets)
    tables = _tables(spark, input_dir, names, layout)
    return post_records(*tables, strict=strict, observation=observation, **rules)


def run(
    spark: SparkSession,
    input_dir: str,
    output_dir: str,
    datasets: Iterable[str] | None = None,
    num_shards: int | None = None,
    json_array: bool = False,
    mode: str = "errorifexists",
    strict: bool = False,
    streamed: bool = False,
    report_dir: str | None = None,
    layout: str = "line",
    **rules: bool,
) -> int:
    """Build the corpus and write it as JSON lines, or as JSON arrays.

    All datasets are one job: every key starts with the dataset, so that equal
    post ids of two sites never meet.  Returns the number of posts without a
    record because they have several rows; with ``report_dir``, they are listed there
    as JSON, by one more pass over the posts.

    ``streamed`` writes JSON lines whose records need not fit in a task.
    """
    names = dataset_names(spark, input_dir, datasets)
    tables = _tables(spark, input_dir, names, layout)
    if report_dir is not None:
        duplicate_posts(tables[0]).write.mode("overwrite").json(report_dir)
    if streamed:
        if json_array or num_shards is not None:
            raise ValueError("streamed records are JSON lines without shards")
        write_streamed(record_rows(*tables, strict=strict, **rules), output_dir, mode, names)
        return duplicate_posts(tables[0]).count()
    observation = Observation("corpus")
    records = post_records(*tables, strict=strict, observation=observation, **rules)
    write = write_json_array if json_array else write_jsonl
    write(records, output_dir, num_shards, mode, names)
    return _ambiguous_posts(observation)


def run_sound_sites(
    spark: SparkSession,
    input_dir: str,
    output_dir: str,
    datasets: Iterable[str] | None = None,
    layout: str = "line",
    **options,
) -> list[Row]:
    """Like ``run``, but a site with faults is left out and does not stop the others.

    All tables are parsed once before, which finds every fault; the sound sites are then one job.
    Returns rows ``(dataset, table_name, fault, n_rows)`` of the others: a few for each.  Output
    that an earlier run has written for them stays.
    """
    names = dataset_names(spark, input_dir, datasets)
    faults = site_faults(spark, input_dir, names, layout).orderBy("dataset", "table_name", "fault").collect()
    faulty = {row["dataset"] for row in faults}
    sound = [name for name in names if name not in faulty]
    if sound:
        run(spark, input_dir, output_dir, sound, layout=layout, **options)
    return faults
