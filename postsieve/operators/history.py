"""Post history: body-changing events and the newest version of each post."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postsieve.functions import patterns as p
from postsieve.functions.columns import as_list, required


def post_edits(rows: DataFrame) -> DataFrame:
    """History rows that set, edit or roll back the body of a post."""
    return rows.where(required("PostHistoryTypeId", "bigint").isin(*p.BODY_EVENT_TYPES))


def project_history(rows: DataFrame, carry: Sequence[str] = ("dataset",)) -> DataFrame:
    """Raw attributes to typed columns; a missing text is an empty one.

    The creation date stays a string: ISO-8601 dates order correctly as such.
    """
    return rows.select(
        *carry,
        required("PostId", "bigint").alias("post_id"),
        F.col("Id").cast("bigint").alias("event_id"),
        required("CreationDate").alias("creation_date"),
        F.coalesce("Text", F.lit("")).alias("text"),
    )


def latest_version(
    edits: DataFrame, keys: Sequence[str] = ("dataset", "post_id")
) -> DataFrame:
    """Newest text per key; of equally dated ones the lowest event id wins.

    A missing id comes after all ids, and of equal or missing ids the greatest
    text wins, so that the result does not depend on the order of rows.

    Ranking with ``== 1`` lets Spark keep one row per key and map task before the
    shuffle, so a post with any number of edits never gathers in one place.
    """
    newest_first = Window.partitionBy(*as_list(keys)).orderBy(
        F.col("creation_date").desc(), F.col("event_id").asc_nulls_last(), F.col("text").desc()
    )
    return (
        edits.withColumn("version_rank", F.row_number().over(newest_first))
        .where(F.col("version_rank") == 1)
        .drop("version_rank")
    )


def latest_version_by_max(
    edits: DataFrame, keys: Sequence[str] = ("dataset", "post_id")
) -> DataFrame:
    """The same result as one ``max_by`` aggregate."""
    # A NULL is less than any number here, so a missing id loses against all ids.
    recency = F.struct("creation_date", -F.col("event_id"), "text")
    version = F.struct("event_id", "creation_date", "text")
    return (
        edits.groupBy(*as_list(keys))
        .agg(F.max_by(version, recency).alias("version"))
        .select(*as_list(keys), "version.*")
    )
