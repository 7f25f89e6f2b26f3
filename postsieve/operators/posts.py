"""Posts: projection and one score per post."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from postsieve.functions.columns import as_list, required


def project_posts(rows: DataFrame, carry: Sequence[str] = ("dataset",)) -> DataFrame:
    """Raw attributes to ``(*carry, post_id, score)``."""
    return rows.select(
        *carry,
        required("Id", "bigint").alias("post_id"),
        required("Score", "bigint").alias("score"),
    )


def single_score_per_post(
    posts: DataFrame,
    keys: Sequence[str] = ("dataset", "post_id"),
    strict: bool = False,
    observation: Observation | None = None,
) -> DataFrame:
    """One row per key: its score, or NULL when the key occurs more than once.

    ``strict`` fails the job on such a key instead; an ``observation`` gets their
    number as ``ambiguous_posts`` when the rows are used, at no further pass.  Both
    aggregates combine on the map side, so a key repeated any number of times
    costs one row per task.
    """
    ambiguous = (
        F.raise_error(F.lit("post with more than one score")).cast("bigint")
        if strict
        else F.lit(None).cast("bigint")
    )
    counted = posts.groupBy(*as_list(keys)).agg(
        F.count("*").alias("n_rows"), F.max("score").alias("only_score")
    )
    if observation is not None:
        counted = counted.observe(
            observation, F.count_if(F.col("n_rows") > 1).alias("ambiguous_posts")
        )
    score = F.when(F.col("n_rows") == 1, F.col("only_score")).otherwise(ambiguous)
    return counted.select(*as_list(keys), score.alias("score"))


def duplicate_posts(
    posts: DataFrame, keys: Sequence[str] = ("dataset", "post_id")
) -> DataFrame:
    """Report of keys that have more than one row, with their row count."""
    return (
        posts.groupBy(*as_list(keys))
        .agg(F.count("*").alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )


def positive_score(rows: DataFrame) -> DataFrame:
    """Rows whose score is known and above zero."""
    return rows.where(F.col("score") > 0)
