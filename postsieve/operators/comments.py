"""Comments: projection, score filter, texts per post."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.functions.columns import as_list, in_order, required


def project_comments(rows: DataFrame, carry: Sequence[str] = ("dataset",)) -> DataFrame:
    """Raw attributes of positively scored comments, ready to be grouped.

    The score is checked on every row; the other attributes only on kept rows.
    """
    return rows.where(required("Score", "bigint") > 0).select(
        *carry,
        required("PostId", "bigint").alias("post_id"),
        F.col("Id").cast("bigint").alias("comment_id"),
        required("Score", "bigint").alias("score"),
        required("Text").alias("text"),
    )


def comments_per_post(
    comments: DataFrame, keys: Sequence[str] = ("dataset", "post_id")
) -> DataFrame:
    """``(*keys, comments)``: all comment texts of each key, one row per key.

    Ordered by comment id, texts without one last, then by text.  A list is one
    value, so it has to fit in a task; ``record_rows`` has no such list.
    """
    names = as_list(keys)
    placed = F.struct(F.col("comment_id").isNull().alias("last"), "comment_id", "text")
    return (
        comments.groupBy(*names)
        .agg(F.collect_list(placed).alias("placed"))
        .select(*names, in_order(F.col("placed"), "text").alias("comments"))
    )
