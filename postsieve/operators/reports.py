"""Input quality reports; the strict checks fail on what these count."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.operators.posts import duplicate_posts


def required_attribute_report(rows: DataFrame, attributes: Mapping[str, str]) -> DataFrame:
    """``(attribute, n_rows, n_missing, n_malformed)`` over raw attribute rows.

    ``attributes`` maps a mandatory attribute to its type.  One pass, one row.
    """
    counts = [
        F.struct(
            F.lit(name).alias("attribute"),
            F.count("*").alias("n_rows"),
            F.count_if(F.col(name).isNull()).alias("n_missing"),
            F.count_if(
                F.col(name).isNotNull() & F.col(name).cast("string").try_cast(kind).isNull()
            ).alias("n_malformed"),
        )
        for name, kind in attributes.items()
    ]
    return rows.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))


def unique_score_violations(posts: DataFrame, keys=("dataset", "post_id")) -> DataFrame:
    """``(n_posts, n_rows)``: how many posts have several rows, and those rows."""
    return duplicate_posts(posts, keys).agg(
        F.count("*").alias("n_posts"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows")
    )
