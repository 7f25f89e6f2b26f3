"""Connected components of an edge list, by joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of all nodes of ``(a, b)``: the smallest node that links lead to.

    Large-star and small-star steps in turn until nothing changes, each written to the shared
    folder.  Nodes with very many links are aggregated in every map task first, and their rows
    are matched by joins that Spark can split.
    """
    both = "a IS NOT NULL AND b IS NOT NULL AND a <> b"
    current = stored(edges.select("a", "b").where(both).distinct())
    before = None
    while True:
        ways = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = ways.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
        large = (
            ways.where("b > a").join(least, "a").where("b <> low").select("b", F.col("low").alias("a"))
        )
        large = stored(large.select("a", "b").distinct())
        low = large.groupBy("b").agg(F.min("a").alias("low"))
        small = (
            large.join(low, "b")
            .select(F.col("low").alias("a"), F.explode(F.array("a", "b")).alias("b"))
            .where("a <> b")
        )
        current = stored(small.distinct())
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 40))).first()
        if state == before:
            break
        before = state
    roots = current.select(F.col("a").alias("node")).distinct().withColumn("component", F.col("node"))
    return stored(current.select(F.col("b").alias("node"), F.col("a").alias("component")).union(roots))
