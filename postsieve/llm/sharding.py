"""Contiguous shards of near equal size by prefix sums over the whole table.

Documents are ordered by id.  Every task sums its own part; the parts' totals, one row per task,
give each part its place, and a document goes to the shard in which its middle byte lies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postsieve.llm.common import in_doc_order, running_totals, stored


def document_sizes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, size, text_crc32)``: bytes of the text plus one; a NULL text has none."""
    content = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(content) + 1).cast("bigint").alias("size"),
        F.crc32(content).alias("text_crc32"),
    )


def shards_by_bytes(sizes: DataFrame, n_shards: int) -> DataFrame:
    """Adds ``shard`` (from 0) and ``slot`` (place in the shard, from 0) to ``(doc_id, size, ...)``.

    A shard holds consecutive documents in order of id (NULL first; equal ids by the other
    columns; rows equal in all columns stand next to each other in any order).  A shard's bytes
    differ from an equal share by at most the size of one document; where documents are larger
    than that share, a shard may be empty.  An empty table gives an empty result.
    """
    given = sizes.columns
    parts = stored(in_doc_order(sizes, ["doc_id", *[c for c in given if c != "doc_id"]]))
    totals = parts.groupBy("part").agg(
        F.sum("size").cast("bigint").alias("bytes"), F.count("*").alias("rows")
    )
    spread = running_totals(totals.withColumn("all", F.lit(0)), ["bytes", "rows"], ["all"])
    whole = totals.agg(F.sum("bytes").alias("total"))
    # One row per task, and one row: small whatever the input.
    places = F.broadcast(spread.crossJoin(whole).drop("all"))
    so_far = Window.partitionBy("part").orderBy(*given).rowsBetween(Window.unboundedPreceding, -1)
    inside = parts.select(
        *given,
        "part",
        F.coalesce(F.sum("size").over(so_far), F.lit(0)).alias("inside"),
        F.count("*").over(so_far).alias("ahead"),
    )
    middle = (F.col("bytes_before") + F.col("inside")) * 2 + F.col("size")
    shard = F.least(F.expr("int(middle * n_shards div (total * 2))"), F.lit(n_shards - 1))
    placed = stored(
        inside.join(places, "part")
        .withColumn("middle", middle.cast("decimal(38,0)"))
        .withColumn("n_shards", F.lit(n_shards))
        .select(*given, shard.alias("shard"), (F.col("rows_before") + F.col("ahead")).alias("place"))
    )
    first = placed.groupBy("shard").agg(F.min("place").alias("first"))  # a row per shard
    return placed.join(F.broadcast(first), "shard").select(
        *given, "shard", (F.col("place") - F.col("first")).alias("slot")
    )
