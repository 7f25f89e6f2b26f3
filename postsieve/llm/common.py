"""Helpers of the operators in this subpackage: shared files, row numbers, spread row keys."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def scratch_dir(spark: SparkSession) -> str:
    """A new folder of this run in the shared folder the session names.

    Only a local session may lack ``spark.checkpoint.dir``; on a cluster, files in a folder
    of one machine would be missing on the others.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = f"file://{tempfile.mkdtemp(prefix='postsieve-')}"
    return f"{shared.rstrip('/')}/postsieve-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and read them back: cuts lineage, survives executors."""
    spark = df.sparkSession
    path = scratch_dir(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def input_tasks(spark: SparkSession) -> int:
    """Number of partitions for exchanges whose size the caller does not know better."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def normal_text(text: Column) -> Column:
    """Text with each run of ASCII white space replaced by one space; NULL counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def in_doc_order(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows range-partitioned and sorted by ``keys``, with the partition's number as ``part``."""
    spark = rows.sparkSession
    return (
        rows.repartitionByRange(input_tasks(spark), *keys)
        .sortWithinPartitions(*keys)
        .withColumn("part", F.spark_partition_id())
    )


def running_totals(parts: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """Per ``keys``: sums of ``columns`` over all earlier parts, as ``<column>_before``.

    ``parts`` has one row per part and key, so the window sees as many rows as there are tasks.
    """
    before = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = [F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in columns]
    return parts.select(*keys, "part", *sums)
