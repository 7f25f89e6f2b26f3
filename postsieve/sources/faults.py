"""What in a dump would stop a run, counted by site, so that one site's fault stays its own."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postsieve.functions import patterns as p
from postsieve.sources.dumps import (
    REQUIRED_ATTRIBUTES,
    TABLE_ATTRIBUTES,
    dataset_names,
    read_rows,
    row_attributes,
    table_paths,
)
from postsieve.sources.folders import exists

MALFORMED_ROW = "malformed row"
MISSING_FILE = "missing file"
_SCHEMA = "dataset STRING, table_name STRING, fault STRING, n_rows BIGINT"


def _number(name: str) -> Column:
    return F.col(name).try_cast("bigint")


#: Rows of which further attributes are asked for; of the others only those named here count.
_USED_ROWS = {
    "comments": (lambda: _number("Score") > 0, {"Score"}),
    "post_history": (lambda: _number("PostHistoryTypeId").isin(*p.BODY_EVENT_TYPES), {"PostHistoryTypeId"}),
}


def row_faults(rows: DataFrame, table: str, malformed: str) -> DataFrame:
    """``(dataset, fault)``: a row for each fault of each of the table's rows.

    ``rows`` were parsed permissively.  Counted is what the projections of the table ask for: a
    comment without a positive score may lack its text, an event that leaves the body alone its date.
    """
    used, always = _USED_ROWS.get(table, (lambda: F.lit(True), set()))
    is_row = F.col(malformed).isNull()
    faults = [F.when(~is_row, F.lit(MALFORMED_ROW))]
    required = REQUIRED_ATTRIBUTES[table]
    for name, kind in required.items():
        asked = is_row if name in always else is_row & F.coalesce(used(), F.lit(False))
        bad = F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull()
        faults.append(F.when(asked & F.col(name).isNull(), F.lit(f"missing attribute {name}")))
        faults.append(F.when(asked & bad, F.lit(f"malformed attribute {name}")))
    if "Id" not in required:  # an id may be missing, but not be something else
        asked = is_row & F.coalesce(used(), F.lit(False))
        faults.append(F.when(asked & F.col("Id").isNotNull() & _number("Id").isNull(), F.lit("malformed attribute Id")))
    found = F.filter(F.array(*faults), lambda fault: fault.isNotNull())
    return rows.select("dataset", F.explode(found).alias("fault"))


def site_faults(
    spark: SparkSession, input_dir: str, datasets: Iterable[str] | None = None, layout: str = "line"
) -> DataFrame:
    """``(dataset, table_name, fault, n_rows)``: everything that would fail a run over these sites.

    One pass over each table.  A missing file has no count.  Sites without a fault have no row.
    """
    names = dataset_names(spark, input_dir, datasets)
    absent, found = [], []
    for table, attributes in TABLE_ATTRIBUTES.items():
        there = []
        for name, path in zip(names, table_paths(input_dir, names, table)):
            if exists(spark, path):
                there.append(name)
            else:
                absent.append((name, table, MISSING_FILE, None))
        if there:
            rows = read_rows(spark, input_dir, there, table, layout)
            parsed = row_attributes(rows, attributes, "PERMISSIVE", malformed="_malformed_row")
            faults = row_faults(parsed, table, "_malformed_row")
            counted = faults.groupBy("dataset", "fault").agg(F.count("*").alias("n_rows"))
            found.append(counted.select("dataset", F.lit(table).alias("table_name"), "fault", "n_rows"))
    out = spark.createDataFrame(absent, _SCHEMA)
    for counted in found:
        out = out.union(counted)
    return out
