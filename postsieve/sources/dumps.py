"""Site dumps: one folder per dataset, tables of ``<row .../>`` elements.

Elements are one to a line (``layout="line"``), or anywhere, over any number of lines
(``layout="element"``).
``<input_dir>/<dataset>/{Posts,Comments,PostHistory}.xml`` may each be a single
file or a folder of part files.  All datasets are read by one scan; the dataset
name is taken from the path and becomes the first key column everywhere.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postsieve.functions import patterns as p
from postsieve.sources.folders import folder_names

# File names of the dump and the attributes used of each table.
TABLE_FILES = {
    "posts": "Posts.xml",
    "comments": "Comments.xml",
    "post_history": "PostHistory.xml",
}
TABLE_ATTRIBUTES = {
    "posts": ("Id", "Score"),
    "comments": ("Id", "PostId", "Score", "Text"),
    "post_history": ("Id", "PostHistoryTypeId", "PostId", "CreationDate", "Text"),
}

# Attributes without which a row is in error, and their types.
REQUIRED_ATTRIBUTES = {
    "posts": {"Id": "bigint", "Score": "bigint"},
    "comments": {"PostId": "bigint", "Score": "bigint", "Text": "string"},
    "post_history": {"PostHistoryTypeId": "bigint", "PostId": "bigint", "CreationDate": "string"},
}

# Keep attribute values exactly as they are: no prefix, no trimming.
_XML_OPTIONS = {"attributePrefix": "", "ignoreSurroundingSpaces": "false"}


def dataset_names(
    spark: SparkSession, input_dir: str, datasets: Iterable[str] | None = None
) -> list[str]:
    """The given datasets, or all folders of the dump.

    Every table is then read by these names, so a site that lacks one of its
    files fails the job whether it was named or found.
    """
    return folder_names(spark, input_dir) if datasets is None else list(datasets)


def table_paths(input_dir: str, datasets: Iterable[str], table: str) -> list[str]:
    """Input paths of one table."""
    return [f"{input_dir.rstrip('/')}/{name}/{TABLE_FILES[table]}" for name in datasets]


def dataset_of(path: Column) -> Column:
    """Dataset name in the path of a table file or of one of its part files."""
    files = "|".join(name.replace(".", r"\.") for name in TABLE_FILES.values())
    # This is done for every line: only the end of the path is looked at, and names are tried from
    # their beginning alone.
    end = F.substring_index(path, "/", -3)
    folder = F.regexp_extract(end, rf"(?<![^/])([^/]++)/(?:{files})(?:/[^/]*+)?$", 1)
    # Paths arrive percent-encoded, where a plus sign stands for itself.
    return F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B")))


def read_lines(
    spark: SparkSession, input_dir: str, datasets: Iterable[str] | None, table: str
) -> DataFrame:
    """``(dataset, value)``: every line of one table's files, of all datasets.

    Line files split at any byte range, so one huge site is read by many tasks.
    """
    return (
        spark.read.option("lineSep", "\n")
        .text(table_paths(input_dir, dataset_names(spark, input_dir, datasets), table))
        .select(dataset_of(F.col("_metadata.file_path")).alias("dataset"), "value")
    )


def row_lines(lines: DataFrame) -> DataFrame:
    """Keep lines holding a row element; XML header and root tags go."""
    return lines.where(F.col("value").rlike(p.ROW_ELEMENT))


def read_elements(
    spark: SparkSession, input_dir: str, datasets: Iterable[str] | None, table: str
) -> DataFrame:
    """``(dataset, value)``: every row element of one table's files, wherever its lines break.

    Files are cut at the elements' beginnings instead of at line ends (``<`` cannot stand in an
    attribute), so that they still split at any byte range and one huge site is read by many tasks.
    What stands behind an element's end goes; an element without one is kept as it is, and fails
    or is reported where it is parsed.
    """
    paths = table_paths(input_dir, dataset_names(spark, input_dir, datasets), table)
    pieces = (
        spark.read.option("lineSep", p.ROW_MARK)
        .text(paths)
        .select(dataset_of(F.col("_metadata.file_path")).alias("dataset"), "value")
        .where(F.col("value").rlike(p.ROW_REST))
    )
    # One pass over a value, which may be long; without an end it stays as it is.
    element = F.regexp_replace("value", p.ROW_ATTRIBUTES + p.ANY_REST, "$1/>")
    return pieces.select("dataset", F.concat(F.lit(p.ROW_MARK), element).alias("value"))


def read_rows(
    spark: SparkSession, input_dir: str, datasets: Iterable[str] | None, table: str, layout: str = "line"
) -> DataFrame:
    """``(dataset, value)``: the row elements of one table in either layout."""
    if layout == "element":
        return read_elements(spark, input_dir, datasets, table)
    if layout != "line":
        raise ValueError(f"unknown layout {layout}")
    return row_lines(read_lines(spark, input_dir, datasets, table))


def row_attributes(
    lines: DataFrame,
    attributes: Iterable[str],
    mode: str = "FAILFAST",
    malformed: str | None = None,
) -> DataFrame:
    """Replace ``value`` by one string column per requested XML attribute.

    Only the named attributes are materialised; absent ones are NULL.  With mode
    ``PERMISSIVE``, a column named ``malformed`` holds rows that are not XML.  The parsed
    struct goes through a generator because a filter on a plain projection would
    be pushed below it together with a second copy of the XML parser.
    """
    names = [*attributes, *([malformed] if malformed else [])]
    schema = ", ".join(f"{name} STRING" for name in names)
    options = {**_XML_OPTIONS, "mode": mode}
    if malformed:
        options["columnNameOfCorruptRecord"] = malformed
    row = F.from_xml("value", schema, options)
    kept = [name for name in lines.columns if name != "value"]
    return lines.select(*kept, F.inline(F.array(row)))


def read_table(
    spark: SparkSession,
    input_dir: str,
    datasets: Iterable[str] | None,
    table: str,
    mode: str = "FAILFAST",
    layout: str = "line",
) -> DataFrame:
    """Scan one table: row elements, attribute columns (all strings)."""
    rows = read_rows(spark, input_dir, datasets, table, layout)
    return row_attributes(rows, TABLE_ATTRIBUTES[table], mode)
