"""Dump-like tables derived from the test parquet tables.

``posts``, ``comments`` and ``history`` carry the attributes of dump rows plus a
``dataset`` name; ``markdown`` gives every document some Markdown structure.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postsieve.operators.comments import project_comments
from postsieve.operators.history import post_edits, project_history
from postsieve.operators.posts import project_posts
from postsieve.sources.dumps import TABLE_FILES
from postsieve.sources.folders import delete_folder, move_folder

DATASETS = ("a.example.com", "b.example.com", "c.example.com")

# Rows of the same shape in every table file: header and root element.
XML_HEADER = '<?xml version="1.0" encoding="utf-8"?>'
ROOT_TAGS = {"posts": "posts", "comments": "comments", "post_history": "posthistory"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Some comments and edits belong to posts that do not exist: their ids are beyond all posts.
ORPHAN_OFFSET = 100_000_000


def _with_orphans(post_id: Column, rest: int) -> Column:
    return F.when(post_id % 50 == rest, post_id + ORPHAN_OFFSET).otherwise(post_id)


def _dataset(post_id: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, DATASETS)), (post_id % len(DATASETS) + 1).cast("int"))


def raw_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc_id = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        _dataset(doc_id).alias("dataset"),
        doc_id.alias("Id"),
        (F.col("n_chars") % 7 - 2).cast("bigint").alias("Score"),
    )


def raw_posts_with_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts, and one further row per conversation turn under the conversation's id."""
    turns = table(spark, sf_dir, "conversations").select(
        _dataset(F.col("conv_id")).alias("dataset"),
        F.col("conv_id").alias("Id"),
        F.col("turn").alias("Score"),
    )
    return raw_posts(spark, sf_dir).unionByName(turns)


def raw_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv_id = F.col("conv_id")
    return table(spark, sf_dir, "conversations").select(
        _dataset(conv_id).alias("dataset"),
        (conv_id * 100 + F.col("turn")).alias("Id"),
        _with_orphans(conv_id, 7).alias("PostId"),
        (F.length("text") % 5 - 1).cast("bigint").alias("Score"),
        F.col("text").alias("Text"),
    )


def markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    def structured(line: Column, pos: Column) -> Column:
        kind = (F.col("doc_id") * 7 + pos * 11) % 29
        forms = [
            F.lit(""),
            F.concat(F.lit("    "), line),
            F.lit(""),
            F.lit("    }"),
            F.concat(F.lit("`x"), pos.cast("string"), F.lit("`")),
            F.lit("<pre><code>"),
            F.lit("</code></pre>"),
            F.lit("<!-- language: lang-js -->"),
            F.lit("<!-- begin snippet: js hide: false -->"),
            F.lit("<!-- end snippet -->"),
            F.lit("<!-- -->"),
            F.lit("   "),
            F.lit("---"),
            F.lit('<script type="a">'),
            F.lit("</script>"),
            F.lit("```"),
            F.lit("``````"),
            F.concat(F.lit("\t"), line),
        ]
        return F.coalesce(F.get(F.array(*forms), kind.cast("int")), line)

    lines = F.transform(F.split("text", "\n"), structured)
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.array_join(lines, "\r\n").alias("Text")
    )


def raw_history(spark: SparkSession, sf_dir: str, escaped: bool = False) -> DataFrame:
    """Every event as a version of the post with its user's number.

    ``escaped``: with texts as they stand in XML, done once for each text and not for each event.
    """
    n_docs = table(spark, sf_dir, "documents").select(F.count("*")).scalar()
    kinds = (("signup", 2), ("view", 4), ("purchase", 5), ("click", 6))
    type_id = F.lit(8)
    for name, number in reversed(kinds):
        type_id = F.when(F.col("event_type") == name, number).otherwise(type_id)
    events = table(spark, sf_dir, "events").select(
        _dataset(F.col("user_id")).alias("dataset"),
        F.col("event_id").alias("Id"),
        _with_orphans(F.col("user_id"), 3).alias("PostId"),
        type_id.alias("PostHistoryTypeId"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("CreationDate"),
        (F.col("event_id") % n_docs).alias("doc_id"),
    )
    # The join makes short rows a thousand times wider, so spread them first; a
    # given number of partitions is not merged again for being small.
    spread = events.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "Id")
    texts = markdown(spark, sf_dir)
    texts = texts.withColumn("Text", _escaped(F.col("Text"))) if escaped else texts
    return spread.join(texts, "doc_id").drop("doc_id")


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project_posts(raw_posts(spark, sf_dir))


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project_comments(raw_comments(spark, sf_dir))


def edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project_history(post_edits(raw_history(spark, sf_dir)))


# Characters that cannot stand in an XML attribute as they are.
_ESCAPES = (
    ("&", "&amp;"),
    ("<", "&lt;"),
    (">", "&gt;"),
    ('"', "&quot;"),
    ("\n", "&#xA;"),
    ("\r", "&#xD;"),
    ("\t", "&#x9;"),
)


def _escaped(value: Column) -> Column:
    for char, entity in _ESCAPES:
        value = F.replace(value, F.lit(char), F.lit(entity))
    return value


def xml_lines(rows: DataFrame, escaped: Collection[str] = (), before: str = " ") -> DataFrame:
    """``(dataset, value)``: rows printed as ``<row A="..." />``; NULLs are left out.

    Columns in ``escaped`` are so already; ``before`` stands before each attribute.
    """
    strings = {name for name, kind in rows.dtypes if kind == "string"}.difference(escaped)

    def attribute(name: str) -> Column:
        value = _escaped(F.col(name)) if name in strings else F.col(name).cast("string")
        printed = F.concat(F.lit(f'{before}{name}="'), value, F.lit('"'))
        return F.coalesce(printed, F.lit(""))

    attributes = [attribute(name) for name in rows.columns if name != "dataset"]
    return rows.select("dataset", F.concat(F.lit("  <row"), *attributes, F.lit(" />")).alias("value"))


def with_root_tags(spark: SparkSession, lines: DataFrame, name: str) -> DataFrame:
    tag = ROOT_TAGS[name]
    outer = [
        F.struct(F.lit(dataset).alias("dataset"), F.lit(value).alias("value"))
        for dataset in DATASETS
        for value in (XML_HEADER, f"<{tag}>", f"</{tag}>")
    ]
    return lines.unionByName(spark.range(1).select(F.inline(F.array(*outer))))


RAW_TABLES = {"posts": raw_posts, "comments": raw_comments, "post_history": raw_history}


def with_blanks_and_signs(rows: DataFrame) -> DataFrame:
    """The same rows with integers as text, some between blanks and some with a plus sign."""

    def written(name: str) -> Column:
        value = F.col(name).cast("string")
        blank = F.concat(F.lit(" "), value, F.lit("  "))
        signed = F.when(F.col(name) >= 0, F.concat(F.lit("+"), value)).otherwise(value)
        return F.when(F.col("Id") % 3 == 0, blank).when(F.col("Id") % 3 == 1, signed).otherwise(value)

    numbers = {"Id", "PostId", "Score", "PostHistoryTypeId"}
    return rows.select(*(written(n).alias(n) if n in numbers else n for n in rows.columns))


def with_faults(rows: DataFrame) -> DataFrame:
    """The same rows with attributes missing where the id is 3, and malformed where it is 5, modulo 41."""
    rest = F.col("Id") % 41
    numbers = {"Id", "PostId", "Score", "PostHistoryTypeId"}

    def faulty(name: str) -> Column:
        value = F.col(name).cast("string")
        if name in numbers:
            value = F.when(rest == 5, F.concat(F.lit("x"), value)).otherwise(value)
        return F.when(rest != 3, value).alias(name)

    return rows.select("dataset", *(faulty(n) for n in rows.columns if n != "dataset"))


def scratch_dir(spark: SparkSession) -> str:
    """A new folder for one run, in the shared folder the session names.

    Only a local session may lack one: other executors do not see this machine's disk.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        return tempfile.mkdtemp(prefix="postsieve-")
    return f"{shared.rstrip('/')}/postsieve-{uuid.uuid4().hex}"


#: Before an attribute on a line of its own.
OVER_LINES = "\n       "


def with_damage(rows: DataFrame, dataset: str, escaped: Collection[str] = ()) -> DataFrame:
    """Rows as XML lines, those of one dataset with faults as in ``with_faults``, or cut short (``CUT_ID``)."""
    own = F.col("dataset") == dataset
    damaged = xml_lines(with_faults(rows.where(own)), escaped)
    cut = F.when(F.col("value").rlike(CUT_ID), F.regexp_replace("value", " />$", "")).otherwise(F.col("value"))
    return xml_lines(rows.where(~own), escaped).unionByName(damaged.select("dataset", cut.alias("value")))


#: Rows whose id ends so are cut short in a damaged dump.
CUT_ID = r'^ *<row Id="[0-9]*77"'


def copy_posts(spark: SparkSession, root: str, source: str, target: str) -> None:
    """A further site with nothing but the posts of another one."""
    lines = spark.read.option("lineSep", "\n").text(f"{root}/{source}/{TABLE_FILES['posts']}")
    lines.write.text(f"{root}/{target}/{TABLE_FILES['posts']}")


def write_dump(
    spark: SparkSession, sf_dir: str, names=tuple(RAW_TABLES), pretty: bool = False, damaged: str | None = None
) -> str:
    """Write the derived tables as a dump and return its folder.

    One write per table; its folders, one per dataset, are then moved to their places.
    Files are compressed: those of one task are read by one task, and there are as many as tasks wrote.
    ``pretty``: with rows over several lines; ``damaged``: with faults in this dataset.
    """
    root = scratch_dir(spark)
    for name in names:
        escaped = ("Text",) if name == "post_history" else ()
        rows = raw_history(spark, sf_dir, escaped=True) if escaped else RAW_TABLES[name](spark, sf_dir)
        if damaged is None:
            printed = xml_lines(rows, escaped, OVER_LINES if pretty else " ")
        else:
            printed = with_damage(rows, damaged, escaped)
        lines = with_root_tags(spark, printed, name)
        lines.write.option("compression", "lz4").partitionBy("dataset").text(f"{root}/_{name}")
        for dataset in DATASETS:
            source = f"{root}/_{name}/dataset={dataset}"
            move_folder(spark, source, f"{root}/{dataset}/{TABLE_FILES[name]}")
        delete_folder(spark, f"{root}/_{name}")
    return root
