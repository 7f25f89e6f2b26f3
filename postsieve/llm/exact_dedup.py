"""Exact duplicates by progressive refinement: length, then prefix hash, then hash of all content.

Each level only looks at groups that the level before left with two rows or more.  Levels one
and two move a few bytes per document; the content is hashed where the table is scanned, so no
text is ever shuffled.  Groups are counted in every map task first, and rows are matched to
their group's result by joins that Spark can split, so a group with most of the rows is no
single task's work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.llm.common import normal_text, stored

#: Characters of the normalised text in the second level's hash.
PREFIX = 256
#: Lengths and groups that survive are sent to all executors while they are no more than this many
#: (24 bytes each).  Beyond it, lengths are joined by a shuffle, and all rows hash their content in
#: the scan; the result is the same.
BROADCAST_GROUPS = 1_000_000


def exact_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    prefix: int = PREFIX,
    broadcast_groups: int = BROADCAST_GROUPS,
    digest: bool = False,
) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept)``, a row per input row.

    Texts are equal if they are identical after each run of ASCII white space is one space; NULL
    counts as empty, and empty texts are equal to each other.  Of a group the smallest id stays,
    NULL ids come last.  Rows that repeat id and text cannot be told apart and share one verdict.
    An empty table gives an empty result; further columns of ``docs`` are not looked at.
    With ``digest`` each row also gets ``text_sha256``, the hex digest of its normalised text.
    """
    normal = normal_text(F.col(text))
    rows = docs.select(F.col(doc_id).alias("doc_id"), normal.alias("normal")).select(
        "doc_id", "normal", F.octet_length("normal").alias("n_bytes")
    )
    # Level 1: lengths that occur more than once.
    lengths = rows.groupBy("n_bytes").agg(F.count("*").alias("n")).where("n > 1").select("n_bytes")
    lengths = stored(lengths)
    if lengths.count() <= broadcast_groups:
        lengths = F.broadcast(lengths)
    # Level 2: of those, prefixes that occur more than once at one length.
    prefixed = rows.withColumn("prefix_hash", F.xxhash64(F.substring("normal", 1, prefix)))
    narrow = prefixed.select("n_bytes", "prefix_hash").join(lengths, "n_bytes", "left_semi")
    pairs = narrow.groupBy("n_bytes", "prefix_hash").agg(F.count("*").alias("n")).where("n > 1")
    survivors = stored(pairs.select("n_bytes", "prefix_hash", F.lit(True).alias("look")))
    # Level 3: full content of the rows in such groups.
    if survivors.count() <= broadcast_groups:
        marked = prefixed.join(F.broadcast(survivors), ["n_bytes", "prefix_hash"], "left")
    else:
        marked = prefixed.withColumn("look", F.lit(True))
    full = F.when(F.col("look"), F.sha2("normal", 256))
    digests = [F.sha2("normal", 256).alias("text_sha256")] if digest else []
    hashed = stored(marked.select("doc_id", "n_bytes", "prefix_hash", full.alias("full"), *digests))
    # Rows that were never looked at are groups of their own; their key only has to spread.
    spread = F.concat(F.lit("row "), F.xxhash64("doc_id", "n_bytes", "prefix_hash"))
    keyed = hashed.withColumn("group", F.coalesce("full", spread))
    groups = (
        keyed.where("full IS NOT NULL")
        .groupBy("group")
        .agg(F.min("doc_id").alias("keep"), F.count("*").alias("n"))
        .where("n > 1")
    )
    matched = keyed.join(groups, "group", "left")
    alone = F.col("n").isNull()
    keep = F.when(alone, F.col("doc_id")).otherwise(F.col("keep"))
    return matched.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("bigint").alias("group_size"),
        (alone | F.col("doc_id").eqNullSafe(keep)).alias("kept"),
        *[name for name in ["text_sha256"] if digest],
    )


def distinct_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one per group, with all their columns.

    Row and verdict meet by id and content hash; of rows repeating both, one stays.
    """
    verdicts = exact_duplicates(docs, doc_id, text, digest=True).where("kept")
    kept = verdicts.select(
        F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__hash")
    ).distinct()
    hashed = docs.withColumn("__row", F.sha2(normal_text(F.col(text)), 256))
    same = F.col(doc_id).eqNullSafe(F.col("__id")) & (F.col("__row") == F.col("__hash"))
    return hashed.join(kept, same, "left_semi").dropDuplicates([doc_id, "__row"]).drop("__row")
