"""From raw documents to packed training sequences: a chain of operators, each written and reread.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the stage before it kept.
All stages but the last return the columns of their input.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postsieve.llm import line_dedup, mixing, near_join, packing, quality
from postsieve.llm.common import stored
from postsieve.llm.queries import MIX, PACK, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def apart(docs: DataFrame, names: list[str], stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What the stage returns, with the columns of its input; those it has names of its own for are kept aside."""
    hidden = {name: f"__given_{name}" for name in docs.columns if name in names}
    out = stage(docs.withColumnsRenamed(hidden))
    return out.select(*[F.col(hidden.get(name, name)).alias(name) for name in docs.columns])


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the line labels keep: none that are NULL, empty or short."""
    field = quality.train_field(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, field, carry=True)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that they share with earlier ones; what has no word left goes.

    ``n_chars`` follows the text.  Documents without a repeat stay as they are, NULL and empty texts
    included; of equal ids the order is that of hashes of the text.
    """

    def left(rows: DataFrame) -> DataFrame:
        found = line_dedup.dedup_lines(rows)
        kept = found.where(F.col("removed").isNull() | F.col("text").rlike("[^\\x20\\x09-\\x0D]"))
        length = F.when(F.col("removed").isNull(), F.col("n_chars")).otherwise(F.length("text"))
        return kept.withColumn("n_chars", length.cast("bigint"))

    return apart(docs, ["removed", "n_lines", "removed_words", "__key", "kept"], left)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the smallest id, of equal ones the smallest hash.

    Texts without words all stay; rows that repeat id and text are one row.
    """
    return near_join.distinct_documents(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as many times as their source's target weight asks for, globally shuffled.

    A NULL source is one of its own.  Rows with a NULL id are drawn by their text, repeated rows alike.
    """
    own = ["mix_rate", "mix_count", "mix_copy", "mix_key", "rate", "n_docs"]
    return apart(docs, own, lambda rows: mixing.mix_sources(rows, **MIX))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents' pieces in sequences; copies are told apart by ``part`` and ``row``."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), **PACK)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", good_documents),
    ("line dedup", without_repeated_lines),
    ("n-gram Jaccard join", one_of_each_group),
    ("mixing sources to target weights", mixed_sources),
    ("best-fit packing", packed_sequences),
]

#: Line labels and the packing are not SQL; the tests hold the stages against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
