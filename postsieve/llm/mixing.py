"""Mix sources to target weights by Poisson replication.

A source's target weight over its share of the documents is the mean number of copies of each
of its documents.  The number of copies is that Poisson distribution's inverse at a uniform
number drawn from a hash of seed and document, so every run and every task agrees.  Copies are
shuffled globally by a second hash.  DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsieve.llm.common import input_tasks, stored

#: A mean above this is drawn as the sum of independent draws of equal, smaller means.
MAX_MEAN = 16.0
#: The inverse is searched up to this count; a mean of MAX_MEAN exceeds it less than once in 2**53.
MAX_COPIES = 80


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of a hash of the parts."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def source_rates(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    source: str = "source",
    epochs: float = 1.0,
) -> DataFrame:
    """``(source, n_docs, rate)``: mean copies of a document of each source.

    ``weights`` are shares of the mixture, scaled to the sources present; a source without one
    weighs 0 (and goes).  Without ``weights`` all sources weigh the same.  The expected size of
    the mixture is ``epochs`` times the number of documents with a source of positive weight or
    not.  NULL is a source of its own, named by the key None.
    """
    counts = docs.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("n_docs"))
    if weights is None:
        weight = F.lit(1.0)
    else:
        weight = F.lit(0.0)
        for name, share in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(share))).otherwise(weight)
    counts = counts.withColumn("weight", weight)
    whole = counts.agg(F.sum("n_docs").alias("all_docs"), F.sum("weight").alias("all_weight"))
    rate = F.col("weight") * F.lit(float(epochs)) * F.col("all_docs") / (F.col("all_weight") * F.col("n_docs"))
    return counts.crossJoin(F.broadcast(whole)).select(  # the other side is one row
        "source", "n_docs", F.coalesce(rate, F.lit(0.0)).alias("rate")
    )


def poisson_steps(mean: Column) -> Column:
    """Cumulative probabilities of 0, 1, 2, ... of a Poisson distribution, MAX_COPIES + 1 of them."""
    start = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("c"), F.array(F.exp(-mean)).alias("steps"))

    def further(state: Column, k: Column) -> Column:
        p = state["p"] * mean / k
        c = state["c"] + p
        return F.struct(p.alias("p"), c.alias("c"), F.concat(state["steps"], F.array(c)).alias("steps"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(MAX_COPIES)), start, further, lambda s: s["steps"])


def poisson_count(steps: Column, u: Column) -> Column:
    """The inverse of the distribution: how many cumulative probabilities ``u`` reaches."""
    return F.size(F.filter(steps, lambda c: c <= u)).cast("bigint")


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    seed: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    epochs: float = 1.0,
    partitions: int | None = None,
) -> DataFrame:
    """All columns of ``docs``, each row as many times as its count, in globally shuffled order.

    Adds ``mix_rate`` (mean), ``mix_copy`` (from 0), ``mix_count`` (copies of this row) and
    ``mix_key`` (a random key, by whose hash copies are dealt to files and by which files are sorted); columns of ``docs`` with these names give way.  Rows
    with equal id draw equal counts; a NULL id is replaced by its text's hash, a NULL text counts
    as empty.  Empty texts are documents as others.  An empty table gives an empty result.

    The rates are a small table, read back with its size known: Spark sends it to the executors
    if it is small and otherwise joins by source, splitting a source that holds many rows.
    """
    own = ["mix_rate", "mix_copy", "mix_count", "mix_key"]
    docs = docs.drop(*own)
    rates = stored(source_rates(docs, weights, source, epochs))
    draws = F.greatest(F.ceil(F.col("rate") / F.lit(MAX_MEAN)), F.lit(1)).cast("int")
    rates = stored(
        rates.withColumn("__draws", draws).select(
            F.col("source").alias("__source"),
            F.col("rate").alias("mix_rate"),
            "__draws",
            poisson_steps(F.col("rate") / F.col("__draws")).alias("__steps"),
        )
    )
    name = F.coalesce(F.col(doc_id).cast("string"), F.md5(F.coalesce(F.col(text), F.lit(""))))
    count = F.aggregate(
        F.sequence(F.lit(1), F.col("__draws")),
        F.lit(0).cast("bigint"),
        lambda n, k: n + poisson_count(F.col("__steps"), uniform(F.lit(seed), k, F.col("__name"))),
    )
    counted = (
        docs.withColumn("__name", name)
        .join(rates, F.col(source).eqNullSafe(F.col("__source")))
        .withColumn("mix_count", count)
        .where("mix_count > 0")
    )
    copies = counted.withColumn(
        "mix_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("mix_count") - 1))
    ).withColumn("mix_key", F.md5(F.concat_ws(":", F.lit("order"), F.lit(seed), "mix_copy", "__name")))
    return (
        copies.repartition(partitions or input_tasks(docs.sparkSession), "mix_key")
        .sortWithinPartitions("mix_key")
        .drop("__name", "__source", "__draws", "__steps")
    )
