"""Bring scores, text blocks and comments of each post together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from postsieve.functions.columns import as_list, or_empty
from postsieve.operators.blocks import text_blocks
from postsieve.operators.comments import comments_per_post
from postsieve.operators.history import latest_version
from postsieve.operators.posts import positive_score, single_score_per_post

KEYS = ("dataset", "post_id")


def cogroup(
    scores: DataFrame, blocks: DataFrame, comments: DataFrame, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Full outer co-group of the three sides, each unique per key.

    ``(*keys, score, text_blocks, comments)``; an absent score is NULL and an
    absent list empty.  A filter on the score behind it turns the outer joins
    into left ones and moves below them.
    """
    names = as_list(keys)
    return (
        scores.join(blocks, names, "full_outer")
        .join(comments, names, "full_outer")
        .select(
            *names,
            "score",
            or_empty(F.col("text_blocks")).alias("text_blocks"),
            or_empty(F.col("comments")).alias("comments"),
        )
    )


def _scored_prose(
    posts: DataFrame,
    edits: DataFrame,
    names: list[str],
    strict: bool,
    observation: Observation | None,
    rules: dict[str, bool],
) -> tuple[DataFrame, DataFrame]:
    """Positively scored posts, and the same with their text blocks.

    Texts of posts that will be dropped are never taken apart: scores meet the
    newest versions first, one row per post on either side, and ride along.
    """
    # Joins ask for keys that are not NULL on one side only; asking for it here keeps the
    # plans below the posts' shuffle equal, so that Spark runs it once.
    for name in names:
        posts = posts.where(F.col(name).isNotNull())
    scored = positive_score(single_score_per_post(posts, names, strict, observation))
    newest = latest_version(edits, names).select(*names, "text")
    return scored, text_blocks(scored.join(newest, names, "left"), names, carry=["score"], **rules)


def post_records(
    posts: DataFrame,
    comments: DataFrame,
    edits: DataFrame,
    keys: Sequence[str] = KEYS,
    strict: bool = False,
    observation: Observation | None = None,
    **rules: bool,
) -> DataFrame:
    """Records of all positively scored posts, ``(*keys, score, text_blocks, comments)``.

    The same rows as co-grouping everything and filtering last.  Posts, edits and
    comments are shuffled once each, by the keys; all later steps reuse that
    placement.  Comments of other posts leave before they are gathered.

    Every post has one record.  A post with several rows has no score and so no
    record; ``strict`` fails the job, an ``observation`` counts such posts.  ``rules`` are
    options of ``text_blocks``.
    """
    names = as_list(keys)
    scored, prose = _scored_prose(posts, edits, names, strict, observation, rules)
    kept = comments.join(scored.select(*names), names, "left_semi")
    return prose.join(comments_per_post(kept, names), names, "left").select(
        *names, "score", "text_blocks", or_empty(F.col("comments")).alias("comments")
    )


def record_rows(
    posts: DataFrame,
    comments: DataFrame,
    edits: DataFrame,
    keys: Sequence[str] = KEYS,
    strict: bool = False,
    **rules: bool,
) -> DataFrame:
    """Records in long form: ``(*keys, score, part, position, text)``, a row per text.

    For posts with more comments than one value can hold.  ``part`` is ``post`` (one
    row per post, without position and text), ``text_block`` (position from 0) or
    ``comment`` (the position is the comment's id, which orders them).
    """
    names = as_list(keys)
    scored, prose = _scored_prose(posts, edits, names, strict, None, rules)
    columns = [*names, "score"]
    no_position = F.lit(None).cast("bigint").alias("position")
    heads = scored.select(
        *columns, F.lit("post").alias("part"), no_position, F.lit(None).cast("string").alias("text")
    )
    blocks = prose.select(*columns, F.posexplode("text_blocks").alias("position", "text")).select(
        *columns,
        F.lit("text_block").alias("part"),
        F.col("position").cast("bigint").alias("position"),
        "text",
    )
    texts = comments.drop("score").join(scored, names).select(
        *columns, F.lit("comment").alias("part"), F.col("comment_id").alias("position"), "text"
    )
    return heads.unionByName(blocks).unionByName(texts)


def record_items(records: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Records as rows ``(*keys, score, part, ord, text)``, lists unfolded in one pass.

    An empty list is one row without ``ord`` and ``text``.
    """
    names = [*as_list(keys), "score"]
    parts = F.array(
        F.struct(F.lit("text_block").alias("part"), F.col("text_blocks").alias("texts")),
        F.struct(F.lit("comment").alias("part"), F.col("comments").alias("texts")),
    )
    return records.select(*names, F.inline(parts)).select(
        *names, "part", F.posexplode_outer("texts").alias("ord", "text")
    )


def orphan_keys(
    posts: DataFrame, comments: DataFrame, edits: DataFrame, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Keys of comments or edits that have no post row.

    Each side is reduced to its distinct keys, in every map task first.
    """
    names = as_list(keys)
    used = comments.select(*names).distinct().union(edits.select(*names).distinct()).distinct()
    return used.join(posts.select(*names).distinct(), names, "left_anti")
