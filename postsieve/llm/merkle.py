"""A Merkle manifest of a table: digests, proofs, and the fold of proofs back to the root.

Rows are leaves, in order of id within their group (language); every eight neighbours of a level
become one node of the next, up to one subroot a group; the subroots, in order of their groups, are
the leaves of one more such tree.  An aligned block of 512 nodes is one row that keeps each of its
levels as one string of hex digests.  A parent is the hash of a fixed-width substring of the level
below, and a node's siblings are the two substrings beside it in its run.  What blocks come to are
the nodes of the next round, until every group is one node.  So a round moves 1/512 of the rows of
the one before, no task holds more than a block, and a group may be the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsieve.llm.common import in_doc_order, running_totals, stored

FAN_OUT = 8
#: Levels that a block goes up, and so the nodes that it holds.
LEVELS = 3
BLOCK = FAN_OUT**LEVELS
#: Hex digits of a digest.
WIDTH = 64


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def encoded(value: Column) -> Column:
    """``-`` for NULL, else the bytes of the value's text, a colon and the text itself."""
    text = value.cast("string")
    sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(sized, F.lit("-"))


def leaf(values: list[Column]) -> Column:
    return digest(F.concat(*[encoded(v) for v in values]))


def placed(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Adds ``pos``, the row's place (from 0) among those with its ``keys``, by ``order``.

    Rows are sorted once, by ranges of all these columns, so one key may have most of the rows.
    """
    parts = stored(in_doc_order(rows, [*keys, *order]).withColumn("at", F.monotonically_increasing_id()))
    totals = parts.groupBy(*keys, "part").agg(F.count("*").alias("rows"), F.min("at").alias("first"))
    before = running_totals(totals, ["rows"], keys).join(totals.drop("rows"), [*keys, "part"])
    pos = F.col("at") - F.col("first") + F.col("rows_before")
    return parts.join(before, [*keys, "part"]).select(*rows.columns, pos.alias("pos"))


def _parents(level: Column) -> Column:
    run = FAN_OUT * WIDTH
    runs = F.sequence(F.lit(0), (F.ceil(F.length(level) / run) - 1).cast("int"))
    return F.array_join(F.transform(runs, lambda i: digest(F.substr(level, i * run + 1, F.lit(run)))), "")


def blocks_of(nodes: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, block, members, n_levels, level0 ... level3, top)`` of ``(keys, pos, digest, ...)``.

    ``members`` are the nodes in order with all their further columns.  A block goes up all its
    levels, but where its tree ends in it, only up to the one node that is left.
    """
    further = [c for c in nodes.columns if c not in keys]
    sizes = nodes.groupBy(*keys).agg(F.count("*").alias("n"))
    block = F.floor(F.col("pos") / BLOCK).alias("block")
    # The place comes first in the struct, so sorted members are in order.
    member = F.struct("pos", *[c for c in further if c != "pos"])
    rows = nodes.select(*keys, block, member.alias("member"))
    rows = rows.groupBy(*keys, "block").agg(F.array_sort(F.collect_list("member")).alias("members"))
    needed = F.lit(0)
    for level in range(LEVELS):
        needed = F.when(F.col("n") > FAN_OUT**level, F.lit(level + 1)).otherwise(needed)
    rows = rows.join(sizes, keys).withColumn("n_levels", needed)
    rows = rows.withColumn("level0", F.array_join(F.transform("members", lambda m: m["digest"]), ""))
    top = F.col("level0")
    for level in range(LEVELS):
        up = F.when(F.col("n_levels") > level, _parents(F.col(f"level{level}")))
        rows = rows.withColumn(f"level{level + 1}", up)
        top = F.coalesce(F.col(f"level{level + 1}"), top)
    return stored(rows.withColumn("top", top))


def rounds(nodes: DataFrame, keys: list[str]) -> list[DataFrame]:
    """Blocks of all rounds, from the leaves up; in the last one each tree is one block."""
    out = []
    while True:
        blocks = blocks_of(nodes, keys)
        out.append(blocks)
        most = blocks.agg(F.max("block").alias("last")).first()["last"]
        if not most:
            return out
        nodes = blocks.select(*keys, F.col("block").alias("pos"), F.col("top").alias("digest"))


def _run(level: int, first: Column) -> Column:
    """The run of a block's level in which the node above place ``first`` stands."""
    run = F.floor(first / FAN_OUT ** (level + 1)).cast("int")
    return F.substr(F.col(f"level{level}"), run * (FAN_OUT * WIDTH) + 1, F.lit(FAN_OUT * WIDTH))


def _siblings(place: Column) -> Column:
    """What stands left and right of a block's node in its runs, level by level."""
    segments = []
    for level in range(LEVELS):
        at = (F.floor(place / FAN_OUT**level) % FAN_OUT).cast("int")
        text = F.col("runs")[f"run{level}"]
        left, right = F.substr(text, F.lit(1), at * WIDTH), F.substr(text, (at + 1) * WIDTH + 1)
        segment = F.struct(left.alias("left"), right.alias("right"))
        segments.append(F.when(F.col("n_levels") > level, segment))
    return F.filter(F.array(*segments), lambda s: s.isNotNull())


def paths(blocks: DataFrame, keys: list[str], above: DataFrame) -> DataFrame:
    """Members of the blocks with ``path``: the siblings on the way up, ``above`` of the block's top last.

    Runs are cut out of the long strings once for all their members.
    """
    carried = [c for c in above.columns if c not in (*keys, "block", "path")]
    firsts = F.sequence(F.lit(0), F.size("members") - 1, F.lit(FAN_OUT))
    runs = F.transform(
        firsts,
        lambda first: F.struct(
            F.slice("members", first + 1, FAN_OUT).alias("members"),
            *[_run(level, first).alias(f"run{level}") for level in range(LEVELS)],
        ),
    )
    rows = blocks.join(above, [*keys, "block"]).select(
        *keys, *carried, "n_levels", F.col("path").alias("upper"), F.explode(runs).alias("runs")
    )
    rows = rows.select("*", F.explode("runs.members").alias("member"))
    path = F.concat(_siblings(F.col("member.pos") % BLOCK), F.col("upper"))
    return rows.select(*keys, *carried, "member.*", path.alias("path"))


def all_paths(tree: list[DataFrame], keys: list[str], above: DataFrame) -> DataFrame:
    """The leaves of a tree with their paths; ``above`` has ``(keys, path, ...)``, a row per tree."""
    above = above.withColumn("block", F.lit(0).cast("bigint"))
    for blocks in reversed(tree[1:]):
        carried = [c for c in above.columns if c not in (*keys, "block", "path")]
        found = paths(blocks, keys, above)
        above = found.select(*keys, *carried, F.col("pos").alias("block"), "path")
    return paths(tree[0], keys, above)


def fold(node: Column, path: Column) -> Column:
    """The root that a leaf and its siblings come to."""
    return F.aggregate(path, node, lambda x, s: digest(F.concat(s["left"], x, s["right"])))


def manifest(
    docs: DataFrame, changed: Column | None = None, tampered: Column | None = None,
    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    group: str = "lang", doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``(doc_id, group, leaf, subroot, root, path, proof_sha256, folded_root, verified)``, a row per row.

    A leaf is the SHA-256 (hex) of ``fields`` one after the other (``encoded``).  ``path`` has the
    siblings from leaf to root as ``(left, right)``.  ``folded_root`` is computed from the path and
    the leaf, where ``changed`` holds the leaf with ``tampered`` in place of the text.

    Rows with a NULL group are a group, the first one; groups are ordered by their bytes.  NULL ids
    come first, equal ids are ordered by their leaves, and rows that repeat all fields are leaves of
    their own.  A NULL condition changes nothing.  An empty table gives an empty result; columns
    that are not among the fields are not looked at.
    """
    plain = leaf([F.col(c) for c in fields])
    other = plain
    if changed is not None:
        altered = leaf([tampered if c == text else F.col(c) for c in fields])
        other = F.when(changed, altered).otherwise(plain)
    rows = docs.select(
        F.col(group).isNotNull().alias("named"),
        F.coalesce(F.col(group), F.lit("")).alias("key"),
        F.col(doc_id).alias("id"),
        plain.alias("digest"),
        other.alias("given"),
    )
    keys = ["named", "key"]
    tree = rounds(placed(rows, keys, ["id", "digest"]), keys)
    groups = tree[-1].select(F.lit(0).alias("forest"), *keys, F.col("top").alias("digest"))
    forest = rounds(placed(groups, ["forest"], keys), ["forest"])
    # One row.
    top = forest[-1].select("forest", F.col("top").alias("root"))
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    subroots = all_paths(forest, ["forest"], top.withColumn("path", nothing))
    above = subroots.select(*keys, F.col("digest").alias("subroot"), "root", "path")
    leaves = all_paths(tree, keys, above)
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    return leaves.select(
        F.col("id").alias("doc_id"),
        F.when(F.col("named"), F.col("key")).alias("group"),
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        "path",
        digest(siblings).alias("proof_sha256"),
        fold(F.col("given"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
