"""Block level of the text-block rules: prose and code blocks of Markdown texts.

A text is exploded into lines, and what a sequential reader would keep in
variables is recovered by window functions over the lines of one text: each open
flag and the block state is *the last value somebody set*.  All windows share one
partitioning and order, so a text is shuffled at most once (not at all when it
is already partitioned by its keys) and sorted once.

No line is filtered out, so every text keeps at least one row to the end and one
without any block comes out with an empty list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postsieve.functions.columns import as_list, has_letter_or_digit, has_text, in_order
from postsieve.operators.lines import line_flags, split_lines, strip_markers

CODE, TEXT = "code", "text"
YES, NO, GONE = bytearray(b"1"), bytearray(b"0"), bytearray(b"2")


def _set_so_far(col: Column, frame) -> Column:
    return F.last(col, ignorenulls=True).over(frame)


def _frames(keys: Sequence[str]):
    lines = Window.partitionBy(*as_list(keys)).orderBy("pos")
    up_to_here = lines.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = lines.rowsBetween(Window.unboundedPreceding, -1)
    return up_to_here, before


def _closing_fences(marked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``fence_open`` where a fence on a line of its own closes what is open.

    Other fences set the state; since the last of them, the number of lone ones tells it.
    """
    up_to_here, _ = _frames(keys)
    lone = F.col("set_fence") & F.col("line").isNull()
    counted = marked.withColumn("n_lone", F.sum(F.coalesce(lone, F.lit(False)).cast("int")).over(up_to_here))
    setting = F.when(
        F.col("set_fence").isNotNull() & ~lone,
        F.struct(F.col("set_fence").cast("int").alias("state"), "n_lone"),
    )
    last = _set_so_far(setting, up_to_here)
    turned = F.col("n_lone") - F.coalesce(last["n_lone"], F.lit(0)) + F.coalesce(last["state"], F.lit(0))
    return counted.select(*marked.columns, (turned % 2 == 1).alias("fence_open"))


def code_flags(marked: DataFrame, keys: Sequence[str], close_fences: bool = False) -> DataFrame:
    """Add ``is_kept``, ``in_code`` and ``after_symbols`` to marked lines.

    ``is_kept``: the line takes part in a block.  ``in_code``: it is code for a
    reason other than indentation.  ``after_symbols``: the line before it has no
    ASCII letter or digit; empty lines count as such a line, used-up ones do not.
    """
    up_to_here, before = _frames(keys)
    code_left_open = F.when(F.col("close_code_after"), F.lit(False)).otherwise(F.col("set_code"))
    if close_fences:
        fences = _closing_fences(marked, keys)
    else:
        fences = marked.withColumn("fence_open", _set_so_far(F.col("set_fence"), up_to_here))
    flags = fences.select(
        "*",
        _set_so_far(F.col("set_snippet"), up_to_here).alias("snippet_open"),
        _set_so_far(F.col("set_script"), up_to_here).alias("script_open"),
        F.coalesce("set_code", _set_so_far(code_left_open, before)).alias("code_open"),
        _set_so_far(has_letter_or_digit(F.col("line")), before).alias("alnum_before"),
    )
    in_code = F.col("is_language") | F.col("is_inline")
    for name in ("snippet_open", "script_open", "fence_open", "code_open"):
        in_code = in_code | F.coalesce(name, F.lit(False))
    return flags.select(
        *marked.columns,
        ((F.col("raw") != "") & F.col("line").isNotNull()).alias("is_kept"),
        in_code.alias("in_code"),
        (~F.coalesce("alnum_before", F.lit(False))).alias("after_symbols"),
    )


def block_states(flagged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``state`` ("text", "code", NULL before any block) and ``block_no``.

    Some lines fix the state whatever it was; the others keep it.  A block ends
    where the state changes; language and divider lines also split code.
    """
    up_to_here, before = _frames(keys)
    visible = F.col("is_kept") & ~F.col("is_space")
    fixes = F.when(
        visible,
        F.when(F.col("in_code") | (F.col("is_indented") & F.col("after_symbols")), CODE).when(
            ~F.col("is_indented") & ~F.col("is_divider"), TEXT
        ),
    )
    # A divider keeps the state, but as the very first line it starts a text.
    starts_text = F.when(visible & F.col("is_divider"), TEXT)

    def state(frame) -> Column:
        return F.coalesce(_set_so_far(fixes, frame), _set_so_far(starts_text, frame))

    states = flagged.select(
        "*", state(up_to_here).alias("state"), state(before).alias("state_before")
    )
    splits_code = (
        F.col("is_kept")
        & (F.col("is_language") | F.col("is_divider"))
        & (F.col("state_before") == CODE)
    )
    begins = ~F.col("state").eqNullSafe(F.col("state_before")) | F.coalesce(
        splits_code, F.lit(False)
    )
    return states.select(
        *flagged.columns, "state", F.sum(begins.cast("int")).over(up_to_here).alias("block_no")
    )


def traced_lines(
    df: DataFrame,
    keys: Sequence[str],
    text_col: str = "text",
    carry: Sequence[str] = (),
    close_fences: bool = False,
) -> DataFrame:
    """Lines of every text with all line columns, ``state`` and ``block_no``.

    Texts are placed by key before they are exploded: moving a text is cheaper
    than moving its lines, and Spark drops the move where the input is already
    partitioned that way.
    """
    placed = df.repartition(*as_list(keys))
    lines = split_lines(placed, [*as_list(keys), *carry], text_col)
    marked = strip_markers(line_flags(lines))
    return block_states(code_flags(marked, keys, close_fences), keys)


def block_contents(
    traced: DataFrame, keys: Sequence[str], carry: Sequence[str] = ()
) -> DataFrame:
    """``(*keys, *carry, block_no, block_type, content)``: lines joined block by block.

    Language lines belong to a block but leave no line in it, and empty lines do
    not start one.  A group is part of one text, so it is never larger than that.
    """
    written = F.col("is_kept") & ~F.col("is_language") & F.col("state").isNotNull()
    pieces = F.collect_list(F.when(written, F.struct("pos", "line")))
    joined = F.array_join(in_order(F.col("pieces"), "line"), "\n")
    content = F.ltrim(joined, F.lit("\n")).alias("content")
    text_columns = [*as_list(keys), *carry]
    return (
        traced.groupBy(*text_columns, "block_no")
        .agg(F.max("state").alias("block_type"), pieces.alias("pieces"))
        .select(*text_columns, "block_no", "block_type", content)
    )


def nonblank_blocks(blocks: DataFrame) -> DataFrame:
    """Drop blocks of nothing but whitespace."""
    return blocks.where(has_text(F.col("content")))


def blocks_per_text(
    blocks: DataFrame, keys: Sequence[str], carry: Sequence[str] = ()
) -> DataFrame:
    """``(*keys, *carry, blocks)``: the non-blank blocks of each text, in order."""
    block = F.when(
        has_text(F.col("content")), F.struct("block_no", "block_type", "content")
    )
    text_columns = [*as_list(keys), *carry]
    return (
        blocks.groupBy(*text_columns)
        .agg(F.collect_list(block).alias("blocks"))
        .select(
            *text_columns,
            F.transform(
                F.array_sort("blocks"),
                lambda b: F.struct(b["block_type"].alias("block_type"), b["content"].alias("content")),
            ).alias("blocks"),
        )
    )


def _absorbed_flags(blocks: Column) -> Column:
    """Which symbol-only blocks are absorbed by the block before (1): a byte for each.

    Left to right: a symbol-only block is absorbed unless it, or the block before
    it, is already gone.  If the blocks on both of its sides are of one type, the
    one behind it goes too.  A symbol-only first block goes into the second.  Both are
    marked as gone (2).
    """
    flagged = F.transform(
        blocks,
        lambda b, i: F.struct(
            (~has_letter_or_digit(b["content"])).alias("symbols"),
            F.coalesce(
                F.get(blocks, i - 1)["block_type"] == F.get(blocks, i + 1)["block_type"],
                F.lit(False),
            ).alias("alike_around"),
            i.alias("i"),
        ),
    )
    start = F.struct(
        F.lit(False).alias("gone_before"),
        F.lit(False).alias("taken"),
        F.lit(bytearray()).alias("flags"),
    )

    def step(acc: Column, block: Column) -> Column:
        leads = block["symbols"] & (block["i"] == 0)
        absorbed = block["symbols"] & (block["i"] > 0) & ~acc["taken"] & ~acc["gone_before"]
        gone = acc["taken"] | (leads & (F.size(blocks) > 1))
        flag = F.when(absorbed, F.lit(YES)).when(gone, F.lit(GONE)).otherwise(F.lit(NO))
        return F.struct(
            (acc["taken"] | absorbed | leads).alias("gone_before"),
            (absorbed & block["alike_around"]).alias("taken"),
            F.concat(acc["flags"], flag).alias("flags"),
        )

    return F.aggregate(flagged, start, step, lambda acc: acc["flags"])


def absorb_symbol_blocks(texts: DataFrame, drop_merged: bool = False) -> DataFrame:
    """Add blocks without letters or digits to their neighbours' contents.

    Absorbed blocks also stay in the list: only contents change, never the
    number of blocks, unless ``drop_merged`` takes out what went into another block.
    ``blocks`` is the array of one text; most have no such block and pass unchanged.
    """
    blocks, absorbed = F.col("blocks"), F.col("absorbed")

    def merged(b: Column, i: Column) -> Column:
        after, after_next = F.get(blocks, i + 1), F.get(blocks, i + 2)
        first = F.get(blocks, F.lit(0))["content"]
        takes = F.substring(absorbed, i + 2, F.lit(1)) == F.lit(YES)
        content = F.concat_ws(
            "\n",
            F.when((i == 1) & ~has_letter_or_digit(first), first),
            b["content"],
            F.when(takes, after["content"]),
            F.when(takes & (b["block_type"] == after_next["block_type"]), after_next["content"]),
        )
        return F.struct(b["block_type"].alias("block_type"), content.alias("content"))

    changed = F.transform(blocks, merged)
    if drop_merged:
        # Cut apart by the flags, which are about the blocks' places in the whole list.
        stays = F.transform(changed, lambda b, i: F.when(F.substring(absorbed, i + 1, F.lit(1)) == F.lit(NO), b))
        changed = F.filter(stays, lambda b: b.isNotNull())
    any_symbols = F.exists(blocks, lambda b: ~has_letter_or_digit(b["content"]))
    # The flags are a column of their own, found once and not for each block.
    return (
        texts.withColumn("absorbed", F.when(any_symbols, _absorbed_flags(blocks)))
        .withColumn(
            "blocks",
            F.when(absorbed.isNull(), blocks).otherwise(changed),
        )
        .drop("absorbed")
    )


def markdown_blocks(
    df: DataFrame,
    keys: Sequence[str],
    text_col: str = "text",
    carry: Sequence[str] = (),
    close_fences: bool = False,
    drop_merged: bool = False,
) -> DataFrame:
    """``(*keys, *carry, blocks)``: all blocks of each text, neighbours merged.

    ``keys`` identify a row of ``df``; ``carry`` are further columns to keep.  The options
    depart from the fixed rules: with ``close_fences`` a fence on a line of its own closes an
    open one, with ``drop_merged`` blocks that went into a neighbour leave the list.
    """
    traced = traced_lines(df, keys, text_col, carry, close_fences)
    contents = block_contents(traced, keys, carry)
    return absorb_symbol_blocks(blocks_per_text(contents, keys, carry), drop_merged)


def prose_contents(blocks: Column) -> Column:
    """Contents of the text blocks in an array of blocks, in order."""
    prose = F.filter(blocks, lambda b: b["block_type"] == TEXT)
    return F.transform(prose, lambda b: b["content"])


def text_blocks(
    df: DataFrame,
    keys: Sequence[str],
    text_col: str = "text",
    carry: Sequence[str] = (),
    close_fences: bool = False,
    drop_merged: bool = False,
) -> DataFrame:
    """``(*keys, *carry, text_blocks)``: the prose of each text, block by block.

    Options as in ``markdown_blocks``.
    """
    blocks = markdown_blocks(df, keys, text_col, carry, close_fences, drop_merged)
    return blocks.select(
        *as_list(keys), *carry, prose_contents(F.col("blocks")).alias("text_blocks")
    )
