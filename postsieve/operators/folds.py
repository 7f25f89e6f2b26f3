"""Text blocks as a fold over the lines of one row: no explode, no window, no shuffle.

The same rules as in ``blocks.py``, by a reader with variables: an ``aggregate`` walks over the array
of a text's lines and notes a character for each.  What an ``aggregate`` gathers is copied at every
step, so lines are taken in pieces, and only a piece's notes grow line by line.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.functions import patterns as p
from postsieve.functions.columns import as_list, has_text
from postsieve.operators.blocks import CODE, TEXT, absorb_symbol_blocks, prose_contents
from postsieve.operators.lines import flag_steps, marker_steps, text_lines

#: Lines of a piece.
PIECE = 256

# What the reader remembers: open kinds of code, whether a code tag closes after this line, whether
# the line before has a letter or digit, the state (0 none, 1 text, 2 code), and a note for each line:
# "-" if it is in no block, else the state, or the state and 3 where a block begins.
_START = (
    "named_struct('snippet', false, 'code', false, 'script', false, 'fence', false, 'pending', false, "
    "'alnum', false, 'state', 0, 'notes', '')"
)


def _line_structs() -> str:
    """SQL for the array ``raws`` as structs of what the rules say about each line."""
    sql, known = "transform(raws, r -> named_struct('raw', r))", ["raw"]
    *steps, last = [*flag_steps("x."), *marker_steps("x.")]
    for step in steps:
        kept = ", ".join(f"'{name}', x.{name}" for name in known)
        new = ", ".join(f"'{name}', {expression}" for name, expression in step.items())
        sql, known = f"transform({sql}, x -> named_struct({kept}, {new}))", [*known, *step]
    flags = ("raw", "is_space", "is_indented", "is_language", "is_divider", "is_inline")
    kept = ", ".join(f"'{name}', x.{name}" for name in flags)
    new = ", ".join(f"'{name}', {expression}" for name, expression in last.items())
    return f"transform({sql}, x -> named_struct({kept}, {new}))"


def _reader(close_fences: bool) -> str:
    """SQL of one step: the reader ``a`` after the line ``x``."""
    fence = "coalesce(x.set_fence, a.fence)"
    if close_fences:
        fence = f"IF(x.set_fence AND x.line IS NULL, NOT a.fence, {fence})"
    opened = (
        "named_struct('snippet', coalesce(x.set_snippet, a.snippet), "
        "'code', coalesce(x.set_code, a.code AND NOT (a.pending AND x.raw <> '')), "
        f"'script', coalesce(x.set_script, a.script), 'fence', {fence}, "
        "'kept', x.raw <> '' AND x.line IS NOT NULL)"
    )
    in_code = "(x.is_language OR x.is_inline OR o.snippet OR o.code OR o.script OR o.fence)"
    state = f"""CASE WHEN NOT o.kept OR x.is_space THEN a.state
        WHEN a.state = 0 THEN IF(x.is_indented OR {in_code}, 2, 1)
        WHEN a.state = 1 THEN IF({in_code} OR (x.is_indented AND NOT a.alnum), 2, 1)
        ELSE IF(x.is_language OR x.is_divider OR x.is_indented OR {in_code}, 2, 1) END"""
    begins = "s <> a.state OR (a.state = 2 AND (x.is_language OR x.is_divider))"
    note = f"IF(o.kept, CAST(IF({begins}, s + 3, s) AS STRING), '-')"
    after = f"""named_struct('snippet', o.snippet, 'code', o.code, 'script', o.script, 'fence', o.fence,
        'pending', IF(x.raw = '', a.pending, x.close_code_after),
        'alnum', CASE WHEN o.kept THEN x.line RLIKE '{p.ASCII_LETTER_OR_DIGIT}' WHEN x.raw = '' THEN false ELSE a.alnum END,
        'state', s, 'notes', concat(a.notes, {note}))"""
    # Names for values that are used more than once.
    return f"element_at(transform(array({opened}), o -> element_at(transform(array({state}), s -> {after}), 1)), 1)"


def _blocks(close_fences: bool) -> str:
    """SQL for the blocks of the array ``raws``, contents not yet absorbed."""
    pieces = f"transform(sequence(0, size(ls) - 1, {PIECE}), i -> slice(ls, i + 1, {PIECE}))"
    inner = f"aggregate(piece, named_struct({{}}), (a, x) -> {_reader(close_fences)})"
    fields = ("snippet", "code", "script", "fence", "pending", "alnum", "state")
    carried = ", ".join(f"'{f}', acc.reader.{f}" for f in fields) + ", 'notes', ''"
    step = (
        f"element_at(transform(array({inner.format(carried)}), done -> "
        "named_struct('reader', done, 'notes', concat(acc.notes, array(done.notes)))), 1)"
    )
    start = f"named_struct('reader', {_START}, 'notes', CAST(array() AS ARRAY<STRING>))"
    notes = f"aggregate({pieces}, {start}, (acc, piece) -> {step}, acc -> split(array_join(acc.notes, ''), ''))"
    noted = f"transform(arrays_zip(ls, {notes}), (z, i) -> named_struct('i', i, 'x', z.ls, 'note', z['1']))"
    content = (
        "ltrim('\\n', array_join(transform(filter(slice(ns, b.i + 1, coalesce(get(bs, k + 1).i, size(ns)) - b.i), "
        "n -> n.note <> '-' AND NOT n.x.is_language), n -> n.x.line), '\\n'))"
    )
    kind = f"IF(b.note = '4', '{TEXT}', '{CODE}')"
    blocks = f"transform(bs, (b, k) -> named_struct('block_type', {kind}, 'content', {content}))"
    begun = "filter(ns, n -> n.note IN ('4', '5'))"
    # ls: the lines; ns: with their notes; bs: those that begin a block.
    return (
        f"element_at(transform(array({_line_structs()}), ls -> element_at(transform(array({noted}), ns -> "
        f"element_at(transform(array({begun}), bs -> {blocks}), 1)), 1)), 1)"
    )


def markdown_blocks_by_fold(
    df: DataFrame,
    keys: Sequence[str],
    text_col: str = "text",
    carry: Sequence[str] = (),
    close_fences: bool = False,
    drop_merged: bool = False,
) -> DataFrame:
    """As ``blocks.markdown_blocks``; ``keys`` need not be unique."""
    columns = [*as_list(keys), *carry]
    raws = df.select(*columns, text_lines(F.col(text_col)).alias("raws"))
    found = raws.select(*columns, F.expr(_blocks(close_fences)).alias("blocks"))
    filled = found.withColumn("blocks", F.filter("blocks", lambda b: has_text(b["content"])))
    return absorb_symbol_blocks(filled, drop_merged)


def text_blocks_by_fold(
    df: DataFrame,
    keys: Sequence[str],
    text_col: str = "text",
    carry: Sequence[str] = (),
    close_fences: bool = False,
    drop_merged: bool = False,
) -> DataFrame:
    """As ``blocks.text_blocks``; ``keys`` need not be unique."""
    blocks = markdown_blocks_by_fold(df, keys, text_col, carry, close_fences, drop_merged)
    return blocks.select(*as_list(keys), *carry, prose_contents(F.col("blocks")).alias("text_blocks"))
