"""Line level of the text-block rules: split, classify, strip markers.

Everything here looks at one line only, so it is a chain of plain columns and
needs no shuffle.  Columns added to ``(*keys, pos, raw)``:

``is_space, is_indented, is_language, is_divider, is_inline``
    what the raw line looks like (``line_flags``)
``line``
    the line without its markers; NULL where the marker was all there was
``set_snippet, set_code, set_script, set_fence``
    True / False where the line opens / closes a kind of code block, else NULL
``close_code_after``
    the line closes a code tag, but only once it is over
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsieve.functions import patterns as p
from postsieve.functions.columns import as_list


def text_lines(text: Column) -> Column:
    """The lines of a text as an array; a NULL text counts as empty.

    The separator takes two line feeds in a row for one.  Texts without such a
    pair, as all with CRLF line ends are, split at a plain character instead,
    which Spark does without the regular expression engine.
    """
    text = F.coalesce(text, F.lit(""))
    by_character = F.split(F.replace(text, F.lit("\r\n"), F.lit("\n")), "\n")
    return F.when(F.contains(text, F.lit("\n\n")), F.split(text, p.LINE_BREAK)).otherwise(by_character)


def split_lines(df: DataFrame, keys: Sequence[str], text_col: str = "text") -> DataFrame:
    """``(*keys, pos, raw)``: one row per line."""
    return df.select(*as_list(keys), F.posexplode(text_lines(F.col(text_col))).alias("pos", "raw"))


def _like(column: str, pattern: str) -> str:
    """SQL for a pattern match; the pattern is a raw literal."""
    return f"{column} RLIKE r'{pattern}'"


#: SQL by the name of the column it gives, each step using those before it.
Steps = list[dict[str, str]]


def flag_steps(of: str = "") -> Steps:
    """Classification of raw lines, each by one anchored pattern.

    ``of`` stands before the names of columns: the line's own name and a dot, where it is a struct.
    """
    kinds = {
        "is_space": p.WHITESPACE_LINE,
        "is_indented": p.INDENTED_LINE,
        "is_language": p.LANGUAGE_LINE,
        "is_divider": p.DIVIDER_LINE,
        "is_inline": p.INLINE_CODE_LINE,
    }
    special = _like(f"left({of}raw, 1)", p.SPECIAL_FIRST_CHARACTER)
    return [
        {"may_be_special": special},
        {name: f"{of}may_be_special AND {_like(f'{of}raw', pattern)}" for name, pattern in kinds.items()},
    ]


def line_flags(lines: DataFrame) -> DataFrame:
    """Classify raw lines."""
    for step in flag_steps():
        lines = lines.selectExpr("*", *(f"{sql} AS {name}" for name, sql in step.items()))
    return lines


# Name of the line after each step, the marker that must open the line before it,
# and what replaces the marker wherever it is found.
_STEPS = (
    ("sans_snippet_begin", p.SNIPPET_BEGIN, ""),
    ("sans_snippet_end", p.SNIPPET_END, ""),
    ("sans_code_begin", p.CODE_TAG_BEGIN, ""),
    ("sans_code_end", p.CODE_TAG_END, ""),
    ("sans_script_begin", p.SCRIPT_TAG_BEGIN, "$1"),
    ("sans_script_end", p.SCRIPT_TAG_END, ""),
    ("sans_fence", p.FENCE_BEGIN, ""),
)


def marker_steps(of: str = "") -> Steps:
    """The marker chain over classified lines (see the module notes); the last step is the result.

    Each step sees what the step before has left and always shortens the line it
    applies to, so comparing neighbouring steps tells which markers were there.
    Within a line the last marker of a kind counts.  Indented, blank and language
    lines carry no markers.
    """
    steps: Steps = [
        {"may_be_marked": f"{of}may_be_special AND NOT ({of}is_indented OR {of}is_space OR {of}is_language)"}
    ]
    before = {}
    line = "raw"
    for name, marker, replacement in _STEPS:
        opens = f"{of}may_be_marked AND {_like(of + line, p.at_start(marker))}"
        removed = f"regexp_replace({of}{line}, r'{marker}', '{replacement}')"
        steps.append({name: f"IF({opens}, {removed}, {of}{line})"})
        before[name] = line
        line = name

    def removed_by(step: str) -> str:
        return f"({of}may_be_marked AND {of}{before[step]} != {of}{step})"

    def toggle(opens: str, closes: str) -> str:
        return f"CASE WHEN {closes} THEN false WHEN {opens} THEN true END"

    # A closing code tag with content behind it still covers that content.
    code_goes_on = f"({removed_by('sans_code_end')} AND {_like(of + 'sans_code_end', p.NON_SPACE)})"
    code_ends = f"({removed_by('sans_code_end')} AND NOT {_like(of + 'sans_code_end', p.NON_SPACE)})"
    # A fence opens even where it was meant to close, except when a second one
    # follows at once: then it closes and all fences of the line are dropped.
    double_fence = f"({removed_by('sans_fence')} AND startswith({of}sans_fence, '{p.FENCE_MARK}'))"
    steps.append(
        {
            "line": f"""CASE WHEN {of}is_language THEN ''
                 WHEN {of}is_inline THEN regexp_extract({of}raw, r'{p.INLINE_CODE_LINE}', 1)
                 WHEN {double_fence} THEN replace({of}sans_fence, '{p.FENCE_MARK}', '')
                 WHEN NOT {of}may_be_marked OR {_like(of + "sans_fence", p.NON_SPACE)} THEN {of}sans_fence
            END""",
            "set_snippet": toggle(removed_by("sans_snippet_begin"), removed_by("sans_snippet_end")),
            "set_code": toggle(removed_by("sans_code_begin"), code_ends),
            "set_script": toggle(removed_by("sans_script_begin"), removed_by("sans_script_end")),
            "set_fence": toggle(removed_by("sans_fence"), double_fence),
            "close_code_after": code_goes_on,
        }
    )
    return steps


def strip_markers(lines: DataFrame) -> DataFrame:
    """Run the marker chain over classified lines."""
    *steps, last = marker_steps()
    marked = lines
    for step in steps:
        marked = marked.selectExpr("*", *(f"{sql} AS {name}" for name, sql in step.items()))
    return marked.selectExpr(
        *(name for name in lines.columns if name != "may_be_special"),
        *(f"{sql} AS {name}" for name, sql in last.items()),
    )
