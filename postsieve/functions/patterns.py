"""Patterns and literals the text-block rules are defined by (Java regex dialect).

``rlike`` searches anywhere, so patterns that apply to the start or the whole of
a line carry ``\\A`` / ``\\z``.  ``SPACE`` is spelled out because the engines
disagree on what ``\\s`` covers outside ASCII; ``(?iu)`` is case-insensitive
matching over Unicode.
"""

# ---------------------------------------------------------------------------
# These must stay as they are for results to be right.
# ---------------------------------------------------------------------------
SPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"

ROW_ELEMENT = rf"\A{SPACE}*<row"
#: Where files with elements over several lines are cut, what follows it in a row, and a row's
#: attributes up to its end.  Loops are possessive: values may be long.
ROW_MARK = "<row"
ROW_REST = r"\A(?=[\s/>])\s*+[^<\s]"
ROW_ATTRIBUTES = r"""\A((?:[^"'<>/]++|"[^"]*+"|'[^']*+')*+)/?>"""
ANY_REST = r"(?s:.*+)\z"
LINE_BREAK = r"[\r\n]?\n"

INDENTED_LINE = r"\A(?: {4}|[ ]*\t)"
INLINE_CODE_LINE = rf"(?iu)\A{SPACE}*`([^`]+)`{SPACE}*(?:<br{SPACE}*/?{SPACE}*>)?\z"
WHITESPACE_LINE = rf"\A{SPACE}+\z"
LANGUAGE_LINE = rf"(?iu)\A<!--{SPACE}+language:[^>]+>\z"
DIVIDER_LINE = rf"\A<[!?]--{SPACE}+-->{SPACE}*\z"

SNIPPET_BEGIN = rf"(?iu)<!--{SPACE}+begin{SPACE}+snippet[^>]+>"
SNIPPET_END = rf"(?iu)<!--{SPACE}+end{SPACE}+snippet{SPACE}+-->"
CODE_TAG_BEGIN = rf"(?iu)(?:\A{SPACE}*<pre[^>]*>|<pre[^>]*>{SPACE}*<code>|<code>)"
CODE_TAG_END = rf"(?iu)(?:</code>|</code>{SPACE}*</pre>|</pre>{SPACE}*\z)"
SCRIPT_TAG_BEGIN = rf"(?iu)\A({SPACE}*)<script[^>]+>"
SCRIPT_TAG_END = rf"(?iu)\A</script>{SPACE}*\z"
FENCE_BEGIN = rf"\A{SPACE}*```"
FENCE_MARK = "```"

ASCII_LETTER_OR_DIGIT = "[a-zA-Z0-9]"

BODY_EVENT_TYPES = (2, 5, 8)  # initial body, edited body, rolled-back body
OUTSIDE_SLUG = "[^-a-z0-9]+"
# ---------------------------------------------------------------------------

#: Whatever the line rules look for starts with a blank, ``<`` or a backtick, so
#: a look at the first character spares ordinary prose all other patterns.
SPECIAL_FIRST_CHARACTER = rf"[{SPACE[1:-1]}<`]"
NON_SPACE = rf"[^{SPACE[1:-1]}]"


def at_start(pattern: str) -> str:
    """The same pattern, only accepted at the start of the line."""
    flags = "(?iu)" if pattern.startswith("(?iu)") else ""
    return rf"{flags}\A(?:{pattern.removeprefix(flags)})"
