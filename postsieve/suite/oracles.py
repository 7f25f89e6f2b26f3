"""The queries in SQL (DuckDB dialect) over the same parquet tables.

Text blocks are computed here by stepping through the lines of a text one by one
in a recursive query, which shares nothing with the window functions under test.
"""

from __future__ import annotations

DATASET = "['a.example.com', 'b.example.com', 'c.example.com'][CAST({0} % 3 AS INT) + 1]"
MARK = "chr(10) || '~' || chr(10)"


def _site(post_id: str) -> str:
    return DATASET.format(post_id)


VIEWS = {
    "posts": f"""
        SELECT {_site("doc_id")} AS dataset, doc_id AS post_id,
               CAST(n_chars % 7 - 2 AS BIGINT) AS score
        FROM documents""",
    "posts_with_repeats": f"""
        SELECT dataset, post_id, score FROM posts
        UNION ALL
        SELECT {_site("conv_id")}, conv_id, turn FROM conversations""",
    "raw_comments": f"""
        SELECT {_site("conv_id")} AS dataset, conv_id * 100 + turn AS comment_id,
               CASE WHEN conv_id % 50 = 7 THEN conv_id + 100000000 ELSE conv_id END AS post_id,
               CAST(length(text) % 5 - 1 AS BIGINT) AS score, text
        FROM conversations""",
    "comments": "SELECT * FROM raw_comments WHERE score > 0",
    "md": """
        SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda l, i:
            CASE (doc_id * 7 + (i - 1) * 11) % 29
                WHEN 0 THEN '' WHEN 1 THEN '    ' || l WHEN 2 THEN '' WHEN 3 THEN '    }'
                WHEN 4 THEN '`x' || CAST(i - 1 AS VARCHAR) || '`'
                WHEN 5 THEN '<pre><code>' WHEN 6 THEN '</code></pre>'
                WHEN 7 THEN '<!-- language: lang-js -->'
                WHEN 8 THEN '<!-- begin snippet: js hide: false -->'
                WHEN 9 THEN '<!-- end snippet -->' WHEN 10 THEN '<!-- -->' WHEN 11 THEN '   '
                WHEN 12 THEN '---' WHEN 13 THEN '<script type="a">' WHEN 14 THEN '</script>'
                WHEN 15 THEN '```' WHEN 16 THEN '``````' WHEN 17 THEN chr(9) || l
                ELSE l END), chr(13) || chr(10)) AS text
        FROM documents""",
    "history": f"""
        SELECT {_site("e.user_id")} AS dataset, e.event_id,
               CASE WHEN e.user_id % 50 = 3 THEN e.user_id + 100000000 ELSE e.user_id END AS post_id,
               CAST(CASE event_type WHEN 'signup' THEN 2 WHEN 'view' THEN 4 WHEN 'purchase' THEN 5
                    WHEN 'click' THEN 6 ELSE 8 END AS BIGINT) AS type_id,
               strftime(e.ts, '%Y-%m-%dT%H:%M:%S.%g') AS creation_date, m.text
        FROM events e JOIN md m ON m.doc_id = e.event_id % (SELECT count(*) FROM documents)""",
    "edits": "SELECT * FROM history WHERE type_id IN (2, 5, 8)",
    "newest": """
        SELECT dataset, post_id, event_id, creation_date, text
        FROM edits
        QUALIFY row_number() OVER (PARTITION BY dataset, post_id
                                   ORDER BY creation_date DESC, event_id) = 1""",
    "scores": """
        SELECT dataset, post_id, CASE WHEN count(*) = 1 THEN min(score) END AS score
        FROM posts GROUP BY dataset, post_id""",
    "scores_with_repeats": """
        SELECT dataset, post_id, CASE WHEN count(*) = 1 THEN min(score) END AS score
        FROM posts_with_repeats GROUP BY dataset, post_id""",
    "comment_lists": f"""
        SELECT dataset, post_id, count(*) AS n_comments,
               string_agg(text, {MARK} ORDER BY comment_id) AS comments
        FROM comments GROUP BY dataset, post_id""",
}

_NEEDS = {
    "posts_with_repeats": ["posts"],
    "comments": ["raw_comments"],
    "history": ["md"],
    "edits": ["history"],
    "newest": ["edits"],
    "scores": ["posts"],
    "scores_with_repeats": ["posts_with_repeats"],
    "comment_lists": ["comments"],
}


def _views(*names: str) -> str:
    """``name AS (...)`` for the views and, before them, those they need."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    return ",\n".join(f"{name} AS ({VIEWS[name]})" for name in ordered)


# --- text blocks, line after line ------------------------------------------------

# From a view ``texts (k, text)``.
SPLIT = r"""
pieces AS (SELECT k, regexp_split_to_array(coalesce(text, ''), '[\r\n]?\n') AS parts FROM texts),
raw_lines AS (SELECT k, generate_subscripts(parts, 1) - 1 AS pos, unnest(parts) AS raw FROM pieces)"""

# Fixed values here and in MARKERS and READER: the patterns of functions/patterns.py in this
# engine's dialect.
FLAGS = r"""
flagged AS (
    SELECT *,
        regexp_full_match(raw, '\s+') AS is_space,
        regexp_matches(raw, '^( {4}|[ ]*\t)') AS is_indented,
        regexp_full_match(raw, '<!--\s+language:[^>]+>', 'i') AS is_language,
        regexp_full_match(raw, '<[!?]--\s+-->\s*') AS is_divider,
        regexp_full_match(raw, '\s*`([^`]+)`\s*(?:<br\s*/?\s*>)?', 'i') AS is_inline
    FROM raw_lines)"""

# One marker after the other; ``live`` says whether the line is still looked at.
MARKERS = r"""
m0 AS (SELECT *, raw AS line, NOT (is_space OR is_indented OR is_language) AND raw <> '' AS live,
              'keep' AS snippet, 'keep' AS code, 'keep' AS script, 'keep' AS fence,
              false AS later
       FROM flagged),
m1 AS (SELECT * REPLACE (
              CASE WHEN hit THEN rest ELSE line END AS line,
              CASE WHEN hit THEN 'open' ELSE snippet END AS snippet,
              live AND NOT (hit AND trim(rest) = '') AS live)
       FROM (SELECT *, live AND regexp_matches(line, '^<!--\s+begin\s+snippet[^>]+>', 'i') AS hit,
                    regexp_replace(line, '<!--\s+begin\s+snippet[^>]+>', '', 'gi') AS rest FROM m0)),
m2 AS (SELECT * REPLACE (
              CASE WHEN hit2 THEN rest2 ELSE line END AS line,
              CASE WHEN hit2 THEN 'close' ELSE snippet END AS snippet,
              live AND NOT (hit2 AND trim(rest2) = '') AS live)
       FROM (SELECT *, live AND regexp_matches(line, '^<!--\s+end\s+snippet\s+-->', 'i') AS hit2,
                    regexp_replace(line, '<!--\s+end\s+snippet\s+-->', '', 'gi') AS rest2 FROM m1)),
m3 AS (SELECT * REPLACE (
              CASE WHEN hit3 THEN rest3 ELSE line END AS line,
              CASE WHEN hit3 THEN 'open' ELSE code END AS code,
              live AND NOT (hit3 AND trim(rest3) = '') AS live)
       FROM (SELECT *, live AND regexp_matches(line, '^(\s*<pre[^>]*>|<code>)', 'i') AS hit3,
                    regexp_replace(line, '^\s*<pre[^>]*>|<pre[^>]*>\s*<code>|<code>', '', 'gi') AS rest3
             FROM m2)),
m4 AS (SELECT * REPLACE (
              CASE WHEN hit4 THEN rest4 ELSE line END AS line,
              CASE WHEN hit4 AND trim(rest4) = '' THEN 'close' ELSE code END AS code,
              hit4 AND trim(rest4) <> '' AS later,
              live AND NOT (hit4 AND trim(rest4) = '') AS live)
       FROM (SELECT *, live AND regexp_matches(line, '^(</code>|</pre>\s*$)', 'i') AS hit4,
                    regexp_replace(line, '</code>|</pre>\s*$', '', 'gi') AS rest4 FROM m3)),
m5 AS (SELECT * REPLACE (
              CASE WHEN hit5 THEN rest5 ELSE line END AS line,
              CASE WHEN hit5 THEN 'open' ELSE script END AS script,
              live AND NOT (hit5 AND trim(rest5) = '') AS live)
       FROM (SELECT *, live AND regexp_matches(line, '^\s*<script[^>]+>', 'i') AS hit5,
                    regexp_replace(line, '<script[^>]+>', '', 'i') AS rest5 FROM m4)),
m6 AS (SELECT * REPLACE (
              CASE WHEN hit6 THEN 'close' ELSE script END AS script,
              live AND NOT hit6 AS live)
       FROM (SELECT *, live AND regexp_matches(line, '^</script>\s*$', 'i') AS hit6 FROM m5)),
m7 AS (SELECT * REPLACE (
              CASE WHEN hit7 AND starts_with(rest7, '```') THEN replace(rest7, '```', '')
                   WHEN hit7 THEN rest7 ELSE line END AS line,
              CASE WHEN hit7 AND starts_with(rest7, '```') THEN 'close'
                   WHEN hit7 THEN 'open' ELSE fence END AS fence,
              live AND NOT (hit7 AND trim(rest7) = '') AS live)
       FROM (SELECT *, live AND regexp_matches(line, '^\s*```') AS hit7,
                    regexp_replace(line, '^\s*```', '') AS rest7 FROM m6)),
marked AS MATERIALIZED (
    SELECT k, pos, raw, is_space, is_indented, is_language, is_divider, is_inline,
           snippet, code, script, fence, later,
           raw <> '' AND NOT live AND NOT (is_space OR is_indented OR is_language) AS used_up,
           CASE WHEN is_language THEN ''
                WHEN is_inline THEN regexp_extract(raw, '\s*`([^`]+)`', 1)
                ELSE line END AS line
    FROM m7)"""

# A reader that remembers flags, the previous line and the open block.
READER = r"""
reader AS (
    SELECT k, CAST(-1 AS BIGINT) AS pos, false AS snippet, false AS code, false AS script,
           false AS fence, false AS pending, '' AS before, 'none' AS state,
           CAST(0 AS BIGINT) AS block_no, false AS kept, false AS in_code, true AS after_symbols,
           CAST(NULL AS VARCHAR) AS written
    FROM texts
    UNION ALL
    SELECT k, pos, snippet, code, script, fence, pending,
           CASE WHEN raw = '' THEN '' WHEN kept THEN line ELSE before END,
           CASE WHEN kept THEN next_state ELSE state END,
           CASE WHEN kept AND (next_state <> state
                     OR (state = 'code' AND (is_language OR is_divider)))
                THEN block_no + 1 ELSE block_no END,
           kept, in_code, after_symbols,
           CASE WHEN kept AND NOT is_language AND next_state <> 'none' THEN line END
    FROM (
        SELECT *,
               CASE WHEN is_space THEN state
                    WHEN state = 'none' THEN CASE WHEN is_indented OR in_code THEN 'code' ELSE 'text' END
                    WHEN state = 'text' THEN
                        CASE WHEN in_code OR (is_indented AND after_symbols) THEN 'code' ELSE 'text' END
                    WHEN is_language OR is_divider OR is_indented OR in_code THEN 'code'
                    ELSE 'text' END AS next_state
        FROM (
            SELECT *, is_language OR is_inline OR snippet OR code OR script OR fence AS in_code
            FROM (
                SELECT l.k, l.pos, l.raw, l.line, l.is_space, l.is_indented, l.is_language,
                       l.is_divider, l.is_inline, r.before, r.state, r.block_no,
                       CASE l.snippet WHEN 'open' THEN true WHEN 'close' THEN false ELSE r.snippet END AS snippet,
                       CASE l.code WHEN 'open' THEN true WHEN 'close' THEN false
                            ELSE r.code AND NOT (r.pending AND l.raw <> '') END AS code,
                       CASE l.script WHEN 'open' THEN true WHEN 'close' THEN false ELSE r.script END AS script,
                       CASE l.fence WHEN 'open' THEN true WHEN 'close' THEN false ELSE r.fence END AS fence,
                       CASE WHEN l.raw = '' THEN r.pending ELSE l.later END AS pending,
                       l.raw <> '' AND NOT l.used_up AS kept,
                       NOT regexp_matches(r.before, '[a-zA-Z0-9]') AS after_symbols
                FROM reader r JOIN marked l ON l.k = r.k AND l.pos = r.pos + 1))))"""

CONTENTS = r"""
contents AS (
    SELECT k, block_no, max(state) AS block_type,
           regexp_replace(coalesce(string_agg(written, chr(10) ORDER BY pos), ''), '^\n+', '') AS content
    FROM reader WHERE state <> 'none' GROUP BY k, block_no),
nonblank AS (SELECT * FROM contents WHERE trim(content, chr(9) || chr(10) || chr(13) || ' ') <> '')"""

# Walk over the blocks of a text and change its list of contents step by step.
MERGE = r"""
lists AS (
    SELECT k, list(block_type ORDER BY block_no) AS types, list(content ORDER BY block_no) AS texts
    FROM nonblank GROUP BY k),
walk AS (
    SELECT k, types, texts, CAST(0 AS BIGINT) AS i, CAST([] AS BIGINT[]) AS gone FROM lists
    UNION ALL
    SELECT k, types,
           CASE WHEN leads THEN list_transform(texts, lambda c, j:
                    CASE WHEN j = 2 THEN texts[1] || chr(10) || c ELSE c END)
                WHEN absorbed THEN list_transform(texts, lambda c, j:
                    CASE WHEN j = i - 1 THEN c || chr(10) || texts[i]
                              || CASE WHEN takes_next THEN chr(10) || texts[i + 1] ELSE '' END
                         ELSE c END)
                ELSE texts END,
           i,
           CASE WHEN leads THEN list_append(gone, i)
                WHEN takes_next THEN list_append(list_append(gone, i), i + 1)
                WHEN absorbed THEN list_append(gone, i) ELSE gone END
    FROM (
        SELECT *, absorbed AND i < len(types) AND coalesce(types[i - 1] = types[i + 1], false) AS takes_next
        FROM (
            SELECT *, symbols AND i = 1 AND len(types) > 1 AS leads,
                   symbols AND i > 1 AND NOT list_contains(gone, i - 1) AS absorbed
            FROM (SELECT k, types, texts, gone, i + 1 AS i,
                         NOT list_contains(gone, i + 1)
                         AND NOT regexp_matches(texts[i + 1], '[a-zA-Z0-9]') AS symbols
                  FROM walk WHERE i < len(types))))),
merged AS (
    SELECT k, generate_subscripts(texts, 1) - 1 AS ord, unnest(types) AS block_type,
           unnest(texts) AS content
    FROM walk WHERE i = len(types)),
prose AS (
    SELECT t.k, count(m.content) AS n_text_blocks,
           coalesce(string_agg(m.content, chr(10) || '~' || chr(10) ORDER BY m.ord), '') AS text_blocks
    FROM texts t LEFT JOIN merged m ON m.k = t.k AND m.block_type = 'text' GROUP BY t.k)"""

# The same reader, for whom a fence that is all of a line closes an open one.
CLOSING_READER = READER.replace(
    "CASE l.fence WHEN 'open' THEN true WHEN 'close' THEN false ELSE r.fence END AS fence",
    """CASE WHEN l.fence = 'open' THEN NOT (l.used_up AND r.fence)
                            WHEN l.fence = 'close' THEN false ELSE r.fence END AS fence""",
)
assert CLOSING_READER != READER

_STEPS = [SPLIT, FLAGS, MARKERS, READER, CONTENTS, MERGE]


def _blocks(texts: str, upto: str, views: tuple[str, ...], select: str, reader: str = READER) -> str:
    """A query over the text-block steps up to ``upto``, applied to ``texts``."""
    steps = [reader if step is READER else step for step in _STEPS[: _STEPS.index(upto) + 1]]
    ctes = [_views(*views)] if views else []
    ctes += [f"texts AS MATERIALIZED ({texts})", *steps]
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + select


_MD = ("SELECT doc_id AS k, text FROM md", ("md",))


def _md(upto: str, select: str, reader: str = READER) -> str:
    return _blocks(_MD[0], upto, _MD[1], select, reader)


_NEWEST = "SELECT dataset || '/' || post_id AS k, dataset, post_id, text FROM newest"

_RECORD_ROWS = """
SELECT s.dataset, s.post_id, s.score,
       coalesce(p.n_text_blocks, 0) AS n_text_blocks, coalesce(p.text_blocks, '') AS text_blocks,
       coalesce(c.n_comments, 0) AS n_comments, coalesce(c.comments, '') AS comments
FROM scores s
LEFT JOIN (SELECT t.dataset, t.post_id, n_text_blocks, text_blocks
           FROM prose JOIN texts t USING (k)) p USING (dataset, post_id)
LEFT JOIN comment_lists c USING (dataset, post_id)
WHERE s.score > 0"""


def _records(condition: str = "") -> str:
    """Records, those that a further condition keeps."""
    return _blocks(_NEWEST, MERGE, ("newest", "scores", "comment_lists"), _RECORD_ROWS + condition)


_RECORDS = _records()

_SCORE = "coalesce(CAST(score AS VARCHAR), '(none)') AS score"

_COGROUP = """
FROM scores_with_repeats s
FULL JOIN (SELECT t.dataset, t.post_id, n_text_blocks, text_blocks
           FROM prose JOIN texts t USING (k)) p USING (dataset, post_id)
FULL JOIN comment_lists c USING (dataset, post_id)"""


def _escaped(value: str) -> str:
    for char, entity in (
        ("'&'", "&amp;"),
        ("'<'", "&lt;"),
        ("'>'", "&gt;"),
        ("'\"'", "&quot;"),
        ("chr(10)", "&#xA;"),
        ("chr(13)", "&#xD;"),
        ("chr(9)", "&#x9;"),
    ):
        value = f"replace({value}, {char}, '{entity}')"
    return value


def _row(**attributes: str) -> str:
    printed = " || ".join(
        f"' {name}=\"' || {_escaped(f'CAST({column} AS VARCHAR)')} || '\"'"
        for name, column in attributes.items()
    )
    return f"'  <row' || {printed} || ' />'"


_XML = {
    "posts": ("posts", _row(Id="post_id", Score="score"), "posts"),
    "comments": (
        "raw_comments",
        _row(Id="comment_id", PostId="post_id", Score="score", Text="text"),
        "comments",
    ),
    "post_history": (
        "history",
        _row(
            Id="event_id",
            PostId="post_id",
            PostHistoryTypeId="type_id",
            CreationDate="creation_date",
            Text="text",
        ),
        "posthistory",
    ),
}


def _xml_rows(name: str) -> str:
    view, row, _ = _XML[name]
    return f"SELECT dataset, {row} AS value FROM {view}"


def _scan(name: str) -> str:
    view, _, tag = _XML[name]
    frame = f"['<?xml version=\"1.0\" encoding=\"utf-8\"?>', '<{tag}>', '</{tag}>']"
    sites = "['a.example.com', 'b.example.com', 'c.example.com']"
    return f"""WITH {_views(view)} {_xml_rows(name)}
        UNION ALL SELECT d.dataset, f.value
        FROM (SELECT unnest({sites}) AS dataset) d, (SELECT unnest({frame}) AS value) f"""


_ALL_RAW = _views("posts", "raw_comments", "history")


def _count(view: str) -> str:
    return f"SELECT dataset, count(*) AS n FROM {view} GROUP BY dataset"


def _flags(*names: str) -> str:
    return ", ".join(f"CAST({name} AS BIGINT) AS {name}" for name in names)


_ATTRIBUTES = f"""WITH {_ALL_RAW}
        SELECT dataset, CAST(post_id AS VARCHAR) AS Id, '(absent)' AS PostId,
               '(absent)' AS PostHistoryTypeId, '(absent)' AS CreationDate,
               CAST(score AS VARCHAR) AS Score, '(absent)' AS Text FROM posts
        UNION ALL SELECT dataset, CAST(comment_id AS VARCHAR), CAST(post_id AS VARCHAR),
               '(absent)', '(absent)', CAST(score AS VARCHAR), text FROM raw_comments
        UNION ALL SELECT dataset, CAST(event_id AS VARCHAR), CAST(post_id AS VARCHAR),
               CAST(type_id AS VARCHAR), creation_date, '(absent)', text FROM history"""

ORACLES: dict[str, str] = {
    "scan_posts_xml": _scan("posts"),
    "scan_comments_xml": _scan("comments"),
    "scan_history_xml": _scan("post_history"),
    "dataset_from_path": f"""WITH {_ALL_RAW}
        SELECT dataset, 'posts' AS table_name, n + 3 AS n_lines FROM ({_count("posts")})
        UNION ALL SELECT dataset, 'comments', n + 3 FROM ({_count("raw_comments")})
        UNION ALL SELECT dataset, 'post_history', n + 3 FROM ({_count("history")})""",
    "multi_dataset_counts": f"""WITH {_ALL_RAW}
        SELECT dataset, count(*) FILTER (t = 1) AS n_posts, count(*) FILTER (t = 2) AS n_comments,
               count(*) FILTER (t = 3) AS n_post_history
        FROM (SELECT dataset, 1 AS t FROM posts UNION ALL SELECT dataset, 2 FROM raw_comments
              UNION ALL SELECT dataset, 3 FROM history)
        GROUP BY dataset""",
    "filter_row_lines": f"""WITH {_ALL_RAW}
        {_xml_rows("posts")} UNION ALL {_xml_rows("comments")}
        UNION ALL {_xml_rows("post_history")}""",
    "parse_row_attributes": _ATTRIBUTES,
    "rows_over_lines": _ATTRIBUTES,
    "cast_ids": f"""WITH {_ALL_RAW}
        SELECT dataset, 'posts' AS table_name, post_id AS Id, -1 AS PostId, -1 AS PostHistoryTypeId,
               score AS Score FROM posts
        UNION ALL SELECT dataset, 'comments', comment_id, post_id, -1, score FROM raw_comments
        UNION ALL SELECT dataset, 'post_history', event_id, post_id, type_id, -1 FROM history""",
    "dataset_slug": """
        SELECT dataset, 'corpus-job-' || regexp_replace(lower(dataset), '[^-a-z0-9]+', '', 'g') AS slug,
               count(*) AS n_rows
        FROM (SELECT upper(source[1]) || lower(source[2:]) || '. ' || upper(lang) || '_-site' AS dataset
              FROM documents)
        GROUP BY dataset""",
    "filter_post_edits": f"""WITH {_views("edits")}
        SELECT dataset, event_id AS Id, post_id AS PostId, type_id AS PostHistoryTypeId FROM edits""",
    "filter_comment_score": f"""WITH {_views("comments")}
        SELECT dataset, post_id, comment_id, score FROM comments""",
    "project_posts": f"WITH {_views('posts')} SELECT dataset, post_id, score FROM posts",
    "project_comments": f"""WITH {_views("comments")}
        SELECT dataset, post_id, comment_id, score, text FROM comments""",
    "project_history": f"""WITH {_views("history")}
        SELECT dataset, post_id, event_id, creation_date, text FROM history""",
    "comments_per_post": f"""WITH {_views("comment_lists")}
        SELECT dataset, post_id, n_comments, comments FROM comment_lists""",
    "single_score_per_post": f"""WITH {_views("scores_with_repeats")}
        SELECT dataset, post_id, {_SCORE} FROM scores_with_repeats""",
    "filter_positive_posts": f"""WITH {_views("scores_with_repeats")}
        SELECT dataset, post_id, score FROM scores_with_repeats WHERE score > 0""",
    "duplicate_posts": f"""WITH {_views("posts_with_repeats")}
        SELECT dataset, post_id, count(*) AS n_rows FROM posts_with_repeats
        GROUP BY dataset, post_id HAVING count(*) > 1""",
    "assert_unique_scores": f"""WITH {_views("posts_with_repeats")}
        SELECT count(*) AS n_posts, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows
        FROM (SELECT count(*) AS n FROM posts_with_repeats
              GROUP BY dataset, post_id HAVING count(*) > 1)""",
    "required_attribute_report": f"""WITH {_ALL_RAW},
        p AS (SELECT count(*) AS n, count(*) FILTER (post_id % 41 = 3) AS m,
                     count(*) FILTER (post_id % 41 = 5) AS b FROM posts),
        c AS (SELECT count(*) AS n, count(*) FILTER (comment_id % 41 = 3) AS m,
                     count(*) FILTER (comment_id % 41 = 5) AS b FROM raw_comments),
        h AS (SELECT count(*) AS n, count(*) FILTER (event_id % 41 = 3) AS m,
                     count(*) FILTER (event_id % 41 = 5) AS b FROM history)
        SELECT 'posts' AS table_name, 'Id' AS attribute, n AS n_rows, m AS n_missing, b AS n_malformed FROM p
        UNION ALL SELECT 'posts', 'Score', n, m, b FROM p
        UNION ALL SELECT 'comments', 'PostId', n, m, b FROM c
        UNION ALL SELECT 'comments', 'Score', n, m, b FROM c
        UNION ALL SELECT 'comments', 'Text', n, m, 0 FROM c
        UNION ALL SELECT 'post_history', 'PostHistoryTypeId', n, m, b FROM h
        UNION ALL SELECT 'post_history', 'PostId', n, m, b FROM h
        UNION ALL SELECT 'post_history', 'CreationDate', n, m, 0 FROM h""",
    "latest_version": f"""WITH {_views("newest")}
        SELECT dataset, post_id, event_id, creation_date, text FROM newest""",
    "latest_version_by_max": f"""WITH {_views("newest")}
        SELECT dataset, post_id, event_id, creation_date, text FROM newest""",
    "orphan_keys": f"""WITH {_views("posts", "comments", "edits")}
        SELECT dataset, post_id FROM (SELECT dataset, post_id FROM comments
                                      UNION SELECT dataset, post_id FROM edits)
        EXCEPT SELECT dataset, post_id FROM posts""",
    "split_lines": _md(SPLIT, "SELECT k AS doc_id, pos, raw FROM raw_lines"),
    "line_flags": _md(
        FLAGS,
        f"""SELECT k AS doc_id, pos, {_flags(
            "is_space", "is_indented", "is_language", "is_divider", "is_inline")},
            CAST(regexp_matches(raw, '[a-zA-Z0-9]') AS BIGINT) AS has_alnum FROM flagged""",
    ),
    "tag_strip": _md(
        MARKERS,
        """SELECT k AS doc_id, pos, CASE WHEN used_up THEN '(used up)' ELSE line END AS line,
           snippet AS set_snippet, code AS set_code, script AS set_script, fence AS set_fence,
           CAST(later AS BIGINT) AS close_code_after FROM marked""",
    ),
    "noncode_flags": _md(
        READER,
        f"SELECT k AS doc_id, pos, {_flags('in_code', 'after_symbols')} FROM reader WHERE kept",
    ),
    "line_block_state": _md(
        READER, "SELECT k AS doc_id, pos, state, block_no FROM reader WHERE kept"
    ),
    "block_content": _md(CONTENTS, "SELECT k AS doc_id, block_no, block_type, content FROM contents"),
    "nonblank_blocks": _md(
        CONTENTS, "SELECT k AS doc_id, block_no, block_type, content FROM nonblank"
    ),
    "blocks_by_type": _md(
        CONTENTS,
        """SELECT block_type, count(*) AS n_blocks, count(DISTINCT k) AS n_docs,
           CAST(sum(length(content)) AS BIGINT) AS n_chars FROM nonblank GROUP BY block_type""",
    ),
    "revise_blocks": _md(MERGE, "SELECT k AS doc_id, ord, block_type, content FROM merged"),
    "text_blocks": _md(MERGE, "SELECT k AS doc_id, n_text_blocks, text_blocks FROM prose"),
    "document_text_blocks": _blocks(
        "SELECT doc_id AS k, text FROM documents",
        MERGE,
        (),
        "SELECT k AS doc_id, n_text_blocks, text_blocks FROM prose",
    ),
    "cogroup_full_outer": _blocks(
        _NEWEST,
        MERGE,
        ("newest", "scores_with_repeats", "comment_lists"),
        f"""SELECT dataset, post_id, {_SCORE},
            coalesce(n_text_blocks, 0) AS n_text_blocks, coalesce(text_blocks, '') AS text_blocks,
            coalesce(n_comments, 0) AS n_comments, coalesce(comments, '') AS comments {_COGROUP}""",
    ),
    "flatten_and_default": _blocks(
        _NEWEST,
        MERGE,
        ("newest", "comments", "scores_with_repeats"),
        """, entries AS (
               SELECT t.dataset, t.post_id, 'text_block' AS part,
                      row_number() OVER (PARTITION BY k ORDER BY m.ord) - 1 AS ord, m.content AS text
               FROM merged m JOIN texts t USING (k) WHERE m.block_type = 'text'
               UNION ALL
               SELECT dataset, post_id, 'comment',
                      row_number() OVER (PARTITION BY dataset, post_id ORDER BY comment_id) - 1, text
               FROM comments),
           keys AS (SELECT dataset, post_id FROM scores_with_repeats
                    UNION SELECT dataset, post_id FROM newest UNION SELECT dataset, post_id FROM comments)
           SELECT dataset, post_id, part, coalesce(ord, -1) AS ord, coalesce(text, '(none)') AS text
           FROM keys CROSS JOIN (VALUES ('text_block'), ('comment')) AS p(part)
           LEFT JOIN entries USING (dataset, post_id, part)""",
    ),
    "records_long_form": _blocks(
        _NEWEST,
        MERGE,
        ("newest", "scores", "comments"),
        """SELECT dataset, post_id, score, 'post' AS part, -1 AS position, '(none)' AS text
           FROM scores WHERE score > 0
           UNION ALL
           SELECT dataset, post_id, s.score, 'text_block',
                  row_number() OVER (PARTITION BY k ORDER BY m.ord) - 1, m.content
           FROM merged m JOIN texts t USING (k) JOIN scores s USING (dataset, post_id)
           WHERE m.block_type = 'text' AND s.score > 0
           UNION ALL
           SELECT dataset, post_id, s.score, 'comment', comment_id, c.text
           FROM comments c JOIN scores s USING (dataset, post_id) WHERE s.score > 0""",
    ),
    "posts_with_text": _RECORDS,
    "sink_jsonl_roundtrip": _RECORDS,
    "sink_json_array_roundtrip": _RECORDS,
    "corpus_from_dump": _RECORDS,
    "sink_balanced_array_roundtrip": _RECORDS,
    "sink_streamed_roundtrip": _RECORDS,
    "sink_replaced_site": _records(" AND (s.dataset <> 'c.example.com' OR s.post_id % 2 = 0)"),
    "corpus_from_pretty_dump": _RECORDS,
    "sound_sites": _records(" AND s.dataset <> 'b.example.com'"),
    # Cut rows are not XML and have no further fault.  Of other comments and events, only the used
    # ones need all their attributes.
    "site_faults": f"""WITH {_ALL_RAW},
        p AS (SELECT post_id % 41 AS r, post_id % 100 = 77 AND post_id % 41 NOT IN (3, 5) AS cut
              FROM posts WHERE dataset = 'b.example.com'),
        c AS (SELECT comment_id % 41 AS r, comment_id % 100 = 77 AND comment_id % 41 NOT IN (3, 5) AS cut
              FROM raw_comments WHERE dataset = 'b.example.com'),
        h AS (SELECT event_id % 41 AS r, event_id % 100 = 77 AND event_id % 41 NOT IN (3, 5) AS cut
              FROM history WHERE dataset = 'b.example.com'),
        found AS (
            SELECT 'posts' AS table_name, 'malformed row' AS fault, count(*) FILTER (cut) AS n_rows FROM p
            UNION ALL SELECT 'posts', 'missing attribute Id', count(*) FILTER (r = 3) FROM p
            UNION ALL SELECT 'posts', 'missing attribute Score', count(*) FILTER (r = 3) FROM p
            UNION ALL SELECT 'posts', 'malformed attribute Id', count(*) FILTER (r = 5) FROM p
            UNION ALL SELECT 'posts', 'malformed attribute Score', count(*) FILTER (r = 5) FROM p
            UNION ALL SELECT 'comments', 'malformed row', count(*) FILTER (cut) FROM c
            UNION ALL SELECT 'comments', 'missing attribute Score', count(*) FILTER (r = 3) FROM c
            UNION ALL SELECT 'comments', 'malformed attribute Score', count(*) FILTER (r = 5) FROM c
            UNION ALL SELECT 'post_history', 'malformed row', count(*) FILTER (cut) FROM h
            UNION ALL SELECT 'post_history', 'missing attribute PostHistoryTypeId', count(*) FILTER (r = 3) FROM h
            UNION ALL SELECT 'post_history', 'malformed attribute PostHistoryTypeId', count(*) FILTER (r = 5) FROM h)
        SELECT 'b.example.com' AS dataset, table_name, fault, n_rows FROM found WHERE n_rows > 0
        UNION ALL SELECT 'd.example.com', 'comments', 'missing file', -1
        UNION ALL SELECT 'd.example.com', 'post_history', 'missing file', -1""",
    "text_blocks_by_fold": _md(MERGE, "SELECT k AS doc_id, n_text_blocks, text_blocks FROM prose"),
    "text_blocks_closed_fences": _md(
        MERGE, "SELECT k AS doc_id, n_text_blocks, text_blocks FROM prose", CLOSING_READER
    ),
    "blocks_without_merged": _md(
        MERGE,
        """SELECT k AS doc_id, row_number() OVER (PARTITION BY k ORDER BY i) - 1 AS ord, block_type, content
           FROM (SELECT k, gone, generate_subscripts(texts, 1) AS i, unnest(types) AS block_type,
                        unnest(texts) AS content FROM walk WHERE i = len(types))
           WHERE NOT list_contains(gone, i)""",
    ),
    "sink_shards": f"""WITH {_views("scores")}
        SELECT dataset, CAST(4 AS BIGINT) AS n_files, count(*) AS n_records
        FROM scores WHERE score > 0 GROUP BY dataset""",
}
