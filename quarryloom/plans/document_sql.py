"""DuckDB statements of the line-wise document queries. Fences of the documents are of backticks; every mark toggles."""

from __future__ import annotations

#: What ``str.split`` separates at.
SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
_ATX = r"^(#{1,6})\s+(.*?)\s*$"
_BLOCK = r"^(#{1,6})\s+(.+?)\s*#*\s*$"
TEXTS = "(SELECT doc_id, text FROM documents WHERE text IS NOT NULL)"


def words_sql(c: str) -> str:
    return f"len(list_filter(string_split_regex({c}, '{SPACE}'), lambda w: w <> ''))"


def lines_sql(table: str = TEXTS) -> str:
    """Common tables ``x``: ``doc_id, i, line, fenced``."""
    return rf"""l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM {table}),
      f AS (SELECT *, regexp_matches(line, '^\s*```') AS mark, sum(CAST(regexp_matches(line, '^\s*```') AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS marks FROM l),
      x AS (SELECT doc_id, i, line, mark OR marks % 2 = 1 AS fenced FROM f)"""


def sections_sql(heading: str = _ATX, fences: bool = True) -> str:
    """Common tables up to ``s``: ``doc_id, sec, marks, heading, body``; section 0 is the text before the first heading."""
    is_head = ("NOT fenced AND " if fences else "") + f"regexp_matches(line, '{heading}')"
    return f"""{lines_sql()}, g AS (SELECT *, {is_head} AS head, sum(CAST({is_head} AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS sec FROM x),
      s AS (SELECT doc_id, sec, max(CASE WHEN head THEN regexp_extract(line, '{heading}', 1) END) AS marks, max(CASE WHEN head THEN regexp_extract(line, '{heading}', 2) END) AS heading,
        coalesce(string_agg(CASE WHEN NOT head THEN line END, chr(10) ORDER BY i), '') AS body FROM g GROUP BY doc_id, sec)"""


def _lines(expression: str, where: str = "true", more: str = "") -> str:
    return f"WITH {lines_sql()}{more} SELECT doc_id, string_agg({expression}, chr(10) ORDER BY i) AS text FROM {'y' if more else 'x'} WHERE {where} GROUP BY doc_id"


M1 = f"""WITH {lines_sql()}, h AS (SELECT doc_id, min(i) AS first FROM x WHERE NOT fenced AND starts_with(line, '# ') GROUP BY doc_id)
  SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS text FROM x LEFT JOIN h USING (doc_id) WHERE i >= coalesce(first, 1) GROUP BY doc_id"""
M2 = _lines("line", r"NOT pat AND NOT (p IS NOT NULL AND coalesce(h, 0) < p) AND NOT regexp_full_match(line, '#\s*comment:\s*')", r""", z AS (SELECT *, regexp_matches(line, '^####[ \t]*On this page|^#####[ \t]*Search') AS pat FROM x),
  y AS (SELECT *, max(CASE WHEN pat THEN i END) OVER w AS p, max(CASE WHEN NOT pat AND starts_with(line, '#') THEN i END) OVER w AS h FROM z WINDOW w AS (PARTITION BY doc_id ORDER BY i))""")


def _rebuilt(fences: bool, kept: str, blanked: bool) -> str:
    body = f"CASE WHEN sec = 0 OR {kept} THEN body ELSE '' END" if blanked else "body"
    return f"""WITH {sections_sql(fences=fences)} SELECT doc_id, coalesce(string_agg(CASE WHEN sec > 0 THEN marks || ' ' || heading || CASE WHEN b <> '' THEN chr(10) || b ELSE '' END WHEN b <> '' THEN b END, chr(10) ORDER BY sec), '') AS text
      FROM (SELECT *, {body} AS b FROM s) {'' if blanked else f'WHERE sec = 0 OR {kept}'} GROUP BY doc_id"""


M3 = _rebuilt(False, r"length(regexp_replace(body, '^\s+|\s+$', '', 'g')) >= 30", True)
M10 = _rebuilt(True, f"{words_sql('body')} >= 5", False)
M4 = r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE text IS NOT NULL),
  a AS (SELECT doc_id, min(i) AS h1 FROM l WHERE regexp_matches(line, '^#[ \t]+\S') GROUP BY doc_id), b AS (SELECT doc_id, min(i) AS h2 FROM l JOIN a USING (doc_id) WHERE i > h1 AND regexp_matches(line, '^##[ \t]+\S') GROUP BY doc_id),
  c AS (SELECT doc_id, h1, string_agg('- ' || trim(regexp_extract(line, '^##[ \t]+(\S.*)$', 1)), chr(10) ORDER BY i) FILTER (i > h1 AND regexp_matches(line, '^##[ \t]+\S')) AS bullets,
    count(*) FILTER (i > h1 AND i < h2 AND trim(line) <> '') AS full_lines FROM l JOIN a USING (doc_id) JOIN b USING (doc_id) GROUP BY doc_id, h1)
  SELECT doc_id, string_agg(CASE WHEN i = h1 AND full_lines = 0 THEN line || chr(10) || chr(10) || 'For information about ' || trim(regexp_extract(line, '^#[ \t]+(\S.*)$', 1)) || ', see the following:' || chr(10) || chr(10) || bullets || chr(10) || chr(10) ELSE line END, chr(10) ORDER BY i) AS text
  FROM l LEFT JOIN c USING (doc_id) GROUP BY doc_id"""
M5 = r"""SELECT doc_id, CASE WHEN starts_with(ltrim(text, chr(10) || ' '), '#') OR t = '' THEN head || text ELSE head || '# ' || t || chr(10) || chr(10) || ltrim(text, chr(10)) END AS text
  FROM (SELECT doc_id, text, '---' || chr(10) || 'title: ' || title || chr(10) || '---' || chr(10) AS head, trim(trim(title), '"' || chr(39)) AS t FROM documents WHERE text IS NOT NULL AND title IS NOT NULL)"""
M6 = _lines(r"CASE WHEN fenced THEN line ELSE regexp_replace(line, '^(#{1,6})\s+\d+(?:\.\d+)*\.?\s+(\S)', '\1 \2') END")
M8 = _lines(r"CASE WHEN fenced THEN regexp_replace(line, '^\d{1,3}(\D|$)', '\1') ELSE line END")
M11 = _lines(r"line || CASE WHEN head AND (n IS NULL OR (trim(n) <> '' AND NOT starts_with(ltrim(n), '#') AND NOT starts_with(n, '```'))) THEN chr(10) ELSE '' END", "true",
             r", y AS (SELECT *, NOT fenced AND regexp_matches(line, '^#{1,6}[ \t]+\S') AS head, lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS n FROM x)")
M12 = r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE text IS NOT NULL),
  c AS (SELECT *, regexp_matches(line, '^\s*//([^/]|$)') AS note FROM l), r AS (SELECT *, note AND coalesce(lag(note) OVER (PARTITION BY doc_id ORDER BY i), false) AS joined FROM c),
  n AS (SELECT *, sum(CAST(NOT joined AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM r),
  u AS (SELECT doc_id, run, string_agg(CASE WHEN joined THEN regexp_replace(regexp_replace(line, '^\s*//\s?', ''), '^\s+|\s+$', '', 'g') WHEN many > 1 THEN regexp_replace(line, '\s+$', '') ELSE line END, ' ' ORDER BY i) AS line
    FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, run) AS many FROM n) GROUP BY doc_id, run) SELECT doc_id, string_agg(line, chr(10) ORDER BY run) AS text FROM u GROUP BY doc_id"""
T1 = f"SELECT * FROM {TEXTS}"
M16 = r"""SELECT id, '---' || chr(10) || 'title: ' || CASE WHEN coalesce(metadata_title, '') = '' THEN 'Overview' WHEN list_contains(string_split(metadata_title, ' - '), 'Overview') THEN metadata_title ELSE metadata_title || ' - Overview' END || chr(10) || 'author: ' || chr(10) || 'category: ' || coalesce(metadata_category, '') || chr(10)
  || 'description: ' || chr(10) || 'tags: ' || array_to_string(list_filter(list_transform(t, lambda v, i: CASE WHEN list_position(t, v) = i THEN v END), lambda v: v IS NOT NULL), ', ') || chr(10) || 'date: ' || chr(10) || '---' || chr(10) AS block
  FROM (SELECT *, list_append(list_filter(list_transform(string_split_regex(CASE WHEN trim(coalesce(tags, '')) = '[]' THEN '' ELSE coalesce(tags, '') END, '[,|;]'), lambda v: trim(v)), lambda v: v <> ''), 'level=1') AS t FROM catalogue)"""
BLOCKS = f"""{sections_sql(_BLOCK)}, blocks AS (SELECT CAST(doc_id AS VARCHAR) AS file, CAST(sec - 1 AS INTEGER) AS seq, heading, CAST(length(marks) AS INTEGER) AS level, trim(body, chr(10)) AS content FROM s WHERE sec > 0)"""
G1 = f"WITH {BLOCKS} SELECT * FROM blocks"
G2 = f"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM {TEXTS}),
  f AS (SELECT *, sum(CAST(starts_with(ltrim(line), '```') AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) % 2 = 1 AS fenced FROM l), g AS (SELECT *, NOT fenced AND regexp_matches(line, '^\\s{{0,3}}(#{{1,6}})\\s+(.+?)\\s*$') AS head FROM f),
  h AS (SELECT *, sum(CAST(head AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS sec FROM g)
  SELECT doc_id, CAST(sec - 1 AS INTEGER) AS seq, CAST(max(CASE WHEN head THEN length(regexp_extract(line, '^\\s{{0,3}}(#{{1,6}})\\s+(.+?)\\s*$', 1)) END) AS INTEGER) AS level, max(CASE WHEN head THEN regexp_extract(line, '^\\s{{0,3}}(#{{1,6}})\\s+(.+?)\\s*$', 2) END) AS title,
    CAST({words_sql("coalesce(string_agg(CASE WHEN NOT head THEN line END, chr(10) ORDER BY i), '')")} AS INTEGER) AS words FROM h WHERE sec > 0 GROUP BY doc_id, sec"""
G6 = f"""WITH {lines_sql()} SELECT doc_id, CAST(i - 1 AS INTEGER) AS line, coalesce(regexp_extract(trim(line), '{_BLOCK}', 2), '') AS heading, CASE WHEN regexp_matches(trim(line), '{_BLOCK}') THEN CAST(length(regexp_extract(trim(line), '{_BLOCK}', 1)) AS INTEGER) ELSE 999 END AS level FROM x"""
_TOKENS = "CAST(len(list_filter(string_split_regex(lower(content), '\\s+'), lambda w: w <> '')) AS BIGINT)"
SUBTREES = f"""{BLOCKS}, t AS (SELECT file, seq, level, heading, {_TOKENS} AS tokens FROM blocks), e AS (SELECT a.file, a.seq, min(b.seq) AS end_seq FROM t a LEFT JOIN t b ON b.file = a.file AND b.seq > a.seq AND b.level <= a.level GROUP BY ALL),
  n AS (SELECT t.*, end_seq, lead(level) OVER (PARTITION BY t.file ORDER BY t.seq) AS nxt FROM t JOIN e ON e.file = t.file AND e.seq = t.seq),
  subtrees AS (SELECT a.file, a.seq, a.level, a.heading, a.tokens, a.end_seq, CASE WHEN a.nxt > a.level THEN CAST(sum(b.tokens) AS BIGINT) END AS cumulative FROM n a JOIN t b ON b.file = a.file AND b.seq >= a.seq AND (a.end_seq IS NULL OR b.seq < a.end_seq) GROUP BY a.file, a.seq, a.level, a.heading, a.tokens, a.end_seq, a.nxt)"""
H7 = f"WITH {SUBTREES} SELECT file, seq, level, tokens, end_seq, cumulative FROM subtrees"
K21 = f"WITH {SUBTREES} SELECT CAST(seq AS BIGINT) AS row, level, heading, tokens, cumulative FROM subtrees UNION ALL SELECT NULL, NULL, 'Total', CAST(sum(tokens) AS BIGINT), NULL FROM subtrees"


def duplicates_sql(rows: str) -> str:
    """Duplicate headings of ``rows``: a statement of ``file, seq, heading, level``."""
    return f"""WITH b AS ({rows}), p AS (SELECT a.file, a.seq, a.heading, a.level, max(c.seq) AS parent_seq FROM b a LEFT JOIN b c ON c.file = a.file AND c.seq < a.seq AND c.level < a.level GROUP BY ALL)
      SELECT file, parent_seq, heading, level, list(seq ORDER BY seq) AS places FROM p GROUP BY file, parent_seq, heading, level HAVING count(*) > 1"""


def chunk_lines_sql(chunks: str) -> str:
    """Common tables ``x`` over chunk contents: ``doc_id`` (the id), ``i, line, fenced`` and ``ofs``, the line's offset in characters."""
    return lines_sql(f"(SELECT id AS doc_id, content AS text FROM {chunks} WHERE content IS NOT NULL)") + rf""",
      o AS (SELECT *, CAST(coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS ofs FROM x)"""


_SEPARATOR = r"^\s*\|?\s*:?-+:?\s*(\|\s*:?-+:?\s*)*\|?\s*$"
_WIDTH = """length(regexp_replace(line, '"[^"]*"', '', 'g')) - length(replace(regexp_replace(line, '"[^"]*"', '', 'g'), ',', '')) + 1"""


def _pipe_runs(chunks: str) -> str:
    """Tables of pipe rows: ``p`` holds their lines with the number ``run`` of the table and ``k``, the place in it."""
    return rf"""{chunk_lines_sql(chunks)}, r AS (SELECT *, NOT fenced AND starts_with(ltrim(line), '|') AS pipe FROM o),
      b AS (SELECT *, sum(CAST(NOT pipe AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM r),
      q AS (SELECT *, row_number() OVER (PARTITION BY doc_id, run ORDER BY i) AS k, lead(line) OVER (PARTITION BY doc_id, run ORDER BY i) AS nxt FROM b WHERE pipe),
      p AS (SELECT * FROM q WHERE (doc_id, run) IN (SELECT doc_id, run FROM q WHERE k = 1 AND regexp_matches(coalesce(nxt, ''), '{_SEPARATOR}') AND contains(nxt, '|')))"""


def table_spans_sql(chunks: str) -> str:
    return f"""WITH {_pipe_runs(chunks)}, m AS (SELECT doc_id, i, ofs FROM o WHERE NOT fenced AND trim(line) = '<!-- Data Table -->'),
      hd AS (SELECT m.doc_id, m.i, m.ofs, min(o.i) AS first FROM m JOIN o ON o.doc_id = m.doc_id AND o.i > m.i AND trim(o.line) <> '' AND NOT starts_with(o.line, 'Table:') GROUP BY ALL),
      w AS (SELECT hd.*, {_WIDTH} AS width FROM hd JOIN o ON o.doc_id = hd.doc_id AND o.i = hd.first),
      e AS (SELECT w.doc_id, w.i, w.ofs, w.first, w.width, coalesce(min(o.i), max(n.last) + 1) AS stop FROM w JOIN (SELECT doc_id, max(i) AS last FROM o GROUP BY doc_id) n ON n.doc_id = w.doc_id
        LEFT JOIN o ON o.doc_id = w.doc_id AND o.i > w.first AND (trim(o.line) = '' OR o.fenced OR {_WIDTH} <> w.width) GROUP BY ALL)
      SELECT e.doc_id AS id, e.ofs AS start, CAST(o.ofs + length(o.line) AS INTEGER) AS "end", 'csv' AS kind, CAST(stop - first AS INTEGER) AS rows FROM e JOIN o ON o.doc_id = e.doc_id AND o.i = e.stop - 1 WHERE width >= 2 AND stop - first >= 2
      UNION ALL SELECT doc_id, min(ofs), CAST(max(ofs + length(line)) AS INTEGER), 'pipe', CAST(count(*) FILTER (NOT regexp_matches(line, '{_SEPARATOR}')) AS INTEGER) FROM p GROUP BY doc_id, run"""


def pipe_to_csv_sql(chunks: str) -> str:
    cells = "list_transform(string_split(trim(trim(line), '|'), '|'), lambda c: trim(c))"
    row = f"""array_to_string(list_transform({cells}, lambda c, n: CASE WHEN c = '' AND k = 1 THEN 'Column ' || n WHEN regexp_matches(c, '[,"]') THEN '"' || replace(c, '"', '""') || '"' ELSE c END), ',')"""
    return f"""WITH {_pipe_runs(chunks)}, t AS (SELECT o.doc_id, o.i, CASE WHEN p.i IS NULL THEN o.line WHEN p.k = 1 THEN '<!-- Data Table -->' || chr(10) || p.text WHEN p.k <> 2 THEN p.text END AS line
        FROM o LEFT JOIN (SELECT doc_id, i, k, {row} AS text FROM p) p ON p.doc_id = o.doc_id AND p.i = o.i)
      SELECT c.id, a.content FROM {chunks} c LEFT JOIN (SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS content FROM t GROUP BY doc_id) a ON a.doc_id = c.id"""


def decorated_sql(chunks: str) -> str:
    return f"""WITH {chunk_lines_sql(f"(SELECT * FROM {chunks} WHERE chunk_type = 'table')")}, b AS (SELECT doc_id, i, line, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k, count(*) OVER (PARTITION BY doc_id) AS n
        FROM o WHERE trim(line) <> '' AND trim(line) <> '<!-- Data Table -->' AND NOT starts_with(line, 'Table:')),
      g AS (SELECT doc_id, max(n) - 1 AS rows, max(CASE WHEN k = 2 THEN split_part(line, ',', 1) END) AS first, max(CASE WHEN k = n THEN split_part(line, ',', 1) END) AS last FROM b GROUP BY doc_id),
      y AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS body FROM o WHERE trim(line) <> '<!-- Data Table -->' AND NOT starts_with(line, 'Table:') GROUP BY doc_id)
      SELECT c.id, CASE WHEN coalesce(g.rows, 0) < 1 THEN coalesce(c.content, '') ELSE '<!-- Data Table -->' || chr(10) || 'Table: ' || coalesce(c.heading, '') || ' (from ' || g.first || ' to ' || g.last || ': ' || g.rows || ' rows)' || chr(10) || coalesce(y.body, '') END AS content
      FROM (SELECT * FROM {chunks} WHERE chunk_type = 'table') c LEFT JOIN g ON g.doc_id = c.id LEFT JOIN y ON y.doc_id = c.id"""


def rollup_sql(chunks: str, tree: str, summary: str) -> str:
    """Page rollup: ``tree`` states ``id, root``; ``summary`` the summary or null."""
    return f"""WITH f AS (SELECT id, root FROM ({tree})), k AS (SELECT c.id, c.pos, c.content, {summary} AS s, coalesce(f.root, c.filename) AS key FROM {chunks} c LEFT JOIN f ON f.id = c.id)
      SELECT key, count(*) AS members, CAST(sum(len(list_filter(string_split_regex(lower(coalesce(content, '')), '\\s+'), lambda w: w <> ''))) AS BIGINT) AS tokens,
        concat_ws(chr(10), max(CASE WHEN id = key THEN content END), coalesce(string_agg('- ' || s, chr(10) ORDER BY pos, s) FILTER (s IS NOT NULL), '')) AS text FROM k GROUP BY key"""


G9 = f"""WITH {lines_sql()} SELECT doc_id, string_agg(CASE WHEN NOT fenced AND regexp_matches(line, '{_BLOCK}') THEN regexp_extract(line, '{_BLOCK}', 1) || ' ' || regexp_extract(line, '{_BLOCK}', 2)
    WHEN starts_with(line, '#') THEN trim(ltrim(line, '#')) ELSE line END, chr(10) ORDER BY i) AS text FROM x GROUP BY doc_id"""


def fence_languages_sql(chunks: str) -> str:
    """Closed fences by their tag and the language that their signs show."""
    from quarryloom.operators.code import SIGNS

    quote = chr(39)
    signs = " ".join(f"WHEN regexp_matches(code, '(?m{'i' if name == 'sql' else ''}){rx.replace(quote, quote * 2)}') THEN '{name}'" for name, rx in SIGNS)
    return rf"""WITH {chunk_lines_sql(chunks)}, n AS (SELECT doc_id, i, line, regexp_matches(line, '^\s*```') AS mark, sum(CAST(regexp_matches(line, '^\s*```') AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS marks FROM x),
      g AS (SELECT doc_id, (marks + 1) // 2 AS fence, max(CASE WHEN mark AND marks % 2 = 1 THEN lower(regexp_extract(line, '^[ \t]*```([A-Za-z0-9_+\-.#]*)', 1)) END) AS tag,
        coalesce(string_agg(CASE WHEN NOT mark THEN line END, chr(10) ORDER BY i), '') AS code, count(*) FILTER (mark AND marks % 2 = 0) AS closed FROM n WHERE marks % 2 = 1 OR mark GROUP BY doc_id, (marks + 1) // 2),
      d AS (SELECT tag, CASE WHEN json_valid(trim(code)) AND left(trim(code), 1) IN ('{{', '[') THEN 'json' WHEN regexp_matches(code, '(?m)^\s*<MIFFile\b') THEN 'mif'
        WHEN starts_with(ltrim(code), '<') AND regexp_matches(code, '(?i)^\s*<(!doctype html|html|head|body|div|p|ul|table|a)\b') THEN 'html' WHEN starts_with(ltrim(code), '<') THEN 'xml' {signs} ELSE 'text' END AS found FROM g WHERE closed > 0)
      SELECT tag, found, count(*) AS fences FROM d GROUP BY tag, found"""
