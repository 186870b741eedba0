"""DuckDB statements for those queries of this subpackage that SQL can express over whole tables."""

#: What ``str.split`` separates at.
_SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _tokens(column: str) -> str:
    return f"CAST(coalesce(len(list_filter(string_split_regex({column}, '{_SPACE}'), lambda x: x <> '')), 0) AS BIGINT)"


def _language(column: str) -> str:
    from quarryloom.llm.budget import CODE_LANGUAGES, LANGUAGES

    table = {a: code for group in (LANGUAGES, CODE_LANGUAGES) for code, names in group.items() for a in names.split()}
    cases = " ".join(f"WHEN '{a}' THEN '{c}'" for a, c in table.items())
    low = f"lower(trim({column}))"
    base = f"regexp_extract({low}, '^([^\\-_]*)', 1)"
    return f"CASE WHEN {column} IS NULL OR {low} = '' THEN 'und' ELSE coalesce(CASE {low} {cases} END, CASE {base} {cases} END, {low}) END"


_CATEGORY = "CASE WHEN category IS NULL OR lower(trim(category)) = '' THEN 'unknown' ELSE lower(trim(category)) END"
_COUNTED = f"(SELECT DISTINCT id, {_CATEGORY} AS category, {_language('language')} AS language, CAST(token_count AS BIGINT) AS token_count, {_tokens('content')} AS tokens FROM chunks)"
_SIZED = f"(SELECT doc_id, lower(trim(source)) AS source, {_tokens('text')} AS tokens FROM documents WHERE trim(coalesce(source, '')) <> '')"
_BUDGETS = f"""
SELECT t.source, t.max_repeats, h.docs, h.tokens, t.target_share * (SELECT sum(tokens) FROM {_SIZED}) AS wanted
FROM (SELECT lower(trim(source)) AS source, sum(target_share) AS target_share, max(max_repeats) AS max_repeats FROM mix_targets GROUP BY ALL) t
JOIN (SELECT source, count(*) AS docs, sum(tokens) AS tokens FROM {_SIZED} GROUP BY source) h USING (source)"""

_MIX = f"""WITH d AS (SELECT doc_id, source, CAST(tokens AS BIGINT) AS tokens, CAST('0x' || substr(md5(concat(doc_id, ':0')), 1, 15) AS BIGINT) AS key FROM {_SIZED}),
h AS (SELECT source, CAST(sum(tokens) AS BIGINT) AS tokens, count(*) AS docs FROM d GROUP BY source),
t AS (SELECT lower(trim(source)) AS source, sum(coalesce(target_share, 0)) AS target_share, greatest(coalesce(max(max_repeats), 1), 0) AS max_repeats FROM mix_targets WHERE trim(coalesce(source, '')) <> '' GROUP BY 1),
b AS (SELECT source, target_share, max_repeats, coalesce(docs, 0) AS docs, coalesce(tokens, 0) AS tokens, target_share * (SELECT coalesce(sum(tokens), 0) FROM h)::DOUBLE AS wanted FROM t LEFT JOIN h USING (source)),
r AS (SELECT *, CAST(CASE WHEN tokens > 0 THEN least(max_repeats, ceil(wanted / tokens - 1e-9)) ELSE 0 END AS INTEGER) AS repeats FROM b),
p AS (SELECT doc_id, source, tokens, coalesce(sum(tokens) OVER (PARTITION BY source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prefix FROM d),
mix AS (SELECT doc_id, source, p.tokens, CAST(repeats - CASE WHEN prefix < least(wanted, repeats * r.tokens) - (repeats - 1) * r.tokens THEN 0 ELSE 1 END AS INTEGER) AS copies FROM p JOIN r USING (source) WHERE repeats > 0)"""

_APOSTROPHES = "['’ʼ‘`´]"
_RUN = 12


def _plain(column: str) -> str:
    return f"regexp_extract_all(regexp_replace(lower({column}), '{_APOSTROPHES.replace(chr(39), chr(39) * 2)}', '', 'g'), '[\\p{{L}}\\p{{N}}]+')"


def _runs(table: str, key: str) -> str:
    return f"SELECT DISTINCT {key}, unnest(list_transform(range(1, len(w) - {_RUN} + 2), lambda i: array_to_string(w[i:i + {_RUN} - 1], ' '))) AS run FROM (SELECT {key}, {_plain('text')} AS w FROM {table} WHERE text IS NOT NULL) WHERE len(w) >= {_RUN}"


#: Folded words of the latest delivery of each query, equal words numbered, with trimmed and lower-cased positives.
_FOLDED = f"""l AS (SELECT DISTINCT ON (query_id) * FROM queries WHERE query_id IS NOT NULL ORDER BY query_id, labelled_at DESC NULLS LAST, text),
f AS (SELECT query_id, coalesce(nullif(lower(trim(split)), ''), 'train') AS split, lower(trim(source)) AS source, list_distinct(list_filter(list_transform(positives, lambda p: lower(trim(p))), lambda p: p IS NOT NULL AND p <> '')) AS positives,
  regexp_extract_all(replace(strip_accents(lower(translate(regexp_replace(text, '{_APOSTROPHES.replace(chr(39), chr(39) * 2)}', '', 'g'), '{"".join(chr(c) for c in range(0xFF10, 0xFF1A))}{"".join(chr(c) for c in range(0xFF21, 0xFF3B))}{"".join(chr(c) for c in range(0xFF41, 0xFF5B))}',
    '0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz'))), 'ß', 'ss'), '[\\p{{L}}\\p{{N}}]+') AS w FROM l),
n AS (SELECT query_id, split, source, positives, split = 'train' AS train, list_transform(w, lambda x, i: x || '#' || len(list_filter(w[1:i], lambda y: y = x))) AS t FROM f WHERE len(w) > 0 AND split IN ('train', 'test', 'validation'))"""
_EDITS = "greatest(len(e.t), len(r.t)) - len(list_intersect(e.t, r.t))"

_SPLIT = _SPACE[:-1]
_BOUNDARY = f"""WITH c AS (SELECT DISTINCT id, content FROM chunks WHERE {_tokens('content')} > 500), k AS (SELECT row_number() OVER () AS n, * FROM c),
l AS (SELECT n, id, unnest(string_split(content, chr(10))) AS line, generate_subscripts(string_split(content, chr(10)), 1) AS i FROM k),
f AS (SELECT *, regexp_matches(line, '^{_SPLIT}*```') AS mark, regexp_replace(line, '{_SPACE}', '', 'g') = '' AS blank, sum(CAST(regexp_matches(line, '^{_SPLIT}*```') AS INTEGER)) OVER (PARTITION BY n ORDER BY i) AS marks FROM l),
p AS (SELECT *, sum(CAST(blank AND marks % 2 = 0 AS INTEGER)) OVER (PARTITION BY n ORDER BY i) AS paragraph FROM f),
s AS (SELECT n, id, i, paragraph, unnest(string_split(regexp_replace(line, '([.!?]){_SPACE}', '\\1' || chr(1), 'g'), chr(1))) AS sentence FROM p),
t AS (SELECT n, id, i, paragraph, {_tokens('sentence')} AS m FROM s),
u AS (SELECT n, any_value(id) AS id, max(m) AS sentences FROM t GROUP BY n), v AS (SELECT n, max(m) AS lines FROM (SELECT n, i, sum(m) AS m FROM t GROUP BY n, i) GROUP BY n), w AS (SELECT n, max(m) AS paragraphs FROM (SELECT n, paragraph, sum(m) AS m FROM t GROUP BY n, paragraph) GROUP BY n)
SELECT DISTINCT id, CASE WHEN paragraphs <= 460 THEN 'paragraph' WHEN lines <= 460 THEN 'line' WHEN sentences <= 460 THEN 'sentence' ELSE 'word' END AS boundary FROM u JOIN v USING (n) JOIN w USING (n)"""

_VECTORS = " UNION ALL ".join(
    f"SELECT DISTINCT '{f}' AS field, id, CAST({f} AS DOUBLE[]) AS v FROM chunks WHERE id IS NOT NULL AND len({f}) = 48 AND len(list_filter({f}, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter({f}, lambda x: x <> 0)) > 0"
    for f in ("embedding", "embedding_summary_chunk", "embedding_summary_page"))

ORACLE_SQL: dict[str, str] = {
    "p2_found": f"""WITH u AS ({_VECTORS}), c AS (SELECT a.field, a.id AS x, b.id AS y, list_cosine_similarity(a.v, b.v) AS cosine FROM u a JOIN u b ON a.field = b.field AND a.id <> b.id),
        near AS (SELECT * FROM c WHERE cosine >= 0.93 QUALIFY row_number() OVER (PARTITION BY field, x ORDER BY round(cosine, 9) DESC, y) <= 10) SELECT DISTINCT field, least(x, y) AS id_a, greatest(x, y) AS id_b FROM near""",
    "p3_found": _BOUNDARY,
    "p7_found": f"WITH {_FOLDED} SELECT DISTINCT least(e.query_id, r.query_id) AS query_id_a, greatest(e.query_id, r.query_id) AS query_id_b FROM n e JOIN n r ON NOT e.train AND r.train AND len(list_intersect(e.positives, r.positives)) > 0 AND {_EDITS} <= 2",
    "p7_report": f"""WITH {_FOLDED}, k AS (SELECT *, list_sort(t) AS cls FROM n), te AS (SELECT DISTINCT cls AS t FROM k WHERE train), ee AS (SELECT DISTINCT cls AS t FROM k WHERE NOT train),
        best AS (SELECT e.t AS cls, min({_EDITS}) AS edits, count(*) AS links FROM ee e JOIN te r ON {_EDITS} <= 2 AND (len(list_intersect(e.t, r.t)) > 0 OR EXISTS (SELECT 1 FROM k a, k b WHERE a.cls = e.t AND NOT a.train AND b.cls = r.t AND b.train AND len(list_intersect(a.positives, b.positives)) > 0)) GROUP BY e.t)
        SELECT split, source, count(*) AS queries, count(*) FILTER (edits = 0) AS same_words, count(*) FILTER (edits > 0) AS near_same, CAST(coalesce(sum(links), 0) AS BIGINT) AS links FROM k LEFT JOIN best USING (cls) WHERE NOT train GROUP BY split, source""",
    "p8_found": f"WITH d AS ({_runs('documents', 'doc_id')}), i AS ({_runs('eval_items', 'item_id')}) SELECT DISTINCT doc_id, item_id FROM d JOIN i USING (run)",
    "p5_found": f"SELECT DISTINCT id, category, language FROM {_COUNTED} WHERE token_count IS NULL OR token_count <> tokens",
    "p5_totals": f"SELECT category, language, count(*) AS rows, CAST(sum(tokens) AS BIGINT) AS tokens FROM {_COUNTED} GROUP BY category, language",
    "p9_mix": f"{_MIX} SELECT doc_id, source, tokens, copies FROM mix WHERE copies > 0",
    "p9_report": f"""{_MIX}, m AS (SELECT source, CAST(sum(tokens * copies) AS BIGINT) AS mixed FROM mix GROUP BY source), a AS (SELECT sum(mixed) AS everything FROM m)
        SELECT r.source, target_share, max_repeats, docs, tokens, wanted, repeats, coalesce(mixed, 0) AS mixed_tokens, CAST(coalesce(mixed, 0) AS DOUBLE) / CAST(everything AS DOUBLE) AS actual_share
        FROM r LEFT JOIN m USING (source), a""",
    "p9_found": f"""WITH b AS ({_BUDGETS}), r AS (SELECT source, docs, CAST(least(max_repeats, ceil(wanted / tokens - 1e-9)) AS INTEGER) AS repeats FROM b WHERE tokens > 0)
        SELECT source, repeats FROM r WHERE docs > 0 AND repeats >= 2""",
}
