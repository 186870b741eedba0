"""Queries over parsers, hierarchy, stores, streams and pipelines."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from quarryloom.functions import text as T
from quarryloom.operators import code, markdown, sections, summaries, tables
from quarryloom.operators.forest import chunk_forest
from quarryloom.plans import document_sql as S
from quarryloom.plans.registry import CHUNKS, chunks, query
from quarryloom.plans.relational_queries import tok_sql
from quarryloom.plans.scalar_queries import strip_sql, valid_sql
from quarryloom.runtime import read_table
from quarryloom.sources import readers, writers
from quarryloom.streaming import events as stream


def _docs(spark, d):
    return read_table(spark, d, "documents").where(F.col("text").isNotNull())


# --- cleaning, code, tables ------------------------------------------------------------------------------------------


def _step(name: str, *steps, sql: str | None = None):
    @query(name, sql)
    def run(spark, d):
        return _docs(spark, d).select("doc_id", markdown.text_udf(*steps)(F.col("text")).alias("text"))

    return run


_step("q_m1_drop_before_h1", markdown.drop_before_h1, sql=S.M1)
_step("q_m2_drop_furniture_sections", markdown.drop_furniture_sections, sql=S.M2)
_step("q_m3_blank_short_sections", markdown.blank_short_sections, sql=S.M3)
_step("q_m4_fill_empty_h1", markdown.fill_empty_h1, sql=S.M4)
_step("q_m6_strip_heading_numbers", markdown.strip_heading_numbers, sql=S.M6)
_step("q_m7_annotate_fences", code.annotate_fences)
_step("q_m8_strip_line_numbers", markdown.strip_line_numbers, sql=S.M8)
_step("q_m10_drop_short_sections", lambda t: markdown.drop_short_sections(t, 5), sql=S.M10)
_step("q_m11_blank_after_headings", markdown.blank_after_headings, sql=S.M11)
_step("q_m12_m13_unwrap_comments", markdown.unwrap_comments, sql=S.M12)
_step("q_c3_c4_c5_c9_format_fences", code.format_fences)
_step("q_t1_html_tables", tables.html_tables_to_csv, sql=S.T1)
_step("q_t10_move_error_tables", tables.move_error_tables, sql=S.T1)


@query("q_m5_ensure_h1", S.M5)
def m5(spark, d):
    """Texts with their title as front matter."""
    head = F.concat(F.lit("---\ntitle: "), "title", F.lit("\n---\n"), "text")
    return _docs(spark, d).where(F.col("title").isNotNull()).select("doc_id", markdown.text_udf(markdown.ensure_h1)(head).alias("text"))


_RULES = [(r"[ \t]+\n", "\n", ""), (r"\n{3,}", "\n\n", ""), (r"(\d+) rows", r"\1 lines", "I")]


@query("q_m9_regex_rules", "SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, '[ \\t]+\\n', chr(10), 'g'), '\\n{3,}', chr(10) || chr(10), 'g'), '(?i)(\\d+) rows', '\\1 lines', 'g') AS text FROM documents WHERE text IS NOT NULL")
def m9(spark, d):
    return _docs(spark, d).select("doc_id", markdown.apply_rules(F.col("text"), _RULES).alias("text"))


@query("q_k18_cleaning_chain")
def clean(spark, d):
    return markdown.clean_documents(_docs(spark, d).select("doc_id", "text"), rules=_RULES)


@query("q_m16_m17_m18_metadata", S.M16)
def m16(spark, d):
    """Catalogue metadata merged with a page's front matter, as a front matter block."""
    c = read_table(spark, d, "catalogue")

    @F.pandas_udf("string")
    def merged(title: pd.Series, category: pd.Series, tags: pd.Series) -> pd.Series:
        out = []
        for a, b, t in zip(title, category, tags, strict=True):
            meta = markdown.merge_metadata({"title": a, "category": b, "tags": t}, {"title": "Overview", "level": "1"})
            out.append(markdown.front_matter_block(meta))
        return pd.Series(out)

    return c.select("id", merged("metadata_title", "metadata_category", "tags").alias("block"))


@query("q_c1_c2_detect_language", S.fence_languages_sql(CHUNKS))
def c1(spark, d):
    """Fences by detected language against their tag."""

    @F.pandas_udf("array<struct<tag:string,found:string>>")
    def spans(s: pd.Series) -> pd.Series:
        return s.map(lambda t: [{"tag": g.lower(), "found": code.detect_language(c)} for _, _, g, c in code.code_spans(t)] if isinstance(t, str) else [])

    return chunks(spark, d, "content").select(F.explode(spans("content")).alias("x")).groupBy("x.tag", "x.found").agg(F.count(F.lit(1)).alias("fences"))


@query("q_c6_c7_c8_split_functions")
def c6(spark, d):
    @F.pandas_udf("array<string>")
    def split(s: pd.Series) -> pd.Series:
        return s.map(lambda t: [p for _, _, g, c in code.code_spans(t) for p in code.split_code(c, g)] if isinstance(t, str) else [])

    return chunks(spark, d, "content", "chunk_type").where("chunk_type = 'example'").select("id", F.posexplode(split("content")).alias("part", "code"))


@query("q_t2_pipe_tables", S.pipe_to_csv_sql(CHUNKS))
def t2(spark, d):
    return chunks(spark, d, "content").select("id", markdown.text_udf(tables.pipe_tables_to_csv)(F.col("content")).alias("content"))


@query("q_t3_t4_t5_table_spans", S.table_spans_sql(CHUNKS))
def t3(spark, d):
    @F.pandas_udf("array<struct<start:int,end:int,kind:string,rows:int>>")
    def spans(s: pd.Series) -> pd.Series:
        return s.map(lambda t: [{"start": a, "end": b, "kind": k, "rows": len(tables.parse_table(t[a:b]))} for a, b, k in tables.table_spans(t)] if isinstance(t, str) else [])

    return chunks(spark, d, "content").select("id", F.explode(spans("content")).alias("x")).select("id", "x.*")


@query("q_t6_t7_t8_t9_split_tables")
def t6(spark, d):
    @F.pandas_udf("array<struct<table:int,part:int,tokens:int,overflow:boolean>>")
    def split(s: pd.Series) -> pd.Series:
        return s.map(lambda t: [dict(zip(("table", "part", "tokens", "overflow"), x, strict=True)) for x in tables.split_marked_tables(t, 100, 200)[1]] if isinstance(t, str) else [])

    return chunks(spark, d, "content", "chunk_type").where("chunk_type = 'table'").select("id", F.explode(split("content")).alias("x")).select("id", "x.*")


@query("q_m20_decorate_tables", S.decorated_sql(CHUNKS))
def m20(spark, d):
    @F.pandas_udf("string")
    def caption(h: pd.Series, t: pd.Series) -> pd.Series:
        return pd.Series([tables.decorate(a or "", b or "") for a, b in zip(h, t, strict=True)])

    return chunks(spark, d, "heading", "content", "chunk_type").where("chunk_type = 'table'").select("id", caption("heading", "content").alias("content"))


# --- parsers and hierarchy -------------------------------------------------------------------------------------------


def _blocks(spark, d):
    return sections.explode_blocks(_docs(spark, d).select(F.col("doc_id").cast("string").alias("path"), "text"))


@query("q_g1_heading_blocks", S.G1)
def g1(spark, d):
    return _blocks(spark, d)


@query("q_g2_report_sections", S.G2)
def g2(spark, d):
    @F.pandas_udf("array<struct<level:int,title:string,words:int>>")
    def parse(s: pd.Series) -> pd.Series:
        return s.map(lambda t: [{"level": n, "title": h, "words": len(c.split())} for n, h, c in sections.report_sections(t)])

    return _docs(spark, d).select("doc_id", F.posexplode(parse("text")).alias("seq", "s")).select("doc_id", "seq", "s.*")


@query("q_g3_g4_front_matter", f"SELECT id, {strip_sql('title')} AS title, body FROM (SELECT id, title, coalesce(content, '') AS body FROM {CHUNKS} WHERE title IS NOT NULL)")
def g3(spark, d):
    """Front matter written and parsed back."""
    @F.pandas_udf("struct<title:string,body:string>")
    def parse(s: pd.Series) -> pd.DataFrame:
        both = [markdown.front_matter(t) for t in s]
        return pd.DataFrame({"title": [m.get("title") for m, _ in both], "body": [b for _, b in both]})

    c = chunks(spark, d, "title", "content").where(F.col("title").isNotNull())
    text = F.concat(F.lit("---\ntitle: "), "title", F.lit("\nauthor: x\n---\n"), F.coalesce("content", F.lit("")))
    return c.select("id", parse(text).alias("p")).select("id", "p.title", "p.body")


@query("q_g5_fence_tags", f"SELECT tag, count(*) AS fences FROM (SELECT unnest(regexp_extract_all(replace(content, chr(13), ''), '(?s)```([A-Za-z0-9_+.-]*)[ \\t]*\\n(.*?)\\n[ \\t]*```', 1)) AS tag FROM {CHUNKS}) GROUP BY tag")
def g5(spark, d):
    tags = F.regexp_extract_all(F.replace("content", F.lit("\r"), F.lit("")), F.lit(r"(?s)```([A-Za-z0-9_+.-]*)[ \t]*\n(.*?)\n[ \t]*```"), F.lit(1))
    return chunks(spark, d, "content").select(F.explode(tags).alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("fences"))


@query("q_g6_heading_lines", S.G6)
def g6(spark, d):
    """Every line of every document as a heading or none."""
    lines = _docs(spark, d).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "raw"))
    return lines.select("doc_id", "line", sections.heading_of(F.col("raw")).alias("h")).select("doc_id", "line", "h.*")


@query("q_g7_g10_h1_q5_build_chunks")
def g7(spark, d):
    return sections.build_chunks(_docs(spark, d).select(F.col("doc_id").cast("string").alias("path"), "text"), limit=200)


@query("q_g8_score_reduce", f"SELECT id, round(list_avg(list_transform([v[1:16], v[17:32], v[33:48]], lambda r: list_max(r))), 6) AS score FROM (SELECT id, CAST(embedding AS DOUBLE[]) AS v FROM {CHUNKS} WHERE {valid_sql('embedding')})")
def g8(spark, d):
    from quarryloom.functions import vectors as V

    m = F.array(*[F.transform(F.slice("embedding", a, 16), lambda x: x.cast("double")) for a in (1, 17, 33)])
    return chunks(spark, d, "embedding").where(V.valid(F.col("embedding"), 48)).select("id", F.round(sections.reduce_scores(m), 6).alias("score"))


@query("q_g9_j13_toc_headings", S.G9)
def g9(spark, d):
    """Headings stripped of their marks and rebuilt from their own table of contents."""

    def rebuild(t: str) -> str:
        toc = [(n, h) for h, n, _ in sections.heading_blocks(t)]
        return sections.headings_from_toc("\n".join(x.lstrip("#").strip() if x.startswith("#") else x for x in t.split("\n")), toc)

    return _docs(spark, d).select("doc_id", markdown.text_udf(rebuild)(F.col("text")).alias("text"))


@query("q_s15_s16_kept_pages", "SELECT doc_id AS document, p AS page FROM (SELECT doc_id, unnest(range(1, 11)) AS p FROM documents) WHERE p > 1 AND p <= 9 AND NOT p BETWEEN 4 AND 5")
def s15(spark, d):
    pages = read_table(spark, d, "documents").select(F.col("doc_id").alias("document"), F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(10).cast("bigint"))).alias("page"))
    return sections.kept_pages(pages, 1, 1, [(4, 5)])


@query("q_h3_h4_h5_page_rollup")
def h5(spark, d):
    c = chunks(spark, d, "filename", "pos", "content", "chunk_summary")
    f = chunk_forest(read_table(spark, d, "chunks"))
    return summaries.page_rollup(f, c)


_CHUNK_BLOCKS = f"SELECT filename AS file, pos AS seq, lower(split_part(heading, ' ', 1)) AS heading, header_level AS level FROM {CHUNKS} WHERE filename IS NOT NULL AND heading IS NOT NULL AND header_level BETWEEN 1 AND 6"


@query("q_h6_duplicate_headings", S.duplicates_sql(_CHUNK_BLOCKS))
def h6(spark, d):
    """First words of headings that recur under one parent."""
    c = chunks(spark, d, "filename", "pos", "heading", "header_level").where("filename IS NOT NULL AND heading IS NOT NULL AND header_level BETWEEN 1 AND 6")
    b = c.select(F.col("filename").alias("file"), F.col("pos").alias("seq"), F.lower(F.split("heading", " ")[0]).alias("heading"), F.col("header_level").alias("level"))
    return sections.duplicate_headings(sections.with_hierarchy(b))


@query("q_h7_h8_w4_w10_subtree_tokens", S.H7)
def h7(spark, d):
    s = _blocks(spark, d).select("file", "seq", "level", T.token_count(F.col("content")).alias("tokens"))
    return sections.subtree_tokens(s)


@query("q_k21_a4_u5_token_report", S.K21)
def k21(spark, d):
    s = _blocks(spark, d).select("file", "seq", "level", "heading", T.token_count(F.col("content")).alias("tokens"))
    return writers.token_report(sections.subtree_tokens(s))


# --- sources, sinks, stores ------------------------------------------------------------------------------------------


@query("q_s4_s5_corpus_texts", f"SELECT id, text FROM (SELECT id, coalesce(CASE WHEN {strip_sql('chunk_summary')} <> '' AND lower({strip_sql('chunk_summary')}) <> 'false' THEN {strip_sql('chunk_summary')} END, nullif({strip_sql('content')}, '')) AS text FROM {CHUNKS}) WHERE text IS NOT NULL AND id <> ''")
def s4(spark, d):
    return readers.corpus_texts(chunks(spark, d, "chunk_summary", "content"))


@query("q_s1_catalogue", "SELECT id, parser, coalesce(nullif(trim(base_dir), ''), 'run') AS base_dir FROM catalogue")
def s1(spark, d):
    return read_table(spark, d, "catalogue").select("id", "parser", F.coalesce(F.nullif(F.trim("base_dir"), F.lit("")), F.lit("run")).alias("base_dir"))


@query("q_s13_url_list", "SELECT crawl_url AS url FROM catalogue WHERE trim(crawl_url) <> '' AND NOT starts_with(trim(crawl_url), '#')")
def s13(spark, d):
    v = F.trim("crawl_url")
    return read_table(spark, d, "catalogue").where((v != "") & ~v.startswith("#")).select(F.col("crawl_url").alias("url"))


@query("q_s14_tree_files", r"SELECT DISTINCT filename AS path FROM chunks WHERE regexp_matches(filename, '\.mdx?$|\.markdown$')")
def s14(spark, d):
    c = chunks(spark, d, "filename")
    folder = F.split("filename", "/")[0]
    files = c.select(F.col("filename").alias("path"), folder.alias("parent"), F.lit("file").alias("kind")).distinct()
    roots = c.select(folder.alias("path"), F.lit(None).cast("string").alias("parent"), F.lit("dir").alias("kind")).distinct()
    return readers.tree_files(files.unionByName(roots), roots.select("path"))


@query("q_k1_ordered_chunks", f"SELECT id, 'T' AS title, 'C' AS category, 'prov_x' AS prov_id, content FROM {CHUNKS}")
def k1(spark, d):
    return writers.ordered_chunks(chunks(spark, d, "content", "heading"), {"title": "T", "category": "C"}, "prov_x").select("id", "title", "category", "prov_id", "content")


@query("q_k4_k5_vector_sidecar", f"SELECT id, CAST(len(embedding) AS INTEGER) AS dim, CASE WHEN {valid_sql('embedding_summary_chunk')} THEN 1 ELSE 0 END AS with_summary FROM {CHUNKS} WHERE {valid_sql('embedding')}")
def k4(spark, d):
    from quarryloom.functions import vectors as V

    return chunks(spark, d, "embedding", "embedding_summary_chunk").where(V.valid(F.col("embedding"), 48)).select("id", F.size("embedding").alias("dim"), V.valid(F.col("embedding_summary_chunk"), 48).cast("int").alias("with_summary"))


@query("q_k6_constraints", f"SELECT 'unknown provenance' AS problem, id FROM {CHUNKS} WHERE prov_id IS NOT NULL AND prov_id NOT IN (SELECT prov_id FROM provenance)")
def k6(spark, d):
    return writers.constraint_violations(chunks(spark, d, "prov_id"), read_table(spark, d, "provenance").select("prov_id"))


@query("q_k7_upsert", "SELECT id, epoch_us(max(loaded_at)) AS loaded_us FROM chunks WHERE id <> '' GROUP BY id")
def k7(spark, d):
    c = read_table(spark, d, "chunks").select("id", "loaded_at")
    return writers.upsert(writers.upsert(c.limit(0), c, "id", "loaded_at"), c, "id", "loaded_at").select("id", F.unix_micros("loaded_at").alias("loaded_us"))


@query("q_k8_upsert_provenance", "SELECT prov_id, coalesce(try_cast(summary_size AS INTEGER), 0) AS size, coalesce(embed_vectorsize, 1536) AS dim FROM provenance WHERE prov_id IS NOT NULL")
def k8(spark, d):
    p = read_table(spark, d, "provenance").select("prov_id", F.coalesce(F.col("summary_size").cast("string").try_cast("int"), F.lit(0)).alias("size"), F.coalesce("embed_vectorsize", F.lit(1536)).alias("dim"))
    return writers.upsert(p.limit(0), p, "prov_id")


@query("q_k12_r4_pair_export", "SELECT coalesce(lower(trim(difficulty)), '') AS difficulty, coalesce(lower(trim(split)), 'train') AS split, count(*) AS pairs FROM retrieval_pairs GROUP BY ALL")
def k12(spark, d):
    return read_table(spark, d, "retrieval_pairs").groupBy(F.coalesce(F.lower(F.trim("difficulty")), F.lit("")).alias("difficulty"), F.coalesce(F.lower(F.trim("split")), F.lit("train")).alias("split")).agg(F.count(F.lit(1)).alias("pairs"))


@query("q_k15_long_metrics", "SELECT difficulty, metric, value FROM (SELECT difficulty, CAST(count(*) AS DOUBLE) AS pairs, CAST(sum(label) AS DOUBLE) AS positives FROM retrieval_pairs WHERE difficulty IS NOT NULL GROUP BY difficulty) UNPIVOT (value FOR metric IN (pairs, positives))")
def k15(spark, d):
    m = read_table(spark, d, "retrieval_pairs").where(F.col("difficulty").isNotNull()).groupBy("difficulty").agg(F.count(F.lit(1)).alias("pairs"), F.sum("label").alias("positives"))
    return writers.evaluation_long(m)


@query("q_k22_like_count", f"SELECT chunk_type, count(*) AS chunks FROM {CHUNKS} WHERE heading LIKE 'How the %' GROUP BY chunk_type")
def k22(spark, d):
    return chunks(spark, d, "heading", "chunk_type").where(F.col("heading").like("How the %")).groupBy("chunk_type").agg(F.count(F.lit(1)).alias("chunks"))


@query("q_k22_delete_like", f"SELECT chunk_type, count(*) AS chunks FROM {CHUNKS} WHERE NOT coalesce(heading LIKE 'How the %', false) GROUP BY chunk_type")
def k22b(spark, d):
    """What a deletion by pattern leaves."""
    return writers.delete_like(chunks(spark, d, "heading", "chunk_type"), "heading", "How the %").groupBy("chunk_type").agg(F.count(F.lit(1)).alias("chunks"))


@query("q_e2_relative_paths", f"SELECT id, regexp_replace(replace('/data/docs/' || filename, '/sub/', chr(92)), '^/data/docs/', '') AS path FROM {CHUNKS} WHERE filename IS NOT NULL")
def e2(spark, d):
    full = F.replace(F.concat(F.lit("/data/docs/"), "filename"), F.lit("/sub/"), F.lit("\\"))
    return chunks(spark, d, "filename").where("filename IS NOT NULL").select("id", T.relative_path(full, "/data/docs/").alias("path"))


@query("q_u1_q4_summarise", f"SELECT id, CASE WHEN len({tok_sql('content')}) >= 50 THEN regexp_replace({strip_sql('content')}, '([.!?])\\s.*$', '\\1', 's') ELSE '' END AS chunk_summary FROM {CHUNKS}")
def u1(spark, d):
    return summaries.summarise(chunks(spark, d, "content", "chunk_summary"), "extractive", 50).select("id", "chunk_summary")


@query("q_u2_p9_missing_vectors", f"SELECT id, CASE WHEN len({tok_sql('content')}) > 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS norm FROM {CHUNKS} WHERE NOT {valid_sql('embedding')}")
def u2(spark, d):
    """Missing vectors filled by the offline encoder."""
    from quarryloom.functions import vectors as V
    from quarryloom.operators.encoders import encode

    c = chunks(spark, d, "content", "embedding").where(~V.valid(F.col("embedding"), 48)).select("id", F.coalesce("content", F.lit("")).alias("text"))
    return encode(c, "text", "vector", dim=48).select("id", F.round(V.norm(F.col("vector")), 3).alias("norm"))


@query("q_u3_token_counts", f"SELECT id, CAST(len({tok_sql('content')}) AS BIGINT) AS tokens FROM {CHUNKS}")
def u3(spark, d):
    return chunks(spark, d, "content").select("id", T.token_count(F.col("content")).alias("tokens"))


# --- event windows ---------------------------------------------------------------------------------------------------


@query("q_events_tumbling", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS events, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def ev1(spark, d):
    return stream.tumbling(read_table(spark, d, "events")).withColumn("total", F.round("total", 4))


@query("q_events_sliding", "SELECT start, count(*) AS events FROM (SELECT time_bucket(INTERVAL 15 MINUTE, ts) - k * INTERVAL 15 MINUTE AS start FROM events, range(0, 4) r(k)) GROUP BY start")
def ev2(spark, d):
    return stream.sliding(read_table(spark, d, "events"))


@query("q_events_sessions", """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events),
  s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS n FROM g) SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS "end", count(*) AS events FROM s GROUP BY user_id, n""")
def ev3(spark, d):
    return stream.sessions(read_table(spark, d, "events"))


@query("q_events_dedupe", "SELECT count(*) AS events, count(DISTINCT event_id) AS ids FROM (SELECT DISTINCT ON (event_id) * FROM (SELECT * FROM events UNION ALL SELECT * FROM events))")
def ev4(spark, d):
    e = read_table(spark, d, "events")
    return stream.deduplicated(e.unionByName(e)).agg(F.count(F.lit(1)).alias("events"), F.countDistinct("event_id").alias("ids"))
