"""Queries over the filters, text functions and vector functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarryloom.functions import text as T
from quarryloom.functions import vectors as V
from quarryloom.plans.registry import CHUNKS, LABELLED, chunks, labelled, query
from quarryloom.runtime import read_table

_STRIP = "regexp_replace({0}, '^\\s+|\\s+$', '', 'g')"
_SEG = "list_filter(list_transform(string_split(lower(coalesce({0}, '')), ' > '), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '')"


def strip_sql(c: str) -> str:
    return _STRIP.format(c)


def seg_sql(c: str) -> str:
    return _SEG.format(c)


@query("q_f1_same_domain", "SELECT id, crawl_url FROM catalogue WHERE lower(regexp_extract(crawl_url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) = 'docs.velmora.example'")
def f1(spark, d):
    return read_table(spark, d, "catalogue").where(T.url_authority(F.col("crawl_url")) == T.url_authority(F.lit("https://docs.velmora.example/guide"))).select("id", "crawl_url")


@query("q_f2_f3_min_content", "SELECT doc_id, CAST(length(text) AS INTEGER) AS chars, CAST(len(string_split(text, chr(10))) AS INTEGER) AS lines FROM documents WHERE text IS NOT NULL AND length(text) >= 100 AND len(string_split(text, chr(10))) >= 2")
def f3(spark, d):
    docs = read_table(spark, d, "documents").where(F.col("text").isNotNull())
    return docs.select("doc_id", F.length("text").alias("chars"), F.size(F.split("text", "\n")).alias("lines")).where("chars >= 100 and lines >= 2")


@query("q_f4_language", "SELECT doc_id, lang FROM documents WHERE regexp_matches(lower(trim(lang)), '^(en|eng|english)([_-].*)?$')")
def f4(spark, d):
    return read_table(spark, d, "documents").where(F.lower(F.trim("lang")).rlike("^(en|eng|english)([_-].*)?$")).select("doc_id", "lang")


@query("q_f5_url_pattern", "SELECT id, crawl_url FROM catalogue WHERE crawl_url LIKE 'https://docs.%'")
def f5(spark, d):
    return read_table(spark, d, "catalogue").where(F.col("crawl_url").like("https://docs.%")).select("id", "crawl_url")


@query("q_f6_training_gate", f"""SELECT id, CAST(length({strip_sql('content')}) AS INTEGER) AS chars,
  coalesce({strip_sql('chunk_summary')} <> '' AND lower({strip_sql('chunk_summary')}) <> 'false', false) AS has_summary
  FROM {CHUNKS} WHERE length({strip_sql('content')}) BETWEEN 50 AND 5000 AND lower({strip_sql('content')}) NOT IN ('', 'n/a', 'none', 'null')""")
def f6(spark, d):
    body = T.strip(F.col("content"))
    return chunks(spark, d, "content", "chunk_summary").where(F.length(body).between(50, 5000) & ~F.lower(body).isin(*T.PLACEHOLDERS)).select(
        "id", F.length(body).alias("chars"), T.sentinel_to_null(F.col("chunk_summary")).isNotNull().alias("has_summary"))


@query("q_f7_excluded_types", f"SELECT id, chunk_type FROM {CHUNKS} WHERE lower(coalesce(chunk_type, '')) NOT IN ('table')")
def f7(spark, d):
    return chunks(spark, d, "chunk_type").where(~F.lower(F.coalesce("chunk_type", F.lit(""))).isin("table")).select("id", "chunk_type")


@query("q_f8_filter_spec", f"SELECT id FROM {CHUNKS} WHERE contains(lower(coalesce(content, '')), 'fails') AND contains(lower(coalesce(content, '')), 'the') AND (contains(lower(coalesce(content, '')), 'wait') OR contains(lower(coalesce(content, '')), 'retry'))")
def f8(spark, d):
    return chunks(spark, d, "content").where(T.matches_spec(F.col("content"), "Fails", ("the",), ("wait", "retry"))).select("id")


@query("q_f9_field_alias", f"SELECT id, coalesce(concat_header_path, '') AS path, coalesce(filename, '') AS file FROM {CHUNKS}")
def f9(spark, d):
    return chunks(spark, d, "concat_header_path", "filename").select("id", T.field_value("path").alias("path"), T.field_value("file").alias("file"))


@query("q_f10_scope", f"""WITH s AS (SELECT id, parent_id, {seg_sql('concat_header_path')} AS seg FROM {CHUNKS})
  SELECT c.id, p.id AS parent, c.seg[1:least(len(p.seg), 2)] = p.seg[1:least(len(p.seg), 2)] AS shares FROM s c JOIN s p ON c.parent_id = p.id""")
def f10(spark, d):
    c = chunks(spark, d, "parent_id", "concat_header_path").withColumn("seg", T.segments(F.col("concat_header_path")))
    p = c.select(F.col("id").alias("parent"), F.col("seg").alias("pseg"))
    return c.join(p, c["parent_id"] == p["parent"]).select("id", "parent", T.shares_scope(F.col("pseg"), F.col("seg")).alias("shares"))


@query("q_f11_different_leaf", f"""WITH s AS (SELECT id, parent_id, lower(coalesce(nullif(heading, ''), concat_header_path, '')) AS leaf FROM {CHUNKS})
  SELECT c.id, p.id AS parent FROM s c JOIN s p ON c.parent_id = p.id WHERE c.leaf <> '' AND p.leaf <> '' AND c.leaf <> p.leaf""")
def f11(spark, d):
    c = chunks(spark, d, "parent_id", "heading", "concat_header_path").withColumn("leaf", F.lower(F.coalesce(F.nullif("heading", F.lit("")), "concat_header_path", F.lit(""))))
    p = c.select(F.col("id").alias("parent"), F.col("leaf").alias("pleaf"))
    return c.join(p, c["parent_id"] == p["parent"]).where("leaf <> '' and pleaf <> '' and leaf <> pleaf").select("id", "parent")


_UNIT = "len(v) = 48 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0"


def valid_sql(c: str) -> str:
    return f"coalesce(len({c}) = 48 AND len(list_filter({c}, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter({c}, lambda x: x <> 0)) > 0, false)"


@query("q_f12_cosine_gate", f"""WITH v AS (SELECT id, parent_id, embedding FROM {CHUNKS} WHERE {valid_sql('embedding')}),
  s AS (SELECT c.id, p.id AS parent, list_cosine_similarity(CAST(c.embedding AS DOUBLE[]), CAST(p.embedding AS DOUBLE[])) AS cos FROM v c JOIN v p ON c.parent_id = p.id)
  SELECT id, parent, round(cos, 6) AS cosine, cos <= 0.65 AS easy, cos BETWEEN 0 AND 1 AS medium FROM s""")
def f12(spark, d):
    c = chunks(spark, d, "parent_id", "embedding").where(V.valid(F.col("embedding"), 48))
    p = c.select(F.col("id").alias("parent"), F.col("embedding").alias("pv"))
    cos = V.cosine(F.col("embedding"), F.col("pv"))
    return c.join(p, c["parent_id"] == p["parent"]).select("id", "parent", cos.alias("cos")).select(
        "id", "parent", F.round("cos", 6).alias("cosine"), (F.col("cos") <= 0.65).alias("easy"), F.col("cos").between(0.0, 1.0).alias("medium"))


@query("q_f13_table_cap", f"""SELECT id, top FROM (SELECT id, coalesce({seg_sql('concat_header_path')}[1], '') AS top,
  row_number() OVER (PARTITION BY coalesce({seg_sql('concat_header_path')}[1], '') ORDER BY md5('0:' || id), id) AS rn FROM {CHUNKS} WHERE chunk_type = 'table') WHERE rn <= 3""")
def f13(spark, d):
    from quarryloom.operators.ranking import first_per_group

    t = chunks(spark, d, "chunk_type", "concat_header_path").where("chunk_type = 'table'").select(
        "id", F.coalesce(F.try_element_at(T.segments(F.col("concat_header_path")), F.lit(1)), F.lit("")).alias("top"), F.md5(F.concat(F.lit("0:"), "id")).alias("h"))
    return first_per_group(t, ["top"], ["h", "id"], 3).select("id", "top")


@query("q_f14_summary_gate", f"SELECT id, CASE WHEN len(string_split_regex(coalesce(content, ''), '\\s+')) < 50 THEN 'skip' WHEN len(string_split_regex(coalesce(content, ''), '\\s+')) < 150 THEN 'pad' ELSE 'summarise' END AS action FROM {CHUNKS}")
def f14(spark, d):
    n = F.size(F.split(F.coalesce("content", F.lit("")), r"\s+"))
    return chunks(spark, d, "content").select("id", F.when(n < 50, "skip").when(n < 150, "pad").otherwise("summarise").alias("action"))


@query("q_f15_valid_ids", "SELECT count(*) AS rows, count(nullif(id, '')) AS valid, count(DISTINCT nullif(id, '')) AS distinct_ids FROM chunks")
def f15(spark, d):
    i = F.nullif("id", F.lit(""))
    return read_table(spark, d, "chunks").agg(F.count(F.lit(1)).alias("rows"), F.count(i).alias("valid"), F.countDistinct(i).alias("distinct_ids"))


@query("q_f16_vector_validity", f"SELECT id, {valid_sql('embedding')} AS content_ok, {valid_sql('embedding_summary_chunk')} AS chunk_ok, {valid_sql('embedding_summary_page')} AS page_ok FROM {CHUNKS}")
def f16(spark, d):
    names = {"content_ok": "embedding", "chunk_ok": "embedding_summary_chunk", "page_ok": "embedding_summary_page"}
    return chunks(spark, d, *names.values()).select("id", *[V.valid(F.col(c), 48).alias(a) for a, c in names.items()])


@query("q_f17_query_filter", f"SELECT query_id, lower(trim(split)) AS split, lower(trim(difficulty)) AS difficulty FROM {LABELLED} WHERE lower(trim(split)) IN ('train', 'test') AND lower(trim(difficulty)) IN ('hard', 'medium')")
def f17(spark, d):
    return labelled(spark, d, "text", "split", "difficulty").select("query_id", F.lower(F.trim("split")).alias("split"), F.lower(F.trim("difficulty")).alias("difficulty")).where(
        F.col("split").isin("train", "test") & F.col("difficulty").isin("hard", "medium"))


@query("q_f18_evaluable_summaries", f"SELECT id FROM {CHUNKS} WHERE coalesce(chunk_summary, '') NOT IN ('', 'false') AND coalesce(content, '') <> '' AND NOT (starts_with(chunk_summary, '[') AND contains(chunk_summary, 'ERROR'))")
def f18(spark, d):
    s = F.col("chunk_summary")
    return chunks(spark, d, "chunk_summary", "content").where(~F.coalesce(s, F.lit("")).isin("", "false") & (F.coalesce("content", F.lit("")) != "") & ~(s.startswith("[") & s.contains("ERROR"))).select("id")


@query("q_f19_path_search", f"SELECT DISTINCT filename FROM {CHUNKS} WHERE NOT contains(filename, 'zimbrane/') AND (contains(filename, 'trace') OR contains(filename, 'quota'))")
def f19(spark, d):
    keep = ~F.exists(F.array(F.lit("zimbrane/")), lambda m: F.col("filename").contains(m)) & F.exists(F.array(F.lit("trace"), F.lit("quota")), lambda t: F.col("filename").contains(t))
    return chunks(spark, d, "filename").where(keep).select("filename").distinct()


@query("q_f20_min_tokens", f"SELECT id, CAST(len(list_filter(string_split_regex(lower(coalesce(content, '')), '\\s+'), lambda x: x <> '')) AS BIGINT) AS tokens FROM {CHUNKS} WHERE len(list_filter(string_split_regex(lower(coalesce(content, '')), '\\s+'), lambda x: x <> '')) >= 100")
def f20(spark, d):
    return chunks(spark, d, "content").select("id", T.token_count(F.col("content")).alias("tokens")).where("tokens >= 100")


@query("q_m14_url_slug", "SELECT id, coalesce(nullif(regexp_replace(regexp_extract(regexp_replace(regexp_replace(crawl_url, '[?#].*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/]*', ''), '([^/]+)/*$', 1), '\\.[^.]*$', ''), ''), 'index') AS slug FROM catalogue")
def m14(spark, d):
    return read_table(spark, d, "catalogue").select("id", T.url_slug(F.col("crawl_url")).alias("slug"))


@query("q_m15_repo_url", "SELECT id, p[1] AS owner, regexp_replace(p[2], '\\.git$', '') AS repo, CASE WHEN p[3] = 'tree' THEN p[4] ELSE 'main' END AS branch, CASE WHEN p[3] = 'tree' THEN array_to_string(p[5:], '/') ELSE '' END AS subpath FROM (SELECT id, list_filter(string_split(regexp_replace('https://code.example/' || base_dir || '/docs/tree/v2/en/' || base_dir, '^[a-z]+://[^/]*/?', ''), '/'), lambda x: x <> '') AS p FROM catalogue)")
def m15(spark, d):
    url = F.concat(F.lit("https://code.example/"), "base_dir", F.lit("/docs/tree/v2/en/"), "base_dir")
    return read_table(spark, d, "catalogue").select("id", T.repo_parts(url).alias("p")).select("id", "p.*")


@query("q_m19_heading_numbers", f"SELECT id, regexp_replace('3.2 ' || coalesce(heading, ''), '^\\s*(?:(?:\\d+(?:\\.\\d+)*|[IVXLC]+|[A-Za-z])[.)]\\s+|\\d+(?:\\.\\d+)+\\s+|\\d+\\s+)', '') AS heading FROM {CHUNKS}")
def m19(spark, d):
    return chunks(spark, d, "heading").select("id", T.strip_numbering(F.concat(F.lit("3.2 "), F.coalesce("heading", F.lit("")))).alias("heading"))


@query("q_m21_m22_kind_and_id", f"""SELECT id, kind, 'h' || header_level || '_' || substr(md5(concat_ws(':', filename, pos)), 1, 8) || CASE kind WHEN 'example' THEN '_exa' WHEN 'table' THEN '_tab' ELSE '' END AS new_id
  FROM (SELECT id, header_level, filename, pos, CASE WHEN starts_with(ltrim(content), '```') THEN 'example' WHEN starts_with(ltrim(content), '<!-- Data Table -->') THEN 'table' ELSE 'heading' END AS kind FROM {CHUNKS})""")
def m22(spark, d):
    c = chunks(spark, d, "header_level", "filename", "pos", "content").withColumn("kind", T.chunk_kind(F.lit(None).cast("string"), F.col("content")))
    return c.select("id", "kind", T.chunk_id(F.col("header_level"), F.col("filename"), F.col("pos"), F.col("kind")).alias("new_id"))


_SUM = f"CASE WHEN {strip_sql('chunk_summary')} <> '' AND lower({strip_sql('chunk_summary')}) <> 'false' THEN chunk_summary END"


@query("q_m23_m24_embedding_text", f"""SELECT id, 'Represent this passage' || chr(10) || CASE WHEN length({strip_sql(_SUM)}) > 20 THEN concat_ws(': ', concat_header_path, {_SUM})
  WHEN length({strip_sql("coalesce(content, '')")}) > 100 THEN concat_ws(': ', concat_header_path, content) ELSE coalesce(content, '') END AS input FROM {CHUNKS}""")
def m23(spark, d):
    c = chunks(spark, d, "concat_header_path", "chunk_summary", "content")
    return c.select("id", F.concat(F.lit("Represent this passage\n"), T.embedding_text(F.col("concat_header_path"), F.col("chunk_summary"), F.col("content"))).alias("input"))


@query("q_m25_m26_prefixes", f"""SELECT id, CASE WHEN len(list_filter(string_split_regex(c2, '\\s+'), lambda x: x <> '')) < 50 AND NOT starts_with(c2, 'Path: ' || coalesce(concat_header_path, '')) THEN 'Path: ' || coalesce(concat_header_path, '') || chr(13) || chr(10) || c2 ELSE c2 END AS content
  FROM (SELECT *, CASE WHEN chunk_type = 'table' AND s IS NOT NULL AND NOT starts_with(ltrim(c), s) THEN s || chr(10) || c ELSE c END AS c2 FROM (SELECT id, chunk_type, concat_header_path, coalesce(content, '') AS c, {_SUM} AS s FROM {CHUNKS}))""")
def m25(spark, d):
    from quarryloom.operators.summaries import with_metadata_prefix, with_table_summary

    c = chunks(spark, d, "chunk_type", "concat_header_path", "chunk_summary", "content")
    return with_metadata_prefix(with_table_summary(c), max_tokens=50).select("id", "content")


@query("q_m27_m30_labels", f"""SELECT id, lower(coalesce(nullif({strip_sql('category')}, ''), 'unknown')) AS category, coalesce({seg_sql('concat_header_path')}[1], lower(nullif({strip_sql('heading')}, '')), '') AS top,
  {seg_sql('concat_header_path')} AS segments, CASE WHEN length(coalesce(content, '')) < 200 THEN 'short' WHEN length(coalesce(content, '')) < 800 THEN 'medium' ELSE 'long' END AS bucket FROM {CHUNKS}""")
def m27(spark, d):
    return chunks(spark, d, "category", "concat_header_path", "heading", "content").select(
        "id", T.category(F.col("category")).alias("category"), T.top_heading(F.col("concat_header_path"), F.col("heading")).alias("top"),
        T.segments(F.col("concat_header_path")).alias("segments"), T.length_bucket(F.length(F.coalesce("content", F.lit("")))).alias("bucket"))


@query("q_m31_m32_formats", "SELECT o_orderkey, CASE WHEN n >= 1024.0*1024 THEN format('{:.1f} MB', n / 1048576.0) WHEN n >= 1024 THEN format('{:.1f} KB', n / 1024.0) ELSE n || ' B' END AS size, printf('%.4f', CAST(o_orderkey AS DOUBLE)) AS value FROM (SELECT o_orderkey, CAST(o_orderkey AS BIGINT) * 74 + 5 AS n FROM orders)")
def m31(spark, d):
    n = F.col("o_orderkey").cast("bigint") * 74 + 5
    return read_table(spark, d, "orders").select("o_orderkey", T.human_size(n).alias("size"), T.format_value(F.col("o_orderkey")).alias("value"))


@query("q_m33_tokenise", f"SELECT id, list_filter(string_split_regex(lower(coalesce(heading, '')), '\\s+'), lambda x: x <> '') AS tokens FROM {CHUNKS}")
def m33(spark, d):
    return chunks(spark, d, "heading").select("id", T.tokens(F.col("heading")).alias("tokens"))


@query("q_m34_m35_model_prompt", "SELECT prov_id, CASE WHEN instr(m, ':') > 0 THEN split_part(m, ':', 1) ELSE 'openai' END AS backend, CASE WHEN instr(m, ':') > 0 THEN substr(m, instr(m, ':') + 1) ELSE m END AS model, 'Summarise ' || coalesce(summary_prompt, '') || ' in ' || coalesce(CAST(summary_size AS VARCHAR), '') || ' words' AS prompt FROM (SELECT *, 'local:' || embed_model AS m FROM provenance)")
def m34(spark, d):
    p = read_table(spark, d, "provenance").withColumn("m", T.model_parts(F.concat(F.lit("local:"), "embed_model")))
    return p.select("prov_id", "m.backend", "m.model", T.fill_template("Summarise {heading} in {size} words", heading=F.col("summary_prompt"), size=F.col("summary_size")).alias("prompt"))


@query("q_m36_m37_headers_tags", f"SELECT id, {strip_sql('regexp_replace(regexp_replace(heading, chr(92) || chr(92) || chr(95), chr(95), chr(103)), chr(92) || chr(115) || chr(43), chr(32), chr(103))')} AS header, CASE lower(trim(language)) WHEN 'py' THEN 'python' WHEN 'js' THEN 'javascript' WHEN 'sh' THEN 'bash' WHEN 'shell' THEN 'bash' ELSE lower(trim(language)) END AS tag FROM {CHUNKS}")
def m36(spark, d):
    return chunks(spark, d, "heading", "language").select("id", T.normalise_header(F.col("heading")).alias("header"), T.fence_language(F.col("language")).alias("tag"))


@query("q_v1_v3_v5_vectors", f"""WITH v AS (SELECT id, CAST(embedding AS DOUBLE[]) AS v FROM {CHUNKS} WHERE {valid_sql('embedding')})
  SELECT id, round(sqrt(list_sum(list_transform(v, lambda x: x * x))), 6) AS norm, round(list_cosine_similarity(v, list_reverse(v)), 6) AS self_cosine FROM v""")
def v1(spark, d):
    c = chunks(spark, d, "embedding").where(V.valid(F.col("embedding"), 48))
    return c.select("id", F.round(V.norm(F.col("embedding")), 6).alias("norm"), F.round(V.cosine(V.unit(F.col("embedding")), F.reverse("embedding")), 6).alias("self_cosine"))


@query("q_v4_parse_vectors", "SELECT vec_id, CAST(len(embedding) AS INTEGER) AS dim, true AS ok FROM embeddings")
def v4(spark, d):
    text = F.concat(F.lit("["), F.array_join(F.transform("embedding", lambda x: x.cast("string")), ", "), F.lit("]"))
    v = V.parse(text)
    return read_table(spark, d, "embeddings").select("vec_id", F.size(v).alias("dim"), v.isNotNull().alias("ok"))


@query("q_v6_bucket_size", f"SELECT id, CASE WHEN n <= 16 THEN 16 WHEN n <= 32 THEN 32 WHEN n <= 48 THEN 48 WHEN n <= 64 THEN 64 WHEN n <= 84 THEN 84 ELSE CAST(ceil(n / 8.0) * 8 AS BIGINT) END AS bucket FROM (SELECT id, len(list_filter(string_split_regex(lower(coalesce(content, '')), '\\s+'), lambda x: x <> '')) AS n FROM {CHUNKS})")
def v6(spark, d):
    return chunks(spark, d, "content").select("id", V.bucket_size(T.token_count(F.col("content"))).alias("bucket"))


@query("q_v9_fusion", "SELECT query_id, rank, round((0.35 * coalesce(scores.lexical, 0) + 0.65 * scores.dense) / (0.35 + 0.65), 6) AS fused FROM retrieval_pairs")
def v9(spark, d):
    return read_table(spark, d, "retrieval_pairs").select("query_id", "rank", F.round(V.fuse(F.col("scores.dense"), F.coalesce("scores.lexical", F.lit(0.0))), 6).alias("fused"))


@query("q_v10_margin_loss", """WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)
  SELECT a.vec_id, round(greatest(0, list_distance(a.v, p.v) - list_distance(a.v, n.v) + 1), 6) AS loss FROM e a JOIN e p ON p.vec_id = a.vec_id + 1 JOIN e n ON n.vec_id = a.vec_id + 2""")
def v10(spark, d):
    e = read_table(spark, d, "embeddings").select("vec_id", "embedding")
    p = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("p"))
    n = e.select((F.col("vec_id") - 2).alias("vec_id"), F.col("embedding").alias("n"))
    return e.join(p, "vec_id").join(n, "vec_id").select("vec_id", F.round(V.margin_loss(F.col("embedding"), F.col("p"), F.col("n")), 6).alias("loss"))


@query("q_n1_prov_ids", "SELECT prov_id, strftime(created_date, 'prov_%m_%d_%y') AS stamped FROM provenance")
def n1(spark, d):
    return read_table(spark, d, "provenance").select("prov_id", F.concat(F.lit("prov_"), F.date_format("created_date", "MM_dd_yy")).alias("stamped"))


@query("q_n2_n3_json", f"SELECT id, CASE WHEN examples IS NULL THEN NULL ELSE '[' || array_to_string(list_transform(examples, lambda x: '\"' || x || '\"'), ',') || ']' END AS examples FROM {CHUNKS}")
def n2(spark, d):
    return chunks(spark, d, "examples").select("id", F.to_json("examples").alias("examples"))


@query("q_n4_n5_maps", "SELECT id, len(list_filter([metadata_author, tags, pages], lambda x: x IS NOT NULL)) AS extras FROM catalogue")
def n4(spark, d):
    m = F.map_concat(F.create_map(F.lit("author"), "metadata_author"), F.create_map(F.lit("tags"), "tags", F.lit("pages"), "pages"))
    return read_table(spark, d, "catalogue").select("id", F.size(F.map_filter(m, lambda k, v: v.isNotNull() & ~k.isin("id"))).cast("bigint").alias("extras"))


@query("q_n6_casts", "SELECT id, try_cast(pages AS INTEGER) AS pages, try_cast(id AS INTEGER) AS number FROM catalogue")
def n6(spark, d):
    return read_table(spark, d, "catalogue").select("id", F.col("pages").try_cast("int").alias("pages"), F.col("id").try_cast("int").alias("number"))


@query("q_n8_nested_keys", "SELECT query_id, rank, scores.dense AS dense, scores.combined AS combined FROM retrieval_pairs")
def n8(spark, d):
    return read_table(spark, d, "retrieval_pairs").select("query_id", "rank", "scores.dense", "scores.combined")
