"""Queries over joins, aggregates, windows, sorts, sets, retrieval and mining."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarryloom.functions import text as T
from quarryloom.functions import vectors as V
from quarryloom.operators import mining, ranking, retrieval
from quarryloom.plans.registry import CHUNKS, LABELLED, chunks, labelled, query
from quarryloom.plans.scalar_queries import seg_sql, strip_sql, valid_sql
from quarryloom.runtime import read_table

_TOK = "list_filter(string_split_regex(lower(coalesce({0}, '')), '\\s+'), lambda x: x <> '')"


def tok_sql(c: str) -> str:
    return _TOK.format(c)


_CATEGORY = f"lower(coalesce(nullif({strip_sql('category')}, ''), 'unknown'))"


# --- joins -----------------------------------------------------------------------------------------------------------


@query("q_j1_a7_embedding_join", f"""SELECT coalesce(p.embed_model, 'none') AS model, count(*) AS chunks, count(*) FILTER ({valid_sql('c.embedding')}) AS embedded
  FROM {CHUNKS} c LEFT JOIN provenance p USING (prov_id) GROUP BY ALL""")
def j1(spark, d):
    c = chunks(spark, d, "prov_id", "embedding").select("prov_id", V.valid(F.col("embedding"), 48).alias("ok"))
    p = read_table(spark, d, "provenance").select("prov_id", "embed_model")
    return c.join(p, "prov_id", "left").groupBy(F.coalesce("embed_model", F.lit("none")).alias("model")).agg(F.count(F.lit(1)).alias("chunks"), F.count_if("ok").alias("embedded"))


@query("q_j2_parent_child", f"SELECT p.id AS anchor, c.id AS positive, 'parent_child' AS pair_type FROM {CHUNKS} c JOIN {CHUNKS} p ON c.parent_id = p.id")
def j2(spark, d):
    return mining.parent_child(chunks(spark, d, "parent_id"))


def _within(key: str, k: int, kind: str) -> str:
    return f"""WITH r AS (SELECT id, key, row_number() OVER (PARTITION BY key ORDER BY pos, id) AS rn FROM (SELECT id, pos, {key} AS key FROM {CHUNKS}) WHERE key <> '')
  SELECT a.id AS anchor, b.id AS positive, '{kind}' AS pair_type FROM r a JOIN r b ON a.key = b.key AND a.rn < b.rn WHERE b.rn <= {k}"""


@query("q_j3_sibling_pairs", _within("concat_header_path", 5, "sibling"))
def j3(spark, d):
    return mining.pairs_within(chunks(spark, d, "pos", "concat_header_path"), F.col("concat_header_path"), 5, "sibling")


@query("q_j3_section_pairs", _within(f"CASE WHEN len({seg_sql('concat_header_path')}) >= 2 THEN array_to_string({seg_sql('concat_header_path')}[1:2], '/') END", 4, "section"))
def j3b(spark, d):
    seg = T.segments(F.col("concat_header_path"))
    return mining.pairs_within(chunks(spark, d, "pos", "concat_header_path"), F.when(F.size(seg) >= 2, F.array_join(F.slice(seg, 1, 2), "/")), 4, "section")


@query("q_j6_dense_topk", """WITH q AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id % 20 = 0), e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
  s AS (SELECT q.vec_id AS query, e.vec_id AS doc, round(list_cosine_similarity(q.v, e.v), 6) AS score FROM q, e WHERE q.vec_id <> e.vec_id)
  SELECT query, doc, score, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc) AS rank FROM s) WHERE rank <= 10""")
def j6(spark, d):
    e = read_table(spark, d, "embeddings").select("vec_id", "embedding")
    return retrieval.dense_top_k(e.where("vec_id % 20 = 0"), e, "vec_id", "embedding", "vec_id", "embedding", 10)


@query("q_j7_r4_labels", f"""WITH p AS (SELECT DISTINCT query_id, lower(trim(u.p)) AS p FROM {LABELLED} q, unnest(q.positives) AS u(p))
  SELECT r.query_id AS query, r.candidate_id AS doc, CAST(r.rank AS INTEGER) AS rank, CASE WHEN p.p IS NULL THEN 0 ELSE 1 END AS label FROM retrieval_pairs r LEFT JOIN p ON p.query_id = r.query_id AND p.p = lower(trim(r.candidate_id))""")
def j7(spark, d):
    r = read_table(spark, d, "retrieval_pairs").select(F.col("query_id").alias("query"), F.col("candidate_id").alias("doc"), "rank")
    return retrieval.label_candidates(r, labelled(spark, d, "text", "positives").select(F.col("query_id").alias("query"), "positives"))


@query("q_j8_r7_ground_truth", f"""WITH f AS (SELECT query_id, u.f.field AS field, u.f.contains AS needle, coalesce(u.f.max_matches, 5) AS k, u.i AS i FROM (SELECT query_id, unnest(positive_filters) AS f, generate_subscripts(positive_filters, 1) AS i FROM {LABELLED}) u),
  c AS (SELECT id, pos, coalesce(content, '') AS content, coalesce(heading, '') AS heading, coalesce(concat_header_path, '') AS path, coalesce(category, '') AS category, coalesce(title, '') AS title, coalesce(chunk_summary, '') AS summary, coalesce(filename, '') AS filename FROM {CHUNKS}),
  m AS (SELECT f.query_id, f.i, c.id, row_number() OVER (PARTITION BY f.query_id, f.i ORDER BY c.pos, c.id) AS rn, f.k FROM f JOIN c ON contains(lower(CASE f.field WHEN 'content' THEN c.content WHEN 'heading' THEN c.heading WHEN 'concat_header_path' THEN c.path WHEN 'path' THEN c.path WHEN 'header_path' THEN c.path WHEN 'category' THEN c.category WHEN 'title' THEN c.title WHEN 'chunk_summary' THEN c.summary WHEN 'summary' THEN c.summary WHEN 'filename' THEN c.filename WHEN 'file' THEN c.filename ELSE '' END), lower(f.needle)) WHERE trim(coalesce(f.needle, '')) <> '')
  SELECT DISTINCT query_id, lower(trim(id)) AS positive FROM (SELECT query_id, id FROM m WHERE rn <= k UNION ALL SELECT query_id, u.p AS id FROM {LABELLED} q, unnest(q.positives) AS u(p)) WHERE trim(coalesce(id, '')) <> ''""")
def j8(spark, d):
    from quarryloom.operators.ground_truth import ground_truth

    c = chunks(spark, d, "pos", "content", "heading", "concat_header_path", "category", "title", "chunk_summary", "filename")
    return ground_truth(labelled(spark, d, "text", "positives", "positive_filters"), c)


@query("q_j9_three_way_preview", f"SELECT c.id, p.chunk_model, p.embed_vectorsize, list_transform(c.embedding[1:5], lambda x: round(CAST(x AS DOUBLE), 6)) AS head FROM {CHUNKS} c JOIN provenance p USING (prov_id) WHERE c.embedding IS NOT NULL")
def j9(spark, d):
    p = read_table(spark, d, "provenance").select("prov_id", "chunk_model", "embed_vectorsize")
    return chunks(spark, d, "prov_id", "embedding").where(F.col("embedding").isNotNull()).join(p, "prov_id").select(
        "id", "chunk_model", "embed_vectorsize", F.transform(F.slice("embedding", 1, 5), lambda x: F.round(x.cast("double"), 6)).alias("head"))


@query("q_j10_j12_context", f"SELECT r.query_id, r.rank, q.text AS query, c.heading, c.concat_header_path AS path FROM retrieval_pairs r JOIN {LABELLED} q USING (query_id) LEFT JOIN {CHUNKS} c ON lower(c.id) = lower(trim(r.candidate_id)) WHERE r.rank = 1")
def j12(spark, d):
    r = read_table(spark, d, "retrieval_pairs").where("rank = 1").select("query_id", "rank", F.lower(F.trim("candidate_id")).alias("key"))
    c = chunks(spark, d, "heading", "concat_header_path").select(F.lower("id").alias("key"), "heading", F.col("concat_header_path").alias("path"))
    return r.join(labelled(spark, d, "text").select("query_id", F.col("text").alias("query")), "query_id").join(c, "key", "left").select("query_id", "rank", "query", "heading", "path")


@query("q_j11_distinct_texts", f"SELECT query_id, md5(text) AS code FROM {LABELLED} WHERE text IS NOT NULL")
def j11(spark, d):
    """Distinct texts are encoded once and joined back."""
    q = labelled(spark, d, "text").where(F.col("text").isNotNull())
    return q.join(q.select("text").distinct().withColumn("code", F.md5("text")), "text").select("query_id", "code")


# --- aggregates ------------------------------------------------------------------------------------------------------

_CAT = f"lower(coalesce(nullif({strip_sql('category')}, ''), 'unknown'))"
_BUCKET = "CASE WHEN length(coalesce(content, '')) < 200 THEN 'short' WHEN length(coalesce(content, '')) < 800 THEN 'medium' ELSE 'long' END"


@query("q_a1_domain_groups", f"SELECT category, bucket, count(*) AS chunks FROM (SELECT {_CAT} AS category, {_BUCKET} AS bucket FROM {CHUNKS}) GROUP BY GROUPING SETS ((category), (category, bucket)) HAVING count(*) >= 2")
def a1(spark, d):
    c = chunks(spark, d, "category", "content").select(T.category(F.col("category")).alias("category"), T.length_bucket(F.length(F.coalesce("content", F.lit("")))).alias("bucket"))
    return c.groupingSets([["category"], ["category", "bucket"]], "category", "bucket").agg(F.count(F.lit(1)).alias("chunks")).where("chunks >= 2")


@query("q_a2_a3_level_stats", f"SELECT header_level, count(*) AS sections, CAST(sum(n) AS BIGINT) AS tokens, round(avg(n), 6) AS mean, min(n) AS least, max(n) AS most FROM (SELECT header_level, len({tok_sql('content')}) AS n FROM {CHUNKS}) GROUP BY ROLLUP (header_level)")
def a2(spark, d):
    c = chunks(spark, d, "header_level", "content").select("header_level", T.token_count(F.col("content")).alias("n"))
    return c.rollup("header_level").agg(F.count(F.lit(1)).alias("sections"), F.sum("n").alias("tokens"), F.round(F.avg("n"), 6).alias("mean"), F.min("n").alias("least"), F.max("n").alias("most"))


_BM25 = f"""WITH d AS (SELECT doc_id AS doc, {tok_sql('text')} AS toks FROM documents), s AS (SELECT count(*) AS n, avg(len(toks)) AS avgdl FROM d),
  t AS (SELECT doc, term, count(*) AS tf, any_value(dl) AS dl FROM (SELECT doc, len(toks) AS dl, unnest(toks) AS term FROM d) GROUP BY doc, term),
  q AS (SELECT query, term, count(*) AS qf FROM (SELECT item_id AS query, unnest({tok_sql('text')}) AS term FROM eval_items) GROUP BY query, term),
  f AS (SELECT term, count(*) AS df FROM t GROUP BY term),
  r AS (SELECT q.query, t.doc, round(sum(q.qf * ln(1 + (s.n - f.df + 0.5) / (f.df + 0.5)) * t.tf * 2.5 / (t.tf + 1.5 * (0.25 + 0.75 * t.dl / s.avgdl))), 6) AS score FROM q JOIN t USING (term) JOIN f USING (term), s GROUP BY q.query, t.doc)
  SELECT query, doc, score, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc) AS rank FROM r) WHERE rank <= 10"""


@query("q_r1_a5_a6_bm25_topk", _BM25)
def bm25_topk(spark, d):
    return retrieval.bm25_top_k(read_table(spark, d, "eval_items"), read_table(spark, d, "documents"), "item_id", "text", "doc_id", "text", 10)


@query("q_a8_similarity_summary", "SELECT difficulty, count(dense) AS n, round(avg(dense), 6) AS mean, round(median(dense), 6) AS median, min(dense) AS least, max(dense) AS most, round(stddev_pop(dense), 6) AS spread FROM (SELECT lower(trim(difficulty)) AS difficulty, scores.dense AS dense FROM retrieval_pairs) GROUP BY difficulty")
def a8(spark, d):
    r = read_table(spark, d, "retrieval_pairs").select(F.lower(F.trim("difficulty")).alias("difficulty"), F.col("scores.dense").alias("dense"))
    from quarryloom.operators.statistics import quantiles

    per = r.groupBy("difficulty").agg(F.count("dense").alias("n"), F.round(F.avg("dense"), 6).alias("mean"), F.min("dense").alias("least"), F.max("dense").alias("most"), F.round(F.stddev_pop("dense"), 6).alias("spread"))
    middle = quantiles(r, ["difficulty"], "dense", {"median": 0.5}).withColumnRenamed("difficulty", "d")
    return per.join(middle, F.col("difficulty").eqNullSafe(F.col("d"))).drop("d").withColumn("median", F.round("median", 6))


@query("q_a9_vector_stats", f"""SELECT (SELECT count(*) FROM {CHUNKS} WHERE {valid_sql('embedding')}) AS vectors, round(min(x), 6) AS least, round(max(x), 6) AS most, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS spread, count(*) FILTER (x = 0) AS zeros
  FROM (SELECT CAST(unnest(embedding) AS DOUBLE) AS x FROM {CHUNKS} WHERE {valid_sql('embedding')})""")
def a9(spark, d):
    c = chunks(spark, d, "embedding").where(V.valid(F.col("embedding"), 48))
    x = c.select("id", F.posexplode("embedding").alias("i", "x")).withColumn("x", F.col("x").cast("double"))
    return x.agg(F.count_if(F.col("i") == 0).alias("vectors"), F.round(F.min("x"), 6).alias("least"), F.round(F.max("x"), 6).alias("most"), F.round(F.avg("x"), 6).alias("mean"), F.round(F.stddev_pop("x"), 6).alias("spread"), F.count_if(F.col("x") == 0).alias("zeros"))


@query("q_a10_triplet_eval", """WITH g AS (SELECT query_id, any_value(lower(trim(difficulty))) AS difficulty, max(scores.dense) FILTER (label = 1) AS pos, max(scores.dense) FILTER (label = 0) AS neg FROM retrieval_pairs GROUP BY query_id)
  SELECT difficulty, count(*) AS triplets, round(avg(CASE WHEN pos > neg THEN 1.0 ELSE 0.0 END), 6) AS accuracy, round(avg(pos), 6) AS pos, round(avg(neg), 6) AS neg, round(avg(pos - neg), 6) AS margin FROM g WHERE pos IS NOT NULL AND neg IS NOT NULL GROUP BY difficulty""")
def a10(spark, d):
    dense = F.col("scores.dense")
    g = read_table(spark, d, "retrieval_pairs").groupBy("query_id").agg(F.first(F.lower(F.trim("difficulty")), ignorenulls=True).alias("difficulty"), F.max(F.when(F.col("label") == 1, dense)).alias("pos"), F.max(F.when(F.col("label") == 0, dense)).alias("neg"))
    g = g.where(F.col("pos").isNotNull() & F.col("neg").isNotNull())
    return g.groupBy("difficulty").agg(F.count(F.lit(1)).alias("triplets"), F.round(F.avg((F.col("pos") > F.col("neg")).cast("double")), 6).alias("accuracy"), F.round(F.avg("pos"), 6).alias("pos"), F.round(F.avg("neg"), 6).alias("neg"), F.round(F.avg(F.col("pos") - F.col("neg")), 6).alias("margin"))


def _metrics_sql(score: str) -> str:
    per = ", ".join(f"sum(CASE WHEN r <= {k} THEN label ELSE 0 END) AS h{k}, sum(CASE WHEN r <= {k} THEN label / log2(r + 1.0) ELSE 0 END) AS d{k}, sum(CASE WHEN ideal <= {k} THEN label / log2(ideal + 1.0) ELSE 0 END) AS i{k}" for k in (5, 10, 20))
    out = ", ".join(f"round(avg(h{k} / npos), 6) AS recall_{k}, round(avg(coalesce(d{k} / nullif(i{k}, 0), 0)), 6) AS ndcg_{k}" for k in (5, 10, 20))
    return f"""WITH b AS (SELECT lower(trim(difficulty)) AS difficulty, query_id, candidate_id, CAST(label AS INTEGER) AS label, coalesce({score}, CAST('-infinity' AS DOUBLE)) AS s FROM retrieval_pairs),
  k AS (SELECT *, row_number() OVER (PARTITION BY difficulty, query_id ORDER BY s DESC, candidate_id) AS r, row_number() OVER (PARTITION BY difficulty, query_id ORDER BY label DESC, candidate_id) AS ideal FROM b),
  p AS (SELECT difficulty, query_id, count(*) AS pairs, sum(label) AS npos, max(s) FILTER (label > 0) AS best, max(s) FILTER (label <= 0) AS worst, min(r) FILTER (label > 0) AS first, {per} FROM k GROUP BY difficulty, query_id)
  SELECT difficulty, count(*) AS queries, CAST(sum(pairs) AS BIGINT) AS pairs, round(avg(CASE WHEN first = 1 THEN 1.0 ELSE 0.0 END), 6) AS top1, round(avg(CASE WHEN best > worst THEN 1.0 ELSE 0.0 END), 6) AS pair_accuracy, round(avg(1.0 / first), 6) AS mrr, {out}
  FROM p WHERE npos > 0 AND pairs > npos GROUP BY difficulty"""


def _metrics(spark, d, score):
    r = read_table(spark, d, "retrieval_pairs").select(F.lower(F.trim("difficulty")).alias("difficulty"), "query_id", "candidate_id", "label", F.col(score).alias("s"))
    m = retrieval.ranking_metrics(r, "s")
    return m.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in m.dtypes])


@query("q_r10_v7_metrics", _metrics_sql("scores.combined"))
def r10(spark, d):
    return _metrics(spark, d, "scores.combined")


@query("q_r11_a13_compare", f"""WITH a AS ({_metrics_sql('scores.dense')}), b AS ({_metrics_sql('scores.lexical')})
  SELECT round(avg(a.mrr), 6) AS dense_mrr, round(avg(b.mrr), 6) AS lexical_mrr, round(avg(b.mrr - a.mrr), 6) AS gain, CAST(sum(a.pairs) AS BIGINT) AS pairs FROM a JOIN b USING (difficulty)""")
def r11(spark, d):
    a, b = _metrics(spark, d, "scores.dense"), _metrics(spark, d, "scores.lexical").select("difficulty", F.col("mrr").alias("l"))
    return a.join(b, "difficulty").agg(F.round(F.avg("mrr"), 6).alias("dense_mrr"), F.round(F.avg("l"), 6).alias("lexical_mrr"), F.round(F.avg(F.col("l") - F.col("mrr")), 6).alias("gain"), F.sum("pairs").alias("pairs"))


@query("q_r3_w2_w5_hybrid", """WITH b AS (SELECT query_id AS query, candidate_id AS doc, max(scores.dense) AS d, coalesce(max(scores.lexical), 0) AS l FROM retrieval_pairs GROUP BY ALL),
  w AS (SELECT *, min(d) OVER q AS d0, max(d) OVER q AS d1, min(l) OVER q AS l0, max(l) OVER q AS l1 FROM b WINDOW q AS (PARTITION BY query)),
  s AS (SELECT query, doc, round(0.65 * CASE WHEN d1 - d0 <= 1e-9 * greatest(abs(d1), abs(d0)) THEN 0 ELSE (d - d0) / (d1 - d0) END + 0.35 * CASE WHEN l1 - l0 <= 1e-9 * greatest(abs(l1), abs(l0)) THEN 0 ELSE (l - l0) / (l1 - l0) END, 6) AS combined FROM w)
  SELECT query, doc, combined, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY combined DESC, doc) AS rank FROM s) WHERE rank <= 5""")
def r3(spark, d):
    r = read_table(spark, d, "retrieval_pairs").groupBy(F.col("query_id").alias("query"), F.col("candidate_id").alias("doc")).agg(F.max("scores.dense").alias("dense"), F.max("scores.lexical").alias("lexical"))
    h = retrieval.hybrid(r.select("query", "doc", F.col("dense").alias("score")), r.select("query", "doc", F.col("lexical").alias("score")))
    return retrieval.top_k(h.select("query", "doc", F.round("combined", 6).alias("combined")), 5, score="combined")


@query("q_r5_triplets", "SELECT query_id AS query, arg_min(candidate_id, rank) FILTER (label = 1) AS positive, arg_min(candidate_id, rank) FILTER (label <> 1) AS negative FROM retrieval_pairs GROUP BY query_id HAVING count(*) FILTER (label = 1) > 0 AND count(*) FILTER (label <> 1) > 0")
def r5(spark, d):
    return retrieval.retrieval_triplets(read_table(spark, d, "retrieval_pairs").select(F.col("query_id").alias("query"), F.col("candidate_id").alias("doc"), "rank", "label"))


@query("q_r6_r8_a22_coverage", f"""WITH g AS (SELECT query_id AS query, count(*) AS candidates, sum(label) AS hits, CAST(min(rank) FILTER (label = 1) AS INTEGER) AS first_rank FROM retrieval_pairs GROUP BY query_id),
  w AS (SELECT query_id AS query, len(coalesce(positives, [])) AS n, min_positive_hits AS min_hits FROM {LABELLED})
  SELECT query, coalesce(candidates, 0) AS candidates, CAST(coalesce(hits, 0) AS BIGINT) AS hits, round(coalesce(hits, 0) / nullif(CAST(n AS DOUBLE), 0), 6) AS recall, first_rank,
  CASE WHEN coalesce(hits, 0) < min_hits THEN 'too few positives' WHEN coalesce(candidates, 0) - coalesce(hits, 0) < 1 THEN 'no negative' END AS issue FROM w LEFT JOIN g USING (query)""")
def r6(spark, d):
    r = read_table(spark, d, "retrieval_pairs").select(F.col("query_id").alias("query"), F.col("candidate_id").alias("doc"), "rank", "label")
    w = labelled(spark, d, "text", "positives", "min_positive_hits").select(F.col("query_id").alias("query"), "positives", F.col("min_positive_hits").alias("min_hits"))
    return retrieval.coverage(r, w).withColumn("recall", F.round("recall", 6))


@query("q_a14_a15_run_stats", "SELECT lower(trim(difficulty)) AS difficulty, count(DISTINCT query_id) AS queries, count(*) AS pairs, count(*) FILTER (label = 1) AS positives, count(scores.lexical) AS with_lexical FROM retrieval_pairs GROUP BY 1")
def a14(spark, d):
    return read_table(spark, d, "retrieval_pairs").groupBy(F.lower(F.trim("difficulty")).alias("difficulty")).agg(
        F.countDistinct("query_id").alias("queries"), F.count(F.lit(1)).alias("pairs"), F.count_if(F.col("label") == 1).alias("positives"), F.count("scores.lexical").alias("with_lexical"))


@query("q_a16_a17_percentiles", """WITH p AS (SELECT l_returnflag, l_extendedprice AS v, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) AS r, count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem)
  SELECT l_returnflag, round(quantile_cont(v, 0.2), 4) AS p20, round(avg(v) FILTER (r > floor(n * 0.1) AND r <= n - floor(n * 0.1)), 4) AS trimmed, round(avg(v), 4) AS mean FROM p GROUP BY l_returnflag""")
def a17(spark, d):
    from quarryloom.operators.statistics import quantiles, trimmed_mean

    rows = read_table(spark, d, "lineitem")
    t = trimmed_mean(rows, ["l_returnflag"], "l_extendedprice", 0.1)
    p = rows.groupBy("l_returnflag").agg(F.round(F.avg("l_extendedprice"), 4).alias("mean")).join(quantiles(rows, ["l_returnflag"], "l_extendedprice", {"p20": 0.2}), "l_returnflag")
    return p.join(t, "l_returnflag").select("l_returnflag", F.round("p20", 4).alias("p20"), F.round("trimmed", 4).alias("trimmed"), "mean")


@query("q_a18_length_stats", f"SELECT chunk_type, round(avg(n), 6) AS mean, CAST(floor(quantile_cont(n, 0.9)) AS INTEGER) AS p90, CAST(floor(quantile_cont(n, 0.95)) AS INTEGER) AS p95 FROM (SELECT chunk_type, len({tok_sql('content')}) AS n FROM {CHUNKS}) GROUP BY chunk_type")
def a18(spark, d):
    c = chunks(spark, d, "chunk_type", "content").select("chunk_type", T.token_count(F.col("content")).alias("n"))
    from quarryloom.operators.statistics import quantiles
    from quarryloom.runtime import cut

    c = cut(c)
    means = c.groupBy("chunk_type").agg(F.round(F.avg("n"), 6).alias("mean"))
    return means.join(quantiles(c, ["chunk_type"], "n", {"p90": 0.9, "p95": 0.95}), "chunk_type").select("chunk_type", "mean", F.floor("p90").cast("int").alias("p90"), F.floor("p95").cast("int").alias("p95"))


@query("q_a19_p8_balance", f"""WITH c AS (SELECT id, {_CATEGORY} AS category FROM {CHUNKS}), r AS (SELECT * FROM (VALUES ('messaging', 0.25), ('observability', 0.4), ('typography', 0.35)) v(category, ratio)),
  t AS (SELECT category, CAST(ratio AS DOUBLE) AS ratio, coalesce(n, 0) AS n FROM r LEFT JOIN (SELECT category, count(*) AS n FROM c GROUP BY category) USING (category)),
  f AS (SELECT *, floor(min(n / ratio) OVER () + 1e-9) AS everything FROM t), e AS (SELECT category, everything, everything * ratio AS exact, floor(everything * ratio + 1e-9) AS base FROM f),
  g AS (SELECT category, base + CASE WHEN row_number() OVER (ORDER BY round(exact - base, 9) DESC, category DESC) <= everything - sum(base) OVER () THEN 1 ELSE 0 END AS target FROM e),
  k AS (SELECT id, category, row_number() OVER (PARTITION BY category ORDER BY md5('0:' || id), id) AS rn FROM c)
  SELECT id, k.category FROM k LEFT JOIN g USING (category) WHERE (SELECT min(target) FROM g) = 0 OR rn <= coalesce(target, 0)""")
def a19(spark, d):
    """Chunks cut to shares of three categories."""
    c = chunks(spark, d, "category").select("id", T.category(F.col("category")).alias("category"))
    return mining.balance(c, "category", {"messaging": 0.25, "typography": 0.35, "observability": 0.4}, ["id"]).select("id", "category")


@query("q_a21_accuracy", "SELECT round(avg(CASE WHEN (scores.combined >= 0.5) = (label = 1) THEN 1.0 ELSE 0.0 END), 6) AS accuracy, count(*) AS pairs FROM retrieval_pairs WHERE scores.combined IS NOT NULL")
def a21(spark, d):
    r = read_table(spark, d, "retrieval_pairs").where(F.col("scores.combined").isNotNull())
    return r.agg(F.round(F.avg(((F.col("scores.combined") >= 0.5) == (F.col("label") == 1)).cast("double")), 6).alias("accuracy"), F.count(F.lit(1)).alias("pairs"))


@query("q_a23_validation_text", f"SELECT 'problems: ' || coalesce(string_agg(line, '; ' ORDER BY line), '') AS report FROM (SELECT issue || ' ' || count(*) AS line FROM (SELECT CASE WHEN text IS NULL OR trim(text) = '' THEN 'no text' WHEN len(coalesce(positives, [])) = 0 THEN 'no positives' END AS issue FROM {LABELLED}) WHERE issue IS NOT NULL GROUP BY issue)")
def a23(spark, d):
    issue = F.when(F.col("text").isNull() | (F.trim("text") == ""), "no text").when(F.size(F.coalesce("positives", F.array().cast("array<string>"))) == 0, "no positives")
    q = labelled(spark, d, "text", "positives").select(issue.alias("issue")).where(F.col("issue").isNotNull()).groupBy("issue").agg(F.count(F.lit(1)).alias("n"))
    return q.agg(F.concat(F.lit("problems: "), F.array_join(F.array_sort(F.collect_list(F.concat_ws(" ", "issue", F.col("n").cast("string")))), "; ")).alias("report"))


# --- windows, sorts, sets --------------------------------------------------------------------------------------------


@query("q_w1_h2_prev_next", f"SELECT id, lag(id) OVER w AS prev, lead(id) OVER w AS next FROM {CHUNKS} WINDOW w AS (PARTITION BY filename ORDER BY pos, id)")
def w1(spark, d):
    from quarryloom.operators.order import link_prev_next

    return link_prev_next(chunks(spark, d, "filename", "pos"), scope="file").select("id", "prev", "next")


@query("q_h2_corpus_links", f"SELECT id, lag(id) OVER w AS prev, lead(id) OVER w AS next FROM {CHUNKS} WINDOW w AS (ORDER BY pos, id)")
def h2(spark, d):
    from quarryloom.operators.order import link_prev_next

    return link_prev_next(chunks(spark, d, "filename", "pos"), scope="corpus").select("id", "prev", "next")


@query("q_w3_first_k", f"SELECT id, filename FROM (SELECT id, filename, row_number() OVER (PARTITION BY filename ORDER BY pos, id) AS rn FROM {CHUNKS}) WHERE rn <= 3")
def w3(spark, d):
    return ranking.first_per_group(chunks(spark, d, "filename", "pos"), ["filename"], ["pos", "id"], 3).select("id", "filename")


@query("q_w6_enumerate", f"SELECT query_id, 'q' || lpad(CAST(row_number() OVER (ORDER BY query_id) AS VARCHAR), 6, '0') AS label FROM {LABELLED}")
def w6(spark, d):
    from quarryloom.operators.order import enumerate_rows

    return enumerate_rows(labelled(spark, d, "text").select("query_id"), ["query_id"], "n").select("query_id", F.format_string("q%06d", "n").alias("label"))


@query("q_w7_k9_train_test", """WITH h AS (SELECT query_id, rank, coalesce(difficulty, '') AS difficulty, md5('0:' || query_id || '-' || rank) AS h FROM retrieval_pairs),
  r AS (SELECT *, row_number() OVER (PARTITION BY difficulty ORDER BY h, query_id || '-' || rank) AS rn, count(*) OVER (PARTITION BY difficulty) AS n FROM h) SELECT query_id, rank, difficulty, CASE WHEN rn <= floor(n * 0.8) THEN 'train' ELSE 'test' END AS split FROM r""")
def w7(spark, d):
    r = read_table(spark, d, "retrieval_pairs").select("query_id", "rank", F.coalesce("difficulty", F.lit("")).alias("difficulty"), F.concat_ws("-", "query_id", F.col("rank").cast("string")).alias("key"))
    return ranking.split_rows(r, ["difficulty"], "key").select("query_id", "rank", "difficulty", "split")


@query("q_w9_first_relevant", "SELECT query_id, CAST(min(rank) AS INTEGER) AS first, 1.0 / min(rank) AS reciprocal FROM retrieval_pairs WHERE label = 1 GROUP BY query_id")
def w9(spark, d):
    return read_table(spark, d, "retrieval_pairs").where("label = 1").groupBy("query_id").agg(F.min("rank").alias("first"), (1.0 / F.min("rank")).alias("reciprocal"))


@query("q_o1_o4_largest", f"SELECT id, heading, CAST(len({tok_sql('content')}) AS BIGINT) AS tokens FROM {CHUNKS} ORDER BY tokens DESC, heading DESC, id LIMIT 50")
def o1(spark, d):
    return chunks(spark, d, "heading", "content").select("id", "heading", T.token_count(F.col("content")).alias("tokens")).orderBy(F.desc("tokens"), F.desc("heading"), "id").limit(50)


@query("q_o5_o7_sample", f"SELECT id FROM {CHUNKS} ORDER BY md5('7:' || id), id LIMIT 100")
def o5(spark, d):
    return ranking.sample_rows(chunks(spark, d, "pos"), 100, "id", seed=7).select("id")


@query("q_o6_random_choice", f"SELECT filename, arg_min(id, md5('3:' || id)) AS chosen FROM {CHUNKS} GROUP BY filename")
def o6(spark, d):
    return chunks(spark, d, "filename").groupBy("filename").agg(F.min_by("id", ranking.hash_order("id", seed=3)).alias("chosen"))


@query("q_o8_o9_best_model", "SELECT difficulty, arg_max(candidate_id, scores.combined) AS best, round(max(scores.combined), 6) AS score FROM (SELECT * FROM retrieval_pairs WHERE scores.combined IS NOT NULL AND scores.combined = (SELECT max(r.scores.combined) FROM retrieval_pairs r WHERE r.difficulty = retrieval_pairs.difficulty)) GROUP BY difficulty HAVING count(*) = 1")
def o9(spark, d):
    r = read_table(spark, d, "retrieval_pairs").where(F.col("scores.combined").isNotNull() & F.col("difficulty").isNotNull()).select("difficulty", "candidate_id", F.col("scores.combined").alias("c"))
    m = r.groupBy("difficulty").agg(F.max("c").alias("c"))
    return r.join(m, ["difficulty", "c"]).groupBy("difficulty").agg(F.max_by("candidate_id", "c").alias("best"), F.round(F.max("c"), 6).alias("score"), F.count(F.lit(1)).alias("n")).where("n = 1").drop("n")


@query("q_o11_grid_page", "SELECT id, metadata_title, base_dir FROM catalogue WHERE regexp_matches(metadata_title, '(?i)documentation') ORDER BY metadata_title, id LIMIT 10 OFFSET 10")
def o11(spark, d):
    c = read_table(spark, d, "catalogue").where(F.col("metadata_title").rlike("(?i)documentation")).select("id", "metadata_title", "base_dir")
    return ranking.page(c, ["metadata_title", "id"], 2, 10)


_KEPT = f"(SELECT * FROM {CHUNKS} WHERE lower(coalesce(chunk_type, '')) NOT IN ('table'))"
_SUMMARY = f"CASE WHEN {strip_sql('chunk_summary')} <> '' AND lower({strip_sql('chunk_summary')}) <> 'false' THEN lower(chunk_summary) END"


def _pairs_sql() -> str:
    def within(key: str, k: int, kind: str) -> str:
        return f"""SELECT a.id AS anchor, b.id AS positive, '{kind}' AS pair_type FROM r_{kind} a JOIN r_{kind} b ON a.key = b.key AND a.rn < b.rn WHERE b.rn <= {k}"""

    keys = {"sibling": ("concat_header_path", 5), "summary": (f"CASE WHEN len(string_split({_SUMMARY}, ' ')) >= 5 THEN array_to_string(string_split({_SUMMARY}, ' ')[1:5], ' ') END", 3),
            "section": (f"CASE WHEN len({seg_sql('concat_header_path')}) >= 2 THEN array_to_string({seg_sql('concat_header_path')}[1:2], '/') END", 4)}
    tables = ", ".join(f"r_{n} AS (SELECT id, key, row_number() OVER (PARTITION BY key ORDER BY pos, id) AS rn FROM (SELECT id, pos, {k} AS key FROM kept) WHERE key <> '')" for n, (k, _) in keys.items())
    return f"kept AS {_KEPT}, {tables}, pairs AS (SELECT p.id AS anchor, c.id AS positive, 'parent_child' AS pair_type FROM kept c JOIN kept p ON c.parent_id = p.id UNION ALL " + " UNION ALL ".join(within(k, n, kind) for kind, (k, n) in keys.items()) + ")"


@query("q_x1_p1_positive_pairs", f"WITH {_pairs_sql()} SELECT anchor, positive, pair_type FROM pairs")
def x1(spark, d):
    c = chunks(spark, d, "pos", "parent_id", "concat_header_path", "chunk_summary", "chunk_type").withColumn("path", T.segments(F.col("concat_header_path")))
    return mining.positive_pairs(c)


@query("q_x2_dedupe_order", f"SELECT query_id, list_filter(list_transform(positives, lambda x, i: CASE WHEN list_position(list_transform(positives, lambda y: lower(trim(y))), lower(trim(x))) = i THEN lower(trim(x)) END), lambda z: z IS NOT NULL) AS positives FROM {LABELLED} WHERE positives IS NOT NULL")
def x2(spark, d):
    return labelled(spark, d, "text", "positives").where(F.col("positives").isNotNull()).select("query_id", F.array_distinct(F.filter(F.transform("positives", lambda p: F.lower(F.trim(p))), lambda p: p.isNotNull())).alias("positives"))


@query("q_x3_jaccard", f"""WITH s AS (SELECT id, parent_id, list_distinct({tok_sql('heading')}) AS w FROM {CHUNKS})
  SELECT c.id, p.id AS parent, round(len(list_intersect(c.w, p.w)) / CAST(nullif(len(list_distinct(list_concat(c.w, p.w))), 0) AS DOUBLE), 6) AS jaccard FROM s c JOIN s p ON c.parent_id = p.id WHERE len(c.w) + len(p.w) > 0""")
def x3(spark, d):
    c = chunks(spark, d, "parent_id", "heading").withColumn("w", F.array_distinct(T.tokens(F.col("heading"))))
    p = c.select(F.col("id").alias("parent"), F.col("w").alias("pw"))
    return c.join(p, c["parent_id"] == p["parent"]).where(F.size("w") + F.size("pw") > 0).select("id", "parent", F.round(T.jaccard(F.col("w"), F.col("pw")), 6).alias("jaccard"))


@query("q_x5_x6_set_operations", f"SELECT coalesce(a.id, b.id) AS id, a.id IS NOT NULL AS retrieved, b.id IS NOT NULL AS labelled FROM (SELECT DISTINCT lower(trim(candidate_id)) AS id FROM retrieval_pairs) a FULL JOIN (SELECT DISTINCT lower(trim(u.p)) AS id FROM {LABELLED} q, unnest(q.positives) AS u(p) WHERE u.p IS NOT NULL) b ON a.id = b.id")
def x6(spark, d):
    a = read_table(spark, d, "retrieval_pairs").select(F.lower(F.trim("candidate_id")).alias("id")).distinct().withColumn("ra", F.lit(True))
    b = labelled(spark, d, "text", "positives").select(F.explode("positives").alias("p")).where("p is not null").select(F.lower(F.trim("p")).alias("id")).distinct().withColumn("lb", F.lit(True))
    return a.join(b, "id", "full_outer").select("id", F.coalesce("ra", F.lit(False)).alias("retrieved"), F.coalesce("lb", F.lit(False)).alias("labelled"))


# --- mining ----------------------------------------------------------------------------------------------------------


def _mining_chunks(spark, d):
    c = chunks(spark, d, "pos", "filename", "parent_id", "category", "concat_header_path", "heading", "chunk_summary", "chunk_type", "content")
    words = F.array_distinct(F.slice(T.tokens(F.col("content")), 1, 30))
    return c.withColumn("path", T.segments(F.col("concat_header_path"))).withColumn("words", words).withColumn("category", T.category(F.col("category"))).withColumn(
        "top", T.top_heading(F.col("concat_header_path"), F.col("heading"))).drop("content")


def _jaccard_sql(a: str, b: str) -> str:
    return f"len(list_intersect(list_distinct({a}), list_distinct({b}))) / CAST(len(list_distinct(list_concat({a}, {b}))) AS DOUBLE)"


_MINED = f"""m AS (SELECT id, filename, {_CATEGORY} AS category, {seg_sql('concat_header_path')} AS path, list_distinct({tok_sql('content')}[1:30]) AS words, lower(coalesce(chunk_type, '')) AS kind,
    nullif({strip_sql('heading')}, '') AS head FROM {CHUNKS}),
  mc AS (SELECT *, coalesce(path[1], lower(head), '') AS top, coalesce(lower(head), path[len(path)], '') AS leaf, md5('0:' || id) AS h FROM m),
  er AS (SELECT *, row_number() OVER (ORDER BY h, id) AS rn, count(*) OVER () AS n FROM mc),
  others AS (SELECT a.id AS anchor, c.id AS negative, (c.rn - a.rn + a.n) % a.n AS off FROM er a JOIN er c ON (c.rn - a.rn + a.n) % a.n BETWEEN 1 AND 3)"""
_EASY = """easy AS (SELECT anchor, negative, tier, CAST(1 AS INTEGER) AS choice FROM (SELECT a.id AS anchor, c.id AS negative, CASE WHEN a.category <> c.category THEN 1 WHEN a.filename IS DISTINCT FROM c.filename THEN 2 ELSE 3 END AS tier,
    (c.rn - a.rn + a.n) % a.n AS off FROM er a JOIN er c ON a.top <> c.top) QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY tier, off) = 1)"""
_MEDIUM = f"""mr AS (SELECT *, row_number() OVER (PARTITION BY top ORDER BY h, id) AS rn, count(*) OVER (PARTITION BY top) AS n, kind <> 'table' OR row_number() OVER (PARTITION BY top, kind = 'table' ORDER BY h, id) <= 3 AS allowed FROM mc),
  mp AS (SELECT a.id AS anchor, c.id AS negative, (c.rn - a.rn + a.n) % a.n AS off, a.filename IS NOT DISTINCT FROM c.filename AS infile, a.leaf = c.leaf AS same,
    CASE WHEN len(a.path) > 0 AND len(c.path) > 0 THEN {_jaccard_sql('a.path', 'c.path')} END AS p, CASE WHEN len(a.words) > 0 AND len(c.words) > 0 THEN {_jaccard_sql('a.words', 'c.words')} END AS w
    FROM mr a JOIN mr c ON a.top = c.top AND a.id <> c.id WHERE c.allowed),
  mt AS (SELECT anchor, negative, off, CASE WHEN coalesce(p BETWEEN 0.2 AND 0.5 OR (p < 0.3 AND infile), false) THEN 1 WHEN coalesce(w BETWEEN 0.15 AND 0.4, false) THEN 3 ELSE 5 END + CAST(same AS INTEGER) AS tier FROM mp),
  m0 AS (SELECT anchor, negative, tier, CAST(row_number() OVER (PARTITION BY anchor ORDER BY tier, off) AS INTEGER) AS choice FROM mt QUALIFY choice <= 3),
  medium AS (SELECT * FROM m0 UNION ALL SELECT anchor, negative, 7, CAST(off AS INTEGER) FROM others WHERE anchor NOT IN (SELECT anchor FROM m0))"""
def _hard_sql(path_least: float = 0.35, words_least: float = 0.2, top: int = 20) -> str:
    return f"""hr AS (SELECT *, row_number() OVER (ORDER BY h, id) AS rn FROM mc),
  ha AS (SELECT *, floor(rn * CAST(0.3 AS DOUBLE)) > floor((rn - 1) * CAST(0.3 AS DOUBLE)) AS need FROM hr),
  hp AS (SELECT a.id AS anchor, c.id AS negative, a.need AND a.category <> c.category AS cross_source, a.category = c.category AS same,
    CASE WHEN len(a.path) > 0 AND len(c.path) > 0 THEN {_jaccard_sql('a.path', 'c.path')} ELSE 0.0 END AS p, CASE WHEN len(a.words) > 0 AND len(c.words) > 0 THEN {_jaccard_sql('a.words', 'c.words')} ELSE 0.0 END AS w
    FROM ha a JOIN mc c ON a.top = c.top AND a.id <> c.id),
  ht AS (SELECT *, CASE WHEN p >= {path_least} OR w >= {words_least} THEN 1 WHEN same THEN 2 ELSE 3 END AS tier, CASE WHEN tier = 1 THEN round(CAST(0.6 AS DOUBLE) * p + CAST(0.4 AS DOUBLE) * w, 9) ELSE 0.0 END AS score FROM hp),
  hb AS (SELECT * FROM ht QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY tier, cross_source DESC, score DESC, negative) <= {top}),
  h0 AS (SELECT anchor, negative, tier, score, CAST(row_number() OVER (PARTITION BY anchor ORDER BY tier, cross_source DESC, md5('0:' || anchor || ':' || negative)) AS INTEGER) AS choice FROM hb QUALIFY choice <= 3),
  hard AS (SELECT * FROM h0 UNION ALL SELECT anchor, negative, 4, 0.0, CAST(off AS INTEGER) FROM others WHERE anchor NOT IN (SELECT anchor FROM h0))"""


_HARD = _hard_sql()


@query("q_p2_easy_negatives", f"WITH {_MINED}, {_EASY} SELECT * FROM easy")
def p2(spark, d):
    c = _mining_chunks(spark, d)
    return mining.easy_negatives(c, c)


@query("q_p3_medium_negatives", f"WITH {_MINED}, {_MEDIUM} SELECT * FROM medium")
def p3(spark, d):
    c = _mining_chunks(spark, d)
    return mining.medium_negatives(c, c)


@query("q_p4_w8_hard_negatives", f"WITH {_MINED}, {_HARD} SELECT anchor, negative, tier, round(score, 6) AS score, choice FROM hard")
def p4(spark, d):
    c = _mining_chunks(spark, d)
    return mining.hard_negatives(c, c).withColumn("score", F.round("score", 6))


@query("q_p11_rerank_negatives", f"WITH {_MINED}, {_hard_sql(mining.RERANK_PATH, mining.RERANK_WORDS, mining.RERANK_TOP)} SELECT anchor, negative, tier, round(score, 6) AS score, choice FROM hard")
def p11(spark, d):
    c = _mining_chunks(spark, d)
    return mining.hard_negatives(c, c, path_least=mining.RERANK_PATH, words_least=mining.RERANK_WORDS, top=mining.RERANK_TOP).withColumn("score", F.round("score", 6))


@query("q_p6_negative_pairs", f"""WITH {_MINED}, {_pairs_sql()}, nr AS (SELECT *, row_number() OVER (ORDER BY h, id) AS rn, count(*) OVER () AS n, min(category) OVER () < max(category) OVER () AS cats, min(filename) OVER () < max(filename) OVER () AS files FROM mc),
  np AS (SELECT a.id AS anchor, c.id AS negative, CASE WHEN a.category <> c.category THEN 1 WHEN a.filename IS DISTINCT FROM c.filename THEN 2 ELSE 3 END AS tier, (c.rn - a.rn + a.n) % a.n AS off
    FROM nr a JOIN nr c ON a.id <> c.id WHERE a.id IN (SELECT anchor FROM pairs)),
  n3 AS (SELECT anchor, negative, tier, row_number() OVER (PARTITION BY anchor ORDER BY tier, off) AS choice FROM np QUALIFY choice <= 3)
  SELECT anchor, positive, negative, 'negative_' || ['cross_domain', 'diff_file', 'random'][tier] || '_' || pair_type AS pair_type FROM (SELECT DISTINCT anchor, positive, pair_type FROM pairs) JOIN n3 USING (anchor)
  WHERE negative <> positive QUALIFY row_number() OVER (PARTITION BY anchor, positive, pair_type ORDER BY choice) <= 2""")
def p6(spark, d):
    c = _mining_chunks(spark, d)
    return mining.negative_pairs(mining.positive_pairs(c), c)


@query("q_a20_same_source_mix", f"""WITH {_MINED}, {_pairs_sql()}, j AS (SELECT a.category, a.category = b.category AS same FROM pairs p JOIN mc a ON a.id = p.anchor JOIN mc b ON b.id = p.positive),
  g AS (SELECT category, count(*) AS pairs, count(*) FILTER (same) AS same FROM j GROUP BY category),
  t AS (SELECT *, pairs - same AS "cross", CAST(least(same, floor(pairs * CAST(0.7 AS DOUBLE))) AS BIGINT) AS same_taken FROM g), u AS (SELECT *, least("cross", pairs - same_taken) AS cross_taken FROM t)
  SELECT *, pairs - same_taken - cross_taken AS backfilled FROM u""")
def a20(spark, d):
    c = _mining_chunks(spark, d)
    return mining.same_source_mix(mining.positive_pairs(c), c)


def _triplets_sql() -> str:
    parts = [f"""SELECT DISTINCT p.anchor, p.positive, n.negative, p.pair_type, '{name}' AS difficulty, CASE WHEN {valid_sql('va.embedding')} AND {valid_sql('vn.embedding')}
        THEN list_cosine_similarity(CAST(va.embedding AS DOUBLE[]), CAST(vn.embedding AS DOUBLE[])) END AS c, {low} AS low, {high} AS high
      FROM (SELECT p.anchor, p.positive, p.pair_type, min(choice) AS choice FROM pairs p JOIN {name} n ON n.anchor = p.anchor AND n.negative <> p.positive GROUP BY ALL) p
      JOIN {name} n ON n.anchor = p.anchor AND n.choice = p.choice JOIN ce va ON va.id = p.anchor JOIN ce vn ON vn.id = n.negative"""
             for name, low, high in (("easy", -1.0, mining.EASY_MAX), ("medium", *mining.MEDIUM), ("hard", -1.0, mining.HARD_MAX))]
    return f"""WITH {_MINED}, {_pairs_sql()}, {_EASY}, {_MEDIUM}, {_HARD}, ce AS (SELECT id, embedding FROM {CHUNKS}), t3 AS ({' UNION ALL '.join(parts)}),
      triplets AS (SELECT anchor, positive, negative, pair_type, difficulty, round(c, 6) AS cosine, coalesce(round(c, 9) BETWEEN low AND high, true) AS kept FROM t3)"""


@query("q_p5_p7_triplets", f"{_triplets_sql()} SELECT * FROM triplets")
def p7(spark, d):
    from quarryloom.runtime import cut

    c = cut(_mining_chunks(spark, d))
    pairs = cut(mining.positive_pairs(c))
    v = chunks(spark, d, "embedding")
    out = None
    for name, negatives, low, high in (("easy", mining.easy_negatives(c, c), -1.0, mining.EASY_MAX), ("medium", mining.medium_negatives(c, c), *mining.MEDIUM), ("hard", mining.hard_negatives(c, c), -1.0, mining.HARD_MAX)):
        part = mining.triplets(pairs, negatives, v, name, low, high)
        out = part if out is None else out.unionByName(part)
    return out.withColumn("cosine", F.round("cosine", 6))


@query("q_k10_a11_export_stats", f"""{_triplets_sql()} SELECT difficulty, CAST(sum(n) AS BIGINT) AS total, CAST(sum(k) AS BIGINT) AS kept, CAST(sum(n) - sum(k) AS BIGINT) AS removed, array_to_string(list(pair_type || '=' || n ORDER BY pair_type), ',') AS pair_types
  FROM (SELECT difficulty, pair_type, count(*) AS n, count(*) FILTER (kept) AS k FROM triplets GROUP BY ALL) GROUP BY difficulty""")
def k10(spark, d):
    pairs = F.array_join(F.transform(F.array_sort(F.map_entries("pair_types")), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",")
    return mining.export_statistics(p7(spark, d)).withColumn("pair_types", pairs)


@query("q_k11_cross_encoder_pairs", f"{_triplets_sql()} SELECT anchor AS query, difficulty, pair_type, u.c AS candidate, u.l AS label FROM triplets, LATERAL (VALUES (positive, 1), (negative, 0)) u(c, l) WHERE kept")
def k11(spark, d):
    return mining.cross_encoder_pairs(p7(spark, d).where("kept"))
