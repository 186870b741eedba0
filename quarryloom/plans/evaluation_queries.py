"""Queries over scorers, run logs, diagnostics, length buckets and crawls."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarryloom.functions import text as T
from quarryloom.functions import vectors as V
from quarryloom.operators import retrieval
from quarryloom.operators.encoders import score_pairs
from quarryloom.operators.order import enumerate_rows
from quarryloom.operators.statistics import quantiles
from quarryloom.plans.registry import CHUNKS, LABELLED, chunks, labelled, query
from quarryloom.plans.relational_queries import _BM25, _metrics, _metrics_sql, tok_sql
from quarryloom.plans.scalar_queries import strip_sql, valid_sql
from quarryloom.runtime import cut, read_table
from quarryloom.sources import writers
from quarryloom.sources.crawl import crawl, site_url


@query("q_r9_probe", f"SELECT p.doc, p.score, p.rank, substr(regexp_replace(d.text, '\\s+', ' ', 'g'), 1, 80) AS preview FROM ({_BM25}) p JOIN documents d ON d.doc_id = p.doc WHERE p.query = (SELECT min(item_id) FROM eval_items) AND p.rank <= 5")
def r9(spark, d):
    """A preview of the five best documents of one question; the limit is the feature."""
    docs = read_table(spark, d, "documents")
    items = read_table(spark, d, "eval_items")
    best = retrieval.bm25_top_k(items.join(items.agg(F.min("item_id").alias("item_id")), "item_id"), docs, "item_id", "text", "doc_id", "text", 5)
    return best.join(docs.select(F.col("doc_id").alias("doc"), "text"), "doc").select("doc", "score", "rank", F.substring(F.regexp_replace("text", r"\s+", " "), 1, 80).alias("preview"))


_SCORED = f"""s AS (SELECT r.query_id, r.candidate_id, r.rank, r.label, lower(trim(r.difficulty)) AS difficulty, list_distinct({tok_sql('q.text')}) AS qw, list_distinct({tok_sql('c.content')}) AS cw
    FROM retrieval_pairs r LEFT JOIN {LABELLED} q ON q.query_id = r.query_id LEFT JOIN {CHUNKS} c ON lower(c.id) = lower(trim(r.candidate_id))),
  scored AS (SELECT *, CASE WHEN len(qw) > 0 THEN len(list_intersect(qw, cw)) / CAST(len(qw) AS DOUBLE) ELSE 0.0 END AS score FROM s)"""


def _scored(spark, d):
    c = chunks(spark, d, "content").select(F.lower("id").alias("key"), "content")
    q = labelled(spark, d, "text").select("query_id", F.col("text").alias("question"))
    r = read_table(spark, d, "retrieval_pairs").select("query_id", "candidate_id", "rank", "label", F.lower(F.trim("difficulty")).alias("difficulty"), F.lower(F.trim("candidate_id")).alias("key"))
    return score_pairs(r.join(q, "query_id", "left").join(c, "key", "left"), "question", "content", "score")


@query("q_r12_rerank_scores", f"WITH {_SCORED} SELECT query_id, rank, candidate_id, round(score, 6) AS score FROM scored")
def r12(spark, d):
    return _scored(spark, d).select("query_id", "rank", "candidate_id", F.round("score", 6).alias("score"))


@query("q_r13_average_precision", f"""WITH {_SCORED}, k AS (SELECT difficulty, query_id, CASE WHEN label > 0 THEN 1 ELSE 0 END AS rel, row_number() OVER w AS r, sum(CASE WHEN label > 0 THEN 1 ELSE 0 END) OVER w AS hits FROM scored
    WINDOW w AS (PARTITION BY difficulty, query_id ORDER BY round(score, 9) DESC, candidate_id ROWS UNBOUNDED PRECEDING)),
  p AS (SELECT difficulty, query_id, sum(rel) AS npos, sum(CASE WHEN rel = 1 AND r <= 10 THEN CAST(hits AS DOUBLE) / r ELSE 0 END) AS gain FROM k GROUP BY ALL)
  SELECT difficulty, count(*) AS queries, round(avg(gain / least(npos, 10)), 6) AS map_10 FROM p WHERE npos > 0 GROUP BY difficulty""")
def r13(spark, d):
    m = retrieval.average_precision(_scored(spark, d).withColumn("score", F.round("score", 9)), "score")
    return m.withColumn("map_10", F.round("map_10", 6))


_RUN = {"timestamp": "01/02/26 03:04", "BASE_CWD": "run", "CODE_CHANGE": "", "max_length": 256, "batch_size": 16, "lr": 2e-5, "epochs": 3, "candidate_k": 50}


@query("q_k14_q3_master_log", f"""WITH a AS ({_metrics_sql('scores.dense')}), b AS ({_metrics_sql('scores.combined')}), x AS (SELECT printf('%.4f', avg(mrr)) AS m, printf('%.4f', avg(recall_5)) AS r, printf('%.4f', avg(ndcg_10)) AS n FROM a), y AS (SELECT printf('%.4f', avg(mrr)) AS m, printf('%.4f', avg(recall_5)) AS r, printf('%.4f', avg(ndcg_10)) AS n FROM b)
  SELECT '01/02/26 03:04' AS timestamp, 'run' AS BASE_CWD, '' AS CODE_CHANGE, '256' AS max_length, '16' AS batch_size, '2e-5' AS lr, '3' AS epochs, '50' AS candidate_k, (SELECT CAST(count(*) AS VARCHAR) FROM {CHUNKS}) AS num_chunks,
    (SELECT CAST(count(DISTINCT query_id) AS VARCHAR) FROM retrieval_pairs) AS num_eval_queries, x.m AS baseline_mrr, y.m AS rerank_mrr, x.r AS baseline_recall5, y.r AS rerank_recall5, x.n AS baseline_ndcg10, y.n AS rerank_ndcg10, '1.50' AS retrieval_seconds, '2.25' AS rerank_seconds, '3.75' AS total_seconds FROM x, y""")
def k14(spark, d):
    mean = lambda score: _metrics(spark, d, score).agg(*[F.avg(c).alias(c) for c in ("mrr", "recall_5", "ndcg_10")])
    counts = chunks(spark, d).agg(F.count(F.lit(1)).alias("num_chunks")).crossJoin(read_table(spark, d, "retrieval_pairs").agg(F.countDistinct("query_id").alias("num_eval_queries")))
    run = counts.select("*", *[F.lit(v).alias(k) for k, v in _RUN.items()], F.lit(1.5).alias("retrieval_seconds"), F.lit(2.25).alias("rerank_seconds"))
    return writers.master_log(run, mean("scores.dense"), mean("scores.combined"))


@query("q_k16_cosine_details", f"""WITH v AS (SELECT id, parent_id, CAST(embedding AS DOUBLE[]) AS e FROM {CHUNKS} WHERE {valid_sql('embedding')})
  SELECT row_number() OVER (ORDER BY p.id, c.id) AS "index", round(list_cosine_similarity(p.e, c.e), 6) AS anchor_negative_cosine FROM v c JOIN v p ON c.parent_id = p.id""")
def k16(spark, d):
    v = chunks(spark, d, "parent_id", "embedding").where(V.valid(F.col("embedding"), 48))
    p = v.select(F.col("id").alias("parent_id"), F.col("embedding").alias("pe"))
    pairs = v.join(p, "parent_id").select("parent_id", "id", F.round(V.cosine(F.col("pe"), F.col("embedding")), 6).alias("anchor_negative_cosine"))
    return enumerate_rows(pairs, ["parent_id", "id"], "index").select("index", "anchor_negative_cosine")


def _side_sql(column: str) -> str:
    return f"""SELECT CAST(count(*) AS DOUBLE) AS vectors, min(lo) AS least, max(hi) AS most, sum(s) / (48 * count(*)) AS mean, sqrt(greatest(sum(q) / (48 * count(*)) - (sum(s) / (48 * count(*))) ** 2, 0)) AS spread, min(sqrt(q)) AS norm_min
      FROM (SELECT list_min(e) AS lo, list_max(e) AS hi, list_sum(e) AS s, list_sum(list_transform(e, lambda x: x * x)) AS q FROM (SELECT CAST({column} AS DOUBLE[]) AS e FROM {CHUNKS} WHERE {valid_sql(column)}))"""


_NOTES = "CASE WHEN metric = 'spread' THEN CASE WHEN t > 0.01 AND o > 0.01 THEN 'both spread' WHEN t > 0.01 THEN 'only first spread' WHEN o > 0.01 THEN 'only second spread' ELSE 'both collapsed' END WHEN abs(t - o) < 0.001 THEN 'alike' WHEN t > o THEN 'higher' ELSE 'lower' END"


@query("q_z6_e15_diagnostics", f"""WITH a AS ({_side_sql('embedding')}), b AS ({_side_sql('embedding_summary_chunk')}), t AS (SELECT metric, v AS t FROM a UNPIVOT (v FOR metric IN (vectors, least, most, mean, spread, norm_min))), o AS (SELECT metric, v AS o FROM b UNPIVOT (v FOR metric IN (vectors, least, most, mean, spread, norm_min)))
  SELECT metric, round(t, 6) AS first, round(o, 6) AS second, {_NOTES} AS note, (SELECT CASE WHEN spread > 0.01 AND norm_min > 0.05 THEN 'great' ELSE 'weak' END FROM a) AS rating FROM t JOIN o USING (metric)""")
def z6(spark, d):
    """Statistics of two vector columns side by side with notes, and the rating of the first."""
    names = ["vectors", "least", "most", "mean", "spread", "norm_min"]

    def side(column: str, into: str):
        e = F.transform(column, lambda x: x.cast("double"))
        add = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
        rows = chunks(spark, d, column).where(V.valid(F.col(column), 48)).select(F.array_min(e).alias("lo"), F.array_max(e).alias("hi"), add(e).alias("s"), add(F.transform(e, lambda x: x * x)).alias("q"))
        n = F.count(F.lit(1))
        mean = F.sum("s") / (48 * n)
        out = rows.agg(n.cast("double").alias("vectors"), F.min("lo").alias("least"), F.max("hi").alias("most"), mean.alias("mean"), F.sqrt(F.greatest(F.sum("q") / (48 * n) - mean * mean, F.lit(0.0))).alias("spread"), F.min(F.sqrt("q")).alias("norm_min"))
        return out

    first, second = cut(side("embedding", "t")), side("embedding_summary_chunk", "o")
    rating = first.select(F.when((F.col("spread") > 0.01) & (F.col("norm_min") > 0.05), "great").otherwise("weak").alias("rating"))
    both = first.unpivot([], names, "metric", "t").join(second.unpivot([], names, "metric", "o"), "metric").crossJoin(rating)  # one row
    return both.select("metric", F.round("t", 6).alias("first"), F.round("o", 6).alias("second"), F.expr(_NOTES).alias("note"), "rating")


@query("q_z7_summary_quality", f"""WITH w AS (SELECT chunk_type, list_distinct({tok_sql('content')}) AS c, list_distinct({tok_sql('chunk_summary')}) AS s FROM {CHUNKS} WHERE {strip_sql('chunk_summary')} <> '' AND lower({strip_sql('chunk_summary')}) <> 'false' AND {strip_sql('content')} <> ''),
  p AS (SELECT chunk_type, len(list_intersect(c, s)) / CAST(len(s) AS DOUBLE) AS precision, len(list_intersect(c, s)) / CAST(len(c) AS DOUBLE) AS recall FROM w)
  SELECT chunk_type, count(*) AS chunks, round(avg(precision), 6) AS precision, round(avg(recall), 6) AS recall, round(quantile_cont(round(precision, 9), 0.2), 6) AS p20 FROM p GROUP BY chunk_type""")
def z7(spark, d):
    """How much of a summary its content bears out, and how much of the content it covers, per chunk type; 20th percentile of the former."""
    c = chunks(spark, d, "chunk_type", "content", "chunk_summary").where(T.sentinel_to_null(F.col("chunk_summary")).isNotNull() & T.blank_to_null(F.col("content")).isNotNull())
    c = c.select("chunk_type", F.array_distinct(T.tokens(F.col("content"))).alias("c"), F.array_distinct(T.tokens(F.col("chunk_summary"))).alias("s"))
    shared = F.size(F.array_intersect("c", "s")).cast("double")
    p = cut(c.select("chunk_type", (shared / F.size("s")).alias("precision"), (shared / F.size("c")).alias("recall")))
    means = p.groupBy("chunk_type").agg(F.count(F.lit(1)).alias("chunks"), F.round(F.avg("precision"), 6).alias("precision"), F.round(F.avg("recall"), 6).alias("recall"))
    low = quantiles(p.withColumn("v", F.round("precision", 9)), ["chunk_type"], "v", {"p20": 0.2}).withColumnRenamed("chunk_type", "k")
    return means.join(low, F.col("chunk_type").eqNullSafe(F.col("k"))).drop("k").withColumn("p20", F.round("p20", 6))


_BUCKETS = "CASE WHEN n <= 16 THEN 16 WHEN n <= 32 THEN 32 WHEN n <= 48 THEN 48 WHEN n <= 64 THEN 64 WHEN n <= 84 THEN 84 ELSE CAST(ceil(n / 8.0) * 8 AS BIGINT) END"


@query("q_z9_k17_length_buckets", f"""SELECT bucket, count(*) AS rows, CAST(sum(n) AS BIGINT) AS tokens, CAST(sum(bucket - n) AS BIGINT) AS padding, round(avg(n), 6) AS mean, round(quantile_cont(n, 0.9), 6) AS p90
  FROM (SELECT n, {_BUCKETS} AS bucket FROM (SELECT len({tok_sql('content')}) AS n FROM {CHUNKS})) GROUP BY bucket""")
def z9(spark, d):
    """Tokenised chunks by length bucket: rows, tokens, padding and lengths."""
    n = T.token_count(F.col("content"))
    c = cut(chunks(spark, d, "content").select(n.alias("len"), V.bucket_size(n).cast("bigint").alias("bucket")))
    per = c.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"), F.sum("len").alias("tokens"), F.sum(F.col("bucket") - F.col("len")).alias("padding"), F.round(F.avg("len"), 6).alias("mean"))
    return per.join(quantiles(c, ["bucket"], "len", {"p90": 0.9}), "bucket").withColumn("p90", F.round("p90", 6))


_PAGES = f"(SELECT 'https://docs.' || split_part(filename, '/', 1) || '.example/' || filename AS url, content AS html FROM {CHUNKS} WHERE filename IS NOT NULL)"


@query("q_s12_crawl", f"""WITH p AS {_PAGES}, h AS (SELECT url, regexp_replace(unnest(regexp_extract_all(html, '(?:href\\s*=\\s*["'']?|\\]\\()([^"''\\s)>]+)', 1)), '#.*$', '') AS href FROM p),
  l AS (SELECT DISTINCT url, CASE WHEN regexp_matches(href, '^https?://') THEN href WHEN starts_with(href, '//') THEN 'https:' || href WHEN starts_with(href, '/') THEN regexp_extract(url, '^(https://[^/?#]*)', 1) || href END AS link FROM h),
  e AS (SELECT url, link FROM l WHERE lower(regexp_extract(link, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) = lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1))),
  s AS (SELECT DISTINCT url FROM p), one AS (SELECT DISTINCT link AS url FROM e WHERE link NOT IN (SELECT url FROM s)), two AS (SELECT DISTINCT link AS url FROM e WHERE url IN (SELECT url FROM one) AND link NOT IN (SELECT url FROM s) AND link NOT IN (SELECT url FROM one))
  SELECT url, 0 AS depth FROM s UNION ALL SELECT url, 1 FROM one UNION ALL SELECT url, 2 FROM two""")
def s12(spark, d):
    """What a crawl from every stored page reaches within its site."""
    c = chunks(spark, d, "filename", "content").where(F.col("filename").isNotNull())
    pages = c.select(site_url(F.split("filename", "/")[0], F.col("filename")).alias("url"), F.col("content").alias("html"))
    return crawl(pages, pages.select("url"), depth=2)
