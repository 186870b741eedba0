"""Lexical and dense retrieval, fusion, labels, and ranking metrics."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarryloom.functions import text as T
from quarryloom.runtime import cut

K1, B = 1.5, 0.75
#: Queries that are answered in one pass over the documents, and the most weights (term x query) that a task holds for them.
QUERY_BLOCK, WEIGHTS = 512, 8_000_000


def postings(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc, term, tf, len``: terms of each document with frequency and the document's length. Empty texts have none."""
    toks = docs.select(F.col(id_col).alias("doc"), T.tokens(F.col(text_col)).alias("toks"))
    return toks.select("doc", F.size("toks").alias("len"), F.explode("toks").alias("term")).groupBy("doc", "len", "term").agg(F.count(F.lit(1)).alias("tf"))


def corpus_stats(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row: ``n`` documents and their mean length."""
    return docs.agg(F.count(F.lit(1)).alias("n"), F.avg(F.size(T.tokens(F.col(text_col)))).alias("avgdl"))


def bm25(queries: DataFrame, docs: DataFrame, query_id: str, query_text: str, id_col: str, text_col: str) -> DataFrame:
    """``query, doc, score`` of every document that shares a term with a query; a repeated query term counts repeatedly.

    Only terms that some query holds are kept after the corpus scan; document frequencies count all documents. The
    idf is ln(1 + (n - df + 0.5) / (df + 0.5)).
    """
    asked = queries.select(F.col(query_id).alias("query"), F.explode(T.tokens(F.col(query_text))).alias("term")).groupBy("query", "term").agg(F.count(F.lit(1)).alias("qf"))
    wanted = asked.select("term").distinct()
    posts = cut(postings(docs, id_col, text_col).join(wanted, "term", "left_semi"))
    stats = F.broadcast(corpus_stats(docs, id_col, text_col))  # one row
    df = posts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weights = df.crossJoin(stats).select("term", idf.alias("idf"), "avgdl")
    tf = F.col("tf").cast("double")
    part = F.col("qf") * F.col("idf") * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("len") / F.col("avgdl")))
    return asked.join(weights, "term").join(posts, "term").groupBy("query", "doc").agg(F.sum(part).alias("score"))


#: As ``T.tokens`` splits.
_SPACE = re.compile(r"[ \t\n\x0b\f\r]+")


class Best:
    """The ``k`` best documents of each query among those a task has seen, with all that tie with the last of them."""

    def __init__(self, queries: int, k: int) -> None:
        self.k, self.least, self.held, self.size = k, np.full(queries, -np.inf), [], 0

    def add(self, scores: np.ndarray, docs: np.ndarray) -> None:
        """``scores`` by document and query; minus infinity is no score."""
        if len(scores) > self.k:
            self.least = np.maximum(self.least, np.partition(scores, len(scores) - self.k, axis=0)[len(scores) - self.k])
        d, q = np.nonzero((scores >= self.least) & (scores > -np.inf))
        self.held.append((q, scores[d, q], docs[d]))
        self.size += len(q)
        if self.size > 500_000:
            self.reduce()

    def reduce(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.held:
            return np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)
        q, s, d = (np.concatenate(x) for x in zip(*self.held, strict=True))
        order = np.lexsort((-s, q))
        q, s, d = q[order], s[order], d[order]
        starts = np.searchsorted(q, np.arange(len(self.least)))
        ends = np.searchsorted(q, np.arange(len(self.least)), side="right")
        full = np.flatnonzero(ends - starts >= self.k)
        self.least[full] = np.maximum(self.least[full], s[starts[full] + self.k - 1])
        keep = s >= self.least[q]
        self.held, self.size = [(q[keep], s[keep], d[keep])], int(keep.sum())
        return self.held[0]

    def batches(self, names: list) -> Iterator[pa.RecordBatch]:
        q, s, d = self.reduce()
        for lo in range(0, len(q), 100_000):
            part = slice(lo, lo + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in q[part]], pa.int64()), pa.array(d[part]), pa.array(s[part])], ["query", "doc", "score"])


def _query_blocks(queries: DataFrame, column: str, size: int) -> Iterator[list[int]]:
    """Ids of the queries in blocks; only ids go through the driver, a block at a time."""
    block: list[int] = []
    for r in queries.select(column).distinct().orderBy(column).toLocalIterator():
        block.append(r[0])
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block


def _union(parts: list[DataFrame], schema: str, like: DataFrame) -> DataFrame:
    if not parts:
        return like.sparkSession.createDataFrame([], schema)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def bm25_top_k(queries: DataFrame, docs: DataFrame, query_id: str, query_text: str, id_col: str, text_col: str, k: int, digits: int = 6, block: int = QUERY_BLOCK) -> DataFrame:
    """``query, doc, score, rank``: the ``k`` best documents of every query by ``bm25``, scores rounded to ``digits``.

    Ids are integers. Queries are taken in blocks; a task holds the block's weights by term and query, scores each
    document in one pass over its own terms and keeps the ``k`` best, so that only k x queries x tasks rows are
    shuffled, however common a term is. Only the weights of a block, at most ``WEIGHTS``, are broadcast: fewer queries
    make a block where their terms are many. Null and empty texts match nothing; ties go to the smaller id.
    """
    asked = cut(queries.select(F.col(query_id).cast("bigint").alias("query"), F.explode(T.tokens(F.col(query_text))).alias("term")).groupBy("query", "term").agg(F.count(F.lit(1)).alias("qf")))
    terms = docs.select(F.explode(F.array_distinct(T.tokens(F.col(text_col)))).alias("term"))
    df = terms.join(asked.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weighted = cut(asked.join(df, "term"))
    total, mean = corpus_stats(docs, id_col, text_col).first()
    most = weighted.groupBy("query").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    size = max(1, min(block, math.isqrt(WEIGHTS // most)))
    spark, parts = docs.sparkSession, []
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    for ids in _query_blocks(weighted, "query", size):
        place = {q: i for i, q in enumerate(ids)}
        vocabulary: dict[str, int] = {}
        cells = []
        for r in weighted.where(F.col("query").between(ids[0], ids[-1])).toLocalIterator():
            cells.append((vocabulary.setdefault(r["term"], len(vocabulary)), place[r["query"]], r["qf"] * math.log(1 + (total - r["df"] + 0.5) / (r["df"] + 0.5))))
        weights = np.zeros((len(vocabulary), len(ids)))
        weights[[c[0] for c in cells], [c[1] for c in cells]] = [c[2] for c in cells]
        shared = spark.sparkContext.broadcast((ids, vocabulary, weights))

        def score(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids, vocabulary, weights = shared.value
            best = Best(len(ids), k)
            for b in batches:
                doc, text = b.column("doc").to_numpy(), b.column("text").to_pylist()
                for lo in range(0, len(text), 256):
                    out = np.full((min(256, len(text) - lo), len(ids)), -np.inf)
                    for i, t in enumerate(text[lo : lo + 256]):
                        words = [w for w in _SPACE.split(t.lower()) if w]
                        tf = {vocabulary[w]: n for w, n in Counter(words).items() if w in vocabulary}
                        if tf:
                            n = np.fromiter(tf.values(), float, len(tf))
                            part = n * (K1 + 1) / (n + K1 * (1 - B + B * len(words) / mean)) @ weights[np.fromiter(tf, int, len(tf))]
                            out[i] = np.where(part > 0, np.round(part, digits), -np.inf)
                    best.add(out, doc[lo : lo + 256])
            yield from best.batches(ids)

        parts.append(texts.mapInArrow(score, "query bigint, doc bigint, score double"))
    return top_k(_union(parts, "query bigint, doc bigint, score double", docs), k)


def dense_top_k(queries: DataFrame, docs: DataFrame, query_id: str, query_vector: str, id_col: str, vector: str, k: int, digits: int = 6, block: int = QUERY_BLOCK) -> DataFrame:
    """``query, doc, score, rank``: the ``k`` rows of greatest cosine for each of a stated set of queries, itself left out.

    The queries' unit vectors go to the tasks in blocks of ``block``; a task multiplies them with its rows as matrices
    and keeps the ``k`` best. Null vectors and those without direction take no part; vectors of unequal length are an error.
    """
    spark, parts = docs.sparkSession, []
    asked = cut(queries.select(F.col(query_id).cast("bigint").alias("query"), F.col(query_vector).cast("array<double>").alias("v")).where(F.col("v").isNotNull()))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc"), F.col(vector).cast("array<double>").alias("v")).where(F.col("v").isNotNull())
    for ids in _query_blocks(asked, "query", block):
        held = {r["query"]: r["v"] for r in asked.where(F.col("query").between(ids[0], ids[-1])).collect()}  # at most ``block`` rows
        q = np.array([held[i] for i in ids])
        shared = spark.sparkContext.broadcast((np.array(ids), q / np.maximum(np.sqrt((q * q).sum(1)), 1e-300)[:, None]))

        def score(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids, q = shared.value
            best = Best(len(ids), k)
            for b in batches:
                if not b.num_rows:
                    continue
                x = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                norm = np.sqrt((x * x).sum(1))
                doc = b.column("doc").to_numpy()
                s = np.round((x / np.maximum(norm, 1e-300)[:, None]) @ q.T, digits)
                s[~(np.isfinite(norm) & (norm > 0))] = -np.inf
                s[doc[:, None] == ids[None, :]] = -np.inf
                best.add(s, doc)
            yield from best.batches(ids.tolist())

        parts.append(rows.mapInArrow(score, "query bigint, doc bigint, score double"))
    return top_k(_union(parts, "query bigint, doc bigint, score double", docs), k)


def average_precision(pairs: DataFrame, score: str, k: int = 10, group: str = "difficulty", query: str = "query_id") -> DataFrame:
    """Per ``group``: queries with a relevant candidate, and their mean average precision among the first ``k``.

    Ranked as in ``ranking_metrics``. A query's average is over its relevant candidates, at most ``k`` of them.
    """
    s = F.coalesce(F.col(score).cast("double"), F.lit(float("-inf")))
    w = Window.partitionBy(group, query).orderBy(F.desc("s"), "candidate_id")
    r = pairs.select(group, query, "candidate_id", (F.col("label") > 0).cast("int").alias("rel"), s.alias("s")).withColumn("r", F.row_number().over(w))
    r = r.withColumn("hits", F.sum("rel").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    per = r.groupBy(group, query).agg(F.sum("rel").alias("npos"), F.sum(F.when((F.col("rel") == 1) & (F.col("r") <= k), F.col("hits") / F.col("r")).otherwise(0.0)).alias("gain")).where("npos > 0")
    return per.groupBy(group).agg(F.count(F.lit(1)).alias("queries"), F.avg(F.col("gain") / F.least("npos", F.lit(k))).alias(f"map_{k}"))


def top_k(scores: DataFrame, k: int, group: str = "query", score: str = "score", tie: str = "doc") -> DataFrame:
    """The ``k`` best rows of each group with ``rank`` (from 1); ties go to the smaller ``tie``."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.desc(score), tie))
    return scores.withColumn("rank", rank).where(F.col("rank") <= k)


def min_max(score: Column, *group: str) -> Column:
    """Scores scaled to [0, 1] within a group; all 0 where all are equal."""
    w = Window.partitionBy(*group)
    low, high = F.min(score).over(w), F.max(score).over(w)
    return F.when(high - low <= 1e-9 * F.greatest(F.abs(high), F.abs(low)), 0.0).otherwise((score - low) / (high - low))


def hybrid(dense: DataFrame, lexical: DataFrame, dense_weight: float = 0.65, lexical_weight: float = 0.35) -> DataFrame:
    """``query, doc, dense, lexical, combined`` from two score tables (``query, doc, score``), each min-max scaled per query; a missing score is 0."""
    d = dense.select("query", "doc", F.col("score").alias("d"))
    x = lexical.select("query", "doc", F.col("score").alias("l"))
    both = d.join(x, ["query", "doc"], "full_outer").select("query", "doc", F.coalesce("d", F.lit(0.0)).alias("dense"), F.coalesce("l", F.lit(0.0)).alias("lexical"))
    from quarryloom.functions.vectors import fuse

    return both.withColumn("combined", fuse(min_max(F.col("dense"), "query"), min_max(F.col("lexical"), "query"), dense_weight, lexical_weight))


def label_candidates(candidates: DataFrame, positives: DataFrame) -> DataFrame:
    """Adds ``label`` = 1 where the candidate is among the query's positives, without regard to letter case and outer blanks."""
    p = positives.select(F.col("query"), F.explode("positives").alias("p")).select("query", F.lower(F.trim("p")).alias("key")).distinct().withColumn("hit", F.lit(1))
    return candidates.withColumn("key", F.lower(F.trim("doc"))).join(p, ["query", "key"], "left").drop("key").withColumn("label", F.coalesce("hit", F.lit(0))).drop("hit")


def retrieval_triplets(labelled: DataFrame) -> DataFrame:
    """``query, positive, negative``: the first relevant and the first irrelevant candidate of queries that have both."""
    out = labelled.groupBy("query").agg(
        F.min_by(F.when(F.col("label") == 1, F.col("doc")), F.when(F.col("label") == 1, F.col("rank"))).alias("positive"),
        F.min_by(F.when(F.col("label") != 1, F.col("doc")), F.when(F.col("label") != 1, F.col("rank"))).alias("negative"))
    return out.where(F.col("positive").isNotNull() & F.col("negative").isNotNull())


def coverage(labelled: DataFrame, wanted: DataFrame) -> DataFrame:
    """Per query of ``wanted`` (``query, positives, min_hits``): candidates, hits, recall, first relevant rank, and what is wrong with it (or null)."""
    got = labelled.groupBy("query").agg(F.count(F.lit(1)).alias("candidates"), F.sum("label").alias("hits"), F.min(F.when(F.col("label") == 1, F.col("rank"))).alias("first_rank"))
    out = wanted.join(got, "query", "left").withColumn("candidates", F.coalesce("candidates", F.lit(0))).withColumn("hits", F.coalesce("hits", F.lit(0)))
    n = F.size(F.coalesce("positives", F.array().cast("array<string>")))
    issue = F.when(F.col("hits") < F.col("min_hits"), "too few positives").when(F.col("candidates") - F.col("hits") < 1, "no negative")
    return out.select("query", "candidates", "hits", F.try_divide(F.col("hits").cast("double"), n.cast("double")).alias("recall"), "first_rank", issue.alias("issue"))


def ranking_metrics(pairs: DataFrame, score: str, ks: tuple[int, ...] = (5, 10, 20), group: str = "difficulty", query: str = "query_id") -> DataFrame:
    """Per ``group``: queries, pairs, top1, pair_accuracy, mrr, recall@k and ndcg@k of one score column.

    Queries without both a relevant and an irrelevant candidate take no part. Null scores rank last, ties by candidate.
    """
    s = F.coalesce(F.col(score).cast("double"), F.lit(float("-inf")))
    w = Window.partitionBy(group, query)
    base = pairs.select(group, query, "candidate_id", F.col("label").cast("int").alias("label"), s.alias("s"))
    ranked = base.withColumn("r", F.row_number().over(w.orderBy(F.desc("s"), "candidate_id"))).withColumn("ideal", F.row_number().over(w.orderBy(F.desc("label"), "candidate_id")))
    rel = F.col("label") > 0
    gain = lambda rank, k: F.sum(F.when(F.col(rank) <= k, F.col("label") / F.log2(F.col(rank) + 1.0)).otherwise(0.0))
    per = ranked.groupBy(group, query).agg(
        F.count(F.lit(1)).alias("pairs"), F.sum("label").alias("npos"), F.max(F.when(rel, F.col("s"))).alias("best"), F.max(F.when(~rel, F.col("s"))).alias("worst"),
        F.min(F.when(rel, F.col("r"))).alias("first"), *[F.sum(F.when(F.col("r") <= k, F.col("label")).otherwise(0)).alias(f"h{k}") for k in ks],
        *[gain("r", k).alias(f"d{k}") for k in ks], *[gain("ideal", k).alias(f"i{k}") for k in ks])
    per = per.where((F.col("npos") > 0) & (F.col("pairs") > F.col("npos")))
    return per.groupBy(group).agg(
        F.count(F.lit(1)).alias("queries"), F.sum("pairs").alias("pairs"), F.avg((F.col("first") == 1).cast("double")).alias("top1"),
        F.avg((F.col("best") > F.col("worst")).cast("double")).alias("pair_accuracy"), F.avg(1.0 / F.col("first")).alias("mrr"),
        *[F.avg(F.col(f"h{k}") / F.col("npos")).alias(f"recall_{k}") for k in ks], *[F.avg(F.coalesce(F.try_divide(F.col(f"d{k}"), F.col(f"i{k}")), F.lit(0.0))).alias(f"ndcg_{k}") for k in ks])
