"""Problem 7: the same or near-same records across splits, as an exact prefix-filter bipartite join."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryloom.llm.bits import salted_join
from quarryloom.llm.words import words
from quarryloom.runtime import cut, latest

#: Words that may be misspelt, replaced, added or dropped between two texts that count as the same.
MAX_EDITS = 2
#: Rare words that make up one shingle of the index.
SHINGLE = 3


def _signature(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text in batch.column("text").to_pylist():
            seen: dict[str, int] = {}
            tokens = []
            for w in words(text):
                seen[w] = seen.get(w, 0) + 1
                tokens.append(w if seen[w] == 1 else f"{w}#{seen[w]}")
            out.append(sorted(tokens))
        yield pa.RecordBatch.from_arrays(
            [batch.column("qid"), batch.column("side"), pa.array(out, pa.list_(pa.string()))], ["qid", "side", "tokens"])


def normalise_queries(queries: DataFrame) -> DataFrame:
    """One row per ``query_id``, the latest labelled: ``qid, side, split, source, positives, tokens``.

    ``side`` is "train" or "eval"; ``split`` is trimmed and lower-cased, missing = train; other splits than train,
    test and validation take no part. ``tokens`` is the text's multiset of words as a sorted set of numbered words;
    null or empty text has none and never matches. Positives are trimmed, lower-cased, distinct.
    """
    q = latest(queries.select("query_id", "text", "positives", "split", "source", "labelled_at"), "query_id", "labelled_at")
    split = F.coalesce(F.nullif(F.lower(F.trim("split")), F.lit("")), F.lit("train"))
    q = q.select(
        F.col("query_id").alias("qid"), "text", split.alias("split"), F.lower(F.trim("source")).alias("source"),
        F.array_distinct(F.filter(F.transform(F.coalesce("positives", F.array().cast("array<string>")), lambda p: F.lower(F.trim(p))), lambda p: p.isNotNull() & (p != ""))).alias("positives"),
    ).where(F.col("split").isin("train", "test", "validation")).withColumn("side", F.when(F.col("split") == "train", "train").otherwise("eval"))
    tokens = q.select("qid", "text", "side").mapInArrow(_signature, "qid string, side string, tokens array<string>")
    return q.drop("text", "side").join(tokens, "qid").where(F.size("tokens") > 0)


def text_classes(normalised: DataFrame) -> DataFrame:
    """Distinct word multisets with their class id and the sides they occur on: ``cls, tokens, in_train, in_eval``."""
    return normalised.withColumn("cls", F.xxhash64("tokens")).groupBy("cls").agg(
        F.first("tokens").alias("tokens"), F.bool_or(F.col("side") == "train").alias("in_train"), F.bool_or(F.col("side") == "eval").alias("in_eval"))


def _meetings(ranked: DataFrame, size: int, max_edits: int) -> DataFrame:
    """Pairs that share a shingle of ``size`` words among their ``max_edits + size`` rarest words: ``eval_cls, train_cls``."""
    first = F.slice("ranked", 1, max_edits + size)
    keys = F.transform(first, lambda w: F.array(w))
    for _ in range(size - 1):  # grow combinations in order
        keys = F.flatten(F.transform(keys, lambda k: F.transform(F.slice(first, F.array_position(first, F.element_at(k, -1)).cast("int") + 1, F.lit(max_edits + size)), lambda w: F.concat(k, F.array(w)))))
    keyed = ranked.where(F.size("ranked") >= size).select("cls", "in_train", "in_eval", F.size("ranked").alias("len"), F.explode(F.transform(keys, lambda k: F.xxhash64(k))).alias("key"))
    e = keyed.where("in_eval").select("key", F.col("cls").alias("eval_cls"), F.col("len").alias("elen"))
    t = keyed.where("in_train").select("key", F.col("cls").alias("train_cls"), F.col("len").alias("tlen"))
    met = e.join(t, "key").where(F.abs(F.col("elen") - F.col("tlen")) <= max_edits)
    longest = F.greatest("elen", "tlen")
    met = met.where(longest >= max_edits + size) if size > 1 else met.where(longest < max_edits + SHINGLE)
    return met.select("eval_cls", "train_cls").distinct()


def class_pairs(classes: DataFrame, max_edits: int = MAX_EDITS) -> DataFrame:
    """All pairs (``eval_cls``, ``train_cls``) whose words differ by at most ``max_edits`` words, with ``edits``.

    Two multisets within e edits share all but e words of either. So among the e+k rarest words of each (in one global
    order, rarest first) at least k are common, and they share one of the shingles of k words that those prefixes
    hold: only these are indexed and probed, with a length filter, before the words themselves are compared. Pairs of
    texts too short for k common words meet by single words. Exact for pairs with a word in common; no cap on partners.
    Texts of at most e words that have none are within e edits too: ``_short_pairs`` finds those that share a positive.
    """
    words_of = classes.select("cls", F.explode("tokens").alias("token"))
    df = words_of.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    ranked = salted_join(words_of, df, ["token"], "cls").groupBy("cls").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("ranked"))
    ranked = cut(classes.select("cls", "in_train", "in_eval").join(ranked.select("cls", F.col("ranked.token").alias("ranked")), "cls"))
    short = ranked.where(F.size("ranked") < max_edits + SHINGLE)
    met = _meetings(ranked, SHINGLE, max_edits).unionByName(_meetings(short, 1, max_edits))
    a = ranked.select(F.col("cls").alias("eval_cls"), F.col("ranked").alias("etok"))
    b = ranked.select(F.col("cls").alias("train_cls"), F.col("ranked").alias("ttok"))
    shared = F.size(F.array_intersect("etok", "ttok"))
    return met.join(a, "eval_cls").join(b, "train_cls").select(
        "eval_cls", "train_cls", (F.greatest(F.size("etok"), F.size("ttok")) - shared).alias("edits")).where(F.col("edits") <= max_edits)


def _short_pairs(normalised: DataFrame, max_edits: int) -> DataFrame:
    """Pairs of texts of at most ``max_edits`` words that share a positive, as in ``class_pairs``: all words may be replaced."""
    short = normalised.where(F.size("tokens") <= max_edits).select("side", F.col("cls"), "tokens", F.explode("positives").alias("positive"))
    e = short.where("side = 'eval'").select("positive", F.col("cls").alias("eval_cls"), F.col("tokens").alias("etok")).distinct()
    t = short.where("side = 'train'").select("positive", F.col("cls").alias("train_cls"), F.col("tokens").alias("ttok")).distinct()
    shared = F.size(F.array_intersect("etok", "ttok"))
    return e.join(t, "positive").select("eval_cls", "train_cls", (F.greatest(F.size("etok"), F.size("ttok")) - shared).alias("edits"))


def cross_split_overlaps(queries: DataFrame, max_edits: int = MAX_EDITS) -> tuple[DataFrame, DataFrame]:
    """``(members, links)``: each query with its class (``qid, side, split, source, positives, cls``), and the class pairs.

    Together they hold every cross-split overlap without expanding groups of equal texts into pairs.
    """
    normalised = cut(normalise_queries(queries)).withColumn("cls", F.xxhash64("tokens"))
    links = class_pairs(text_classes(normalised), max_edits).unionByName(_short_pairs(normalised, max_edits)).distinct()
    return normalised.drop("tokens"), links


def overlapping_pairs(queries: DataFrame, max_edits: int = MAX_EDITS) -> DataFrame:
    """Pairs ``query_id_a < query_id_b``, one in train and one in an evaluation split, of near-same texts that share a positive."""
    members, links = cross_split_overlaps(queries, max_edits)
    flat = members.select("qid", "side", "cls", F.explode("positives").alias("positive"))
    e = flat.where("side = 'eval'").select(F.col("qid").alias("eq"), F.col("cls").alias("eval_cls"), "positive")
    t = flat.where("side = 'train'").select(F.col("qid").alias("tq"), F.col("cls").alias("train_cls"), "positive")
    hit = links.join(e, "eval_cls").join(t, ["train_cls", "positive"])
    return hit.select(F.least("eq", "tq").alias("query_id_a"), F.greatest("eq", "tq").alias("query_id_b")).distinct()


def overlap_report(queries: DataFrame, max_edits: int = MAX_EDITS) -> DataFrame:
    """Per evaluation ``split`` and ``source``: queries, and how many recur exactly or nearly in train.

    ``source`` null is reported as such. Empty input gives no rows.
    """
    members, links = cross_split_overlaps(queries, max_edits)
    best = links.groupBy(F.col("eval_cls").alias("cls")).agg(F.min("edits").alias("edits"), F.count(F.lit(1)).alias("train_texts"))
    return members.where("side = 'eval'").join(best, "cls", "left").groupBy("split", "source").agg(
        F.count(F.lit(1)).alias("queries"), F.count_if(F.col("edits") == 0).alias("same_words"),
        F.count_if(F.col("edits") > 0).alias("near_same"), F.coalesce(F.sum("train_texts"), F.lit(0)).alias("links"))
