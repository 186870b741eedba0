"""Positive pairs, negatives by difficulty, balances and triplets from chunks.

Chunks come as ``id, pos, filename, parent_id, category, path (segments), heading, words``. All choices "at random" are
made by hash order, so they repeat. Positive pairs take the first few of a group; negatives are looked for in all of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarryloom.functions import text as T
from quarryloom.operators.ranking import first_per_group, hash_order
from quarryloom.operators.rings import first_fitting, ring
from quarryloom.runtime import cut

EASY_MAX, MEDIUM, HARD_MAX = 0.65, (0.0, 1.0), 1.0


def parent_child(chunks: DataFrame) -> DataFrame:
    c = chunks.select(F.col("id").alias("positive"), F.col("parent_id").alias("anchor"))
    return c.join(chunks.select(F.col("id").alias("anchor")), "anchor").select("anchor", "positive", F.lit("parent_child").alias("pair_type"))


def pairs_within(chunks: DataFrame, key: Column, k: int, pair_type: str) -> DataFrame:
    """Unordered pairs among the first ``k`` chunks (by ``pos``) of each non-null, non-empty key; at most k(k-1)/2 a group."""
    keyed = chunks.select("id", "pos", key.alias("key")).where(F.col("key").isNotNull() & (F.col("key").cast("string") != ""))
    ranked = keyed.withColumn("rn", F.row_number().over(Window.partitionBy("key").orderBy("pos", "id"))).where(F.col("rn") <= k)
    a = ranked.select("key", F.col("id").alias("anchor"), F.col("rn").alias("ra"))
    b = ranked.select("key", F.col("id").alias("positive"), F.col("rn").alias("rb"))
    return a.join(b, "key").where("ra < rb").select("anchor", "positive", F.lit(pair_type).alias("pair_type"))


def positive_pairs(chunks: DataFrame, excluded_types: tuple[str, ...] = ("table",)) -> DataFrame:
    """Bag union of parent-child, sibling, summary-prefix and section pairs without excluded chunk types on either side."""
    c = chunks.where(~F.lower(F.coalesce("chunk_type", F.lit(""))).isin(*excluded_types))
    summary = F.lower(T.sentinel_to_null(F.col("chunk_summary")))
    prefix = F.when(F.size(F.split(summary, " ")) >= 5, F.array_join(F.slice(F.split(summary, " "), 1, 5), " "))
    section = F.when(F.size("path") >= 2, F.array_join(F.slice("path", 1, 2), "/"))
    parts = [parent_child(c), pairs_within(c, F.col("concat_header_path"), 5, "sibling"), pairs_within(c, prefix, 3, "summary"), pairs_within(c, section, 4, "section")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _remainders(counts: DataFrame, ratios: dict[str, float], key: str) -> DataFrame:
    """Largest-remainder targets from ``key, n``: as many rows in all as the scarcest key allows at the ratios."""
    total = sum(ratios.values())
    norm = {k: v / total for k, v in ratios.items() if v > 0}
    spark = counts.sparkSession
    r = spark.createDataFrame(sorted(norm.items()), f"{key} string, ratio double")
    t = F.broadcast(r).join(counts, key, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    everything = Window.partitionBy(F.lit(1))
    t = t.withColumn("all", F.floor(F.min(F.col("n") / F.col("ratio")).over(everything) + 1e-9))
    t = t.withColumn("exact", F.col("all") * F.col("ratio")).withColumn("base", F.floor(F.col("exact") + 1e-9))
    t = t.withColumn("short", F.col("all") - F.sum("base").over(everything))
    order = F.row_number().over(everything.orderBy(F.desc(F.round(F.col("exact") - F.col("base"), 9)), F.desc(key)))
    return t.select(key, (F.col("base") + F.when(order <= F.col("short"), 1).otherwise(0)).cast("bigint").alias("target"))


def balance(rows: DataFrame, key: str, ratios: dict[str, float], order: list[str], seed: int = 0) -> DataFrame:
    """Rows cut to largest-remainder shares of ``key``; keys outside ``ratios`` go. If a wanted key has no rows, all rows stay.

    Per key only the rows whose hash falls in the range that holds the target are ordered (see ``split_rows``).
    """
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    targets = _remainders(counts, ratios, key)
    hashed = rows.withColumn("__h", hash_order(*order, seed=seed)).withColumn("__b", F.conv(F.substring("__h", 1, 2), 16, 10).cast("int"))
    sums = hashed.groupBy(key, "__b").agg(F.count(F.lit(1)).alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy(key).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    empty = targets.agg(F.min("target").alias("least"))
    plan = sums.withColumn("__before", before).join(targets, key, "left").crossJoin(empty).withColumn(
        "__left", F.when(F.col("least") == 0, F.col("__n")).otherwise(F.coalesce("target", F.lit(0)) - F.col("__before"))).select(key, "__b", "__n", "__left")
    joined = hashed.join(plan, [key, "__b"])
    whole = joined.where(F.col("__left") >= F.col("__n"))
    rank = F.row_number().over(Window.partitionBy(key, "__b").orderBy("__h", *order))
    edge = joined.where((F.col("__left") > 0) & (F.col("__left") < F.col("__n"))).withColumn("__rn", rank).where(F.col("__rn") <= F.col("__left")).drop("__rn")
    return whole.unionByName(edge).drop("__h", "__b", "__n", "__left")


#: Thresholds of the strategies.
MEDIUM_PATH, MEDIUM_FILE_PATH, MEDIUM_WORDS = (0.2, 0.5), 0.3, (0.15, 0.4)
HARD_PATH, HARD_WORDS, HARD_TOP = 0.35, 0.20, 20
#: The same for pairs of a reranker.
RERANK_PATH, RERANK_WORDS, RERANK_TOP = 0.5, 0.4, 5
CROSS_SHARE, SAME_SHARE = 0.3, 0.7
TABLES_PER_HEADING = 3
#: Negatives chosen per anchor, so that one is left when the positive and an easier negative are excluded.
CHOICES = 3
#: Anchors of one scope that one task compares with the scope's chunks.
ANCHORS_PER_TASK = 2_000


def easy_negatives(anchors: DataFrame, chunks: DataFrame, seed: int = 0) -> DataFrame:
    """``anchor, negative, tier, choice``: chunks under another top heading, by hash order, at most ``CHOICES`` an anchor.

    Tier 1 also lies in another category, 2 in another file, 3 only under another heading. Which tier an anchor can get
    follows from counts, so none looks further than it must. An anchor has no row only if all chunks share its heading.
    """
    c = chunks.select("id", "category", "filename", "top", F.lit(0).alias("all"))
    r = ring(c, "all", seed=seed)
    for name, keys in (("top", ["top"]), ("category", ["category"]), ("filename", ["filename"]), ("category_top", ["category", "top"]), ("filename_top", ["filename", "top"])):
        n = r.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.count(F.lit(1)).alias(f"n_{name}"))
        cond = F.lit(True)
        for k in keys:
            cond = cond & F.col(k).eqNullSafe(F.col(f"__{k}"))
        r = r.join(n, cond).drop(*[f"__{k}" for k in keys])
    total = F.col("n")
    goal = F.when(total - F.col("n_category") - F.col("n_top") + F.col("n_category_top") > 0, 1).when(
        total - F.col("n_filename") - F.col("n_top") + F.col("n_filename_top") > 0, 2).when(total - F.col("n_top") > 0, 3)
    r = cut(r.withColumn("goal", goal).select("id", "category", "filename", "top", "all", "rn", "n", "goal"))

    def tier(a: str, c: str) -> Column:
        differs = lambda f: ~F.col(f"{a}.{f}").eqNullSafe(F.col(f"{c}.{f}"))
        return F.when(differs("top"), F.when(differs("category"), 1).when(differs("filename"), 2).otherwise(3))

    mine = r.where("goal IS NOT NULL").join(anchors.select("id").distinct(), "id", "left_semi")
    return first_fitting(mine, r.drop("goal"), "all", tier, k=1, goal="goal").select("anchor", "negative", "tier", "choice")


def _any_other(found: DataFrame, anchors: DataFrame, chunks: DataFrame, tier: int, seed: int) -> DataFrame:
    """``anchor, negative, tier, choice`` for the anchors that ``found`` doesn't have: the next chunks of all in hash order."""
    left = anchors.select("id").distinct().join(found.select(F.col("anchor").alias("id")).distinct(), "id", "left_anti")
    r = ring(chunks.select("id", F.lit(0).alias("all")), "all", seed=seed)
    return first_fitting(r.join(left, "id", "left_semi"), r, "all", lambda a, c: F.lit(1), k=CHOICES).select("anchor", "negative", F.lit(tier).alias("tier"), "choice")


def _leaf(path: Column, heading: Column) -> Column:
    return F.coalesce(F.lower(T.blank_to_null(heading)), F.try_element_at(path, F.lit(-1)), F.lit(""))


def medium_negatives(anchors: DataFrame, chunks: DataFrame, seed: int = 0) -> DataFrame:
    """``anchor, negative, tier, choice``: chunks under the same top heading, in hash order, at most ``CHOICES`` an anchor.

    Tier 1: paths alike by 0.2 to 0.5, or by less than 0.3 within one file; 3: first words alike by 0.15 to 0.4; 5: any.
    Each first with another leaf heading; 2, 4 and 6 are the same with the anchor's own. Of the tables under one heading
    only ``TABLES_PER_HEADING`` take part. 7: any chunk, for anchors that have none under their heading.
    """
    c = chunks.select("id", "filename", "top", "path", "words", _leaf(F.col("path"), F.col("heading")).alias("leaf"), F.coalesce(F.lower("chunk_type"), F.lit("")).alias("kind"))
    tables = first_per_group(c.where("kind = 'table'").select("top", "id").withColumn("h", hash_order("id", seed=seed)), ["top"], ["h", "id"], TABLES_PER_HEADING).select("id", F.lit(True).alias("listed"))
    c = c.join(tables, "id", "left").withColumn("allowed", (F.col("kind") != "table") | F.coalesce("listed", F.lit(False))).drop("kind", "listed")
    r = cut(ring(c, "top", seed=seed))

    def tier(a: str, c: str) -> Column:
        p = F.when((F.size(f"{a}.path") > 0) & (F.size(f"{c}.path") > 0), T.jaccard(F.col(f"{a}.path"), F.col(f"{c}.path")))
        w = F.when((F.size(f"{a}.words") > 0) & (F.size(f"{c}.words") > 0), T.jaccard(F.col(f"{a}.words"), F.col(f"{c}.words")))
        by_path = p.between(*MEDIUM_PATH) | ((p < MEDIUM_FILE_PATH) & F.col(f"{a}.filename").eqNullSafe(F.col(f"{c}.filename")))
        same = (F.col(f"{a}.leaf") == F.col(f"{c}.leaf")).cast("int")
        return F.when(F.col(f"{c}.allowed"), F.when(F.coalesce(by_path, F.lit(False)), 1).when(F.coalesce(w.between(*MEDIUM_WORDS), F.lit(False)), 3).otherwise(5) + same)

    mine = r.join(anchors.select("id").distinct(), "id", "left_semi")
    found = cut(first_fitting(mine, r, "top", tier, k=CHOICES).select("anchor", "negative", "tier", "choice"))
    return found.unionByName(_any_other(found, anchors, chunks, 7, seed))


def hard_negatives(anchors: DataFrame, chunks: DataFrame, seed: int = 0, path_least: float = HARD_PATH, words_least: float = HARD_WORDS, top: int = HARD_TOP) -> DataFrame:
    """``anchor, negative, tier, score, choice``: the most confusable chunks under the same top heading, at most ``CHOICES`` an anchor.

    Tier 1: paths alike by ``path_least`` or first words by ``words_least``, of which the ``top`` best by 0.6 path + 0.4
    words stand for a choice by hash; 2: of the same category, 3: any, 4: any chunk at all, for anchors that have none
    under their heading. For ``CROSS_SHARE`` of all anchors, evenly spread in hash order,
    those of another category come first. Every anchor is compared with all chunks of its scope, in blocks of
    ``ANCHORS_PER_TASK`` anchors: exact, at a cost that grows with the square of a scope, and never in one task.
    """
    c = chunks.select("id", "category", "top", "path", "words")
    ranked = ring(c.select("id", F.lit(0).alias("all")), "all", seed=seed).select("id", "rn")
    need = F.floor(F.col("rn") * CROSS_SHARE) > F.floor((F.col("rn") - 1) * CROSS_SHARE)
    blocks = F.greatest(F.ceil(F.col("size") / ANCHORS_PER_TASK), F.lit(1)).cast("int")
    sizes = c.groupBy("top").agg(F.count(F.lit(1)).alias("size"))
    a = c.join(anchors.select("id").distinct(), "id", "left_semi").join(ranked, "id").join(sizes, "top").select(
        F.col("id").alias("anchor"), "top", F.pmod(F.xxhash64("id"), blocks).cast("int").alias("block"), F.col("path").alias("apath"), F.col("words").alias("awords"), F.col("category").alias("acategory"), need.alias("need"))
    b = c.join(sizes, "top").select(F.col("id").alias("negative"), "top", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), "path", "words", "category")
    p = F.when((F.size("apath") > 0) & (F.size("path") > 0), T.jaccard(F.col("apath"), F.col("path"))).otherwise(0.0)
    w = F.when((F.size("awords") > 0) & (F.size("words") > 0), T.jaccard(F.col("awords"), F.col("words"))).otherwise(0.0)
    met = a.join(b, ["top", "block"]).where("anchor <> negative").withColumn("p", p).withColumn("w", w)
    met = met.withColumn("cross", F.col("need") & (F.col("category") != F.col("acategory"))).withColumn(
        "tier", F.when((F.col("p") >= path_least) | (F.col("w") >= words_least), 1).when(F.col("category") == F.col("acategory"), 2).otherwise(3))
    met = met.withColumn("score", F.when(F.col("tier") == 1, F.round(0.6 * F.col("p") + 0.4 * F.col("w"), 9)).otherwise(0.0)).select("anchor", "negative", "tier", "score", "cross")
    best = first_per_group(met, ["anchor"], ["tier", F.desc("cross"), F.desc("score"), "negative"], top)
    order = hash_order("anchor", "negative", seed=seed)
    choice = F.row_number().over(Window.partitionBy("anchor").orderBy("tier", F.desc("cross"), order))
    found = cut(best.withColumn("choice", choice).where(F.col("choice") <= CHOICES).select("anchor", "negative", "tier", "score", "choice"))
    return found.unionByName(_any_other(found, anchors, chunks, 4, seed).withColumn("score", F.lit(0.0)))


def negative_pairs(pairs: DataFrame, chunks: DataFrame, ratio: int = 2, seed: int = 0) -> DataFrame:
    """``anchor, positive, negative, pair_type``: ``ratio`` negatives for each positive pair, of another category where there
    is one, else of another file, else any other chunk; the next that fit in the ring, never the positive.
    """
    r = cut(ring(chunks.select("id", "category", "filename", F.lit(0).alias("all")), "all", seed=seed))
    kinds = r.agg(F.min("category").alias("c1"), F.max("category").alias("c2"), F.min("filename").alias("f1"), F.max("filename").alias("f2"))
    r = cut(r.crossJoin(kinds).withColumn("goal", F.when(F.col("c1") < F.col("c2"), 1).when(F.col("f1") < F.col("f2"), 2).otherwise(3)).drop("c1", "c2", "f1", "f2"))

    def tier(a: str, c: str) -> Column:
        differs = lambda f: ~F.col(f"{a}.{f}").eqNullSafe(F.col(f"{c}.{f}"))
        return F.when(differs("category"), 1).when(differs("filename"), 2).otherwise(3)

    mine = r.join(pairs.select(F.col("anchor").alias("id")).distinct(), "id", "left_semi")
    found = first_fitting(mine, r.drop("goal"), "all", tier, k=ratio + 1, goal="goal")
    met = pairs.select("anchor", "positive", "pair_type").distinct().join(found, "anchor").where("negative <> positive")
    rank = F.row_number().over(Window.partitionBy("anchor", "positive", "pair_type").orderBy("choice"))
    kind = F.element_at(F.array(F.lit("cross_domain"), F.lit("diff_file"), F.lit("random")), F.col("tier"))
    return met.withColumn("rank", rank).where(F.col("rank") <= ratio).select("anchor", "positive", "negative", F.concat_ws("_", F.lit("negative"), kind, "pair_type").alias("pair_type"))


def same_source_mix(pairs: DataFrame, chunks: DataFrame, share: float = SAME_SHARE) -> DataFrame:
    """Per anchor category: pairs, those within the category and across, how many of each fill the target share, and how
    many of the rest are taken back so that none is lost (the feature reorders pairs, it drops none)."""
    c = chunks.select("id", "category")
    named = pairs.join(c.select(F.col("id").alias("anchor"), "category"), "anchor").join(c.select(F.col("id").alias("positive"), F.col("category").alias("other")), "positive")
    per = named.groupBy("category").agg(F.count(F.lit(1)).alias("pairs"), F.count_if(F.col("category") == F.col("other")).alias("same"))
    per = per.withColumn("cross", F.col("pairs") - F.col("same")).withColumn("same_taken", F.least("same", F.floor(F.col("pairs") * share)))
    per = per.withColumn("cross_taken", F.least("cross", F.col("pairs") - F.col("same_taken")))
    return per.withColumn("backfilled", F.col("pairs") - F.col("same_taken") - F.col("cross_taken"))


def triplets(pairs: DataFrame, negatives: DataFrame, vectors: DataFrame, difficulty: str, low: float, high: float) -> DataFrame:
    """``anchor, positive, negative, pair_type, difficulty, cosine, kept``: the anchor's first choice that isn't the positive; the cosine gate keeps missing vectors, as they can't be judged."""
    from quarryloom.functions import vectors as V

    v = vectors.select("id", "embedding").where(V.valid(F.col("embedding"), 48))
    t = pairs.join(negatives.select("anchor", "negative", "choice"), "anchor").where("negative <> positive")
    t = t.withColumn("__c", F.min("choice").over(Window.partitionBy("anchor", "positive", "pair_type"))).where("choice = __c").drop("choice", "__c").distinct()
    t = t.join(v.select(F.col("id").alias("anchor"), F.col("embedding").alias("va")), "anchor", "left").join(v.select(F.col("id").alias("negative"), F.col("embedding").alias("vn")), "negative", "left")
    cos = V.cosine(F.col("va"), F.col("vn"))
    return t.select("anchor", "positive", "negative", "pair_type", F.lit(difficulty).alias("difficulty"), cos.alias("cosine")).withColumn("kept", F.coalesce(F.round("cosine", 9).between(low, high), F.lit(True)))


def cross_encoder_pairs(triplet_rows: DataFrame) -> DataFrame:
    """Two labelled rows per triplet: the positive with 1, the negative with 0."""
    both = F.explode(F.array(F.struct(F.col("positive").alias("candidate"), F.lit(1).alias("label")), F.struct(F.col("negative").alias("candidate"), F.lit(0).alias("label"))))
    return triplet_rows.select("anchor", "difficulty", "pair_type", both.alias("b")).select(F.col("anchor").alias("query"), "difficulty", "pair_type", "b.candidate", "b.label")


def export_statistics(triplet_rows: DataFrame) -> DataFrame:
    """Per difficulty: rows, kept, removed and the histogram of pair types."""
    per = triplet_rows.groupBy("difficulty", "pair_type").agg(F.count(F.lit(1)).alias("n"), F.count_if("kept").alias("k"))
    return per.groupBy("difficulty").agg(F.sum("n").alias("total"), F.sum("k").alias("kept"), (F.sum("n") - F.sum("k")).alias("removed"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("pair_type", "n")))).alias("pair_types"))
