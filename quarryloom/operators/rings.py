"""Random choice without pools: rows of a scope stand in a ring in hash order, and each anchor takes the first that fits."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarryloom.operators.ranking import hash_order
from quarryloom.runtime import cut

#: Places of the first window behind an anchor, and by how much each next one is wider.
FIRST, WIDER = 8, 8


def ring(rows: DataFrame, scope: str, key: str = "id", seed: int = 0) -> DataFrame:
    """Adds ``rn`` (from 1, in hash order within ``scope``) and ``n``, the rows of the scope.

    Ranks are sums over 4096 ranges of the hash plus ranks within a range, so no task holds a scope.
    """
    hashed = rows.withColumn("__h", hash_order(key, seed=seed)).withColumn("__b", F.conv(F.substring("__h", 1, 3), 16, 10).cast("int"))
    counts = hashed.groupBy(scope, "__b").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(scope)
    before = counts.select(scope, "__b", F.sum("__n").over(w).alias("n"), F.coalesce(F.sum("__n").over(w.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    rank = F.row_number().over(Window.partitionBy(scope, "__b").orderBy("__h", key))
    return hashed.withColumn("__r", rank).join(before, [scope, "__b"]).withColumn("rn", F.col("__before") + F.col("__r")).drop("__h", "__b", "__r", "__before")


def first_fitting(anchors: DataFrame, rows: DataFrame, scope: str, tier: Callable[[str, str], Column], k: int = 1, goal: str | None = None) -> DataFrame:
    """``anchor, negative, tier, off, choice``: per anchor the ``k`` rows of the least tier, and of these the next in the ring.

    ``anchors`` and ``rows`` come from one ``ring``; ``tier(a, c)`` judges the structs of that name, null = doesn't fit.
    An anchor looks through windows of growing width and stops when it has ``k`` rows of the tier ``goal`` names (a
    column of anchors; else 1), so few anchors go far; one without goes round its whole scope, in windows, once.
    """
    slim = [c for c in anchors.columns if c not in ("rn", "n", scope)]
    left = anchors.select(F.col("id").alias("anchor"), F.col(scope).alias("s"), "rn", "n", F.lit(0).cast("bigint").alias("done"), F.struct(*slim).alias("a")).where("n > 1")
    right = rows.select(F.col("id").alias("negative"), F.col(scope).alias("s"), F.col("rn").alias("place"), F.struct(*[c for c in rows.columns if c not in ("rn", "n", scope)]).alias("c"))
    best: DataFrame | None = None
    width = FIRST
    while True:
        until = F.least(F.col("done") + width, F.col("n") - 1)
        asked = left.withColumn("off", F.explode(F.sequence(F.col("done") + 1, until))).withColumn("place", F.pmod(F.col("rn") + F.col("off") - 1, F.col("n")) + 1)
        met = asked.join(right, ["s", "place"]).withColumn("tier", tier("a", "c")).where(F.col("tier").isNotNull()).select("anchor", "negative", "tier", "off")
        if best is not None:
            met = best.unionByName(met)
        choice = F.row_number().over(Window.partitionBy("anchor").orderBy("tier", "off"))
        best = cut(met.withColumn("choice", choice).where(F.col("choice") <= k).drop("choice"))
        want = F.col(f"a.{goal}") if goal else F.lit(1)
        served = best.groupBy("anchor").agg(F.sort_array(F.collect_list("tier")).alias("tiers"))
        left = left.join(served, "anchor", "left").where(~F.coalesce((F.size("tiers") >= k) & (F.element_at("tiers", -1) <= want), F.lit(False))).drop("tiers")
        left = cut(left.withColumn("done", F.col("done") + width).where(F.col("done") < F.col("n") - 1))
        if left.isEmpty():
            return best.withColumn("choice", F.row_number().over(Window.partitionBy("anchor").orderBy("tier", "off")))
        width *= WIDER
