"""Distribution statistics that need an order, without gathering a group in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarryloom.runtime import cut, spread


def running_counts(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """``*by, value, __c, __less, __n``: the rows of each distinct value, those of lesser values and all of the group.

    Values are range-partitioned over all groups; running counts are those within a range plus the totals of the
    ranges before, of which each group has at most one row a range. Null values are left out.
    """
    counts = cut(df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("__c")))
    ranged = cut(counts.repartitionByRange(spread(counts, counts.count()), *by, value).withColumn("__part", F.spark_partition_id()))
    w = Window.partitionBy(*by)
    parts = ranged.groupBy(*by, "__part").agg(F.sum("__c").alias("__p"))
    parts = parts.select(*[F.col(c).alias(f"__{c}") for c in by], F.col("__part").alias("__at"), F.sum("__p").over(w).alias("__n"),
                         F.coalesce(F.sum("__p").over(w.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    cond = F.col("__part") == F.col("__at")
    for c in by:
        cond = cond & F.col(c).eqNullSafe(F.col(f"__{c}"))
    inside = F.sum("__c").over(Window.partitionBy(*by, "__part").orderBy(value).rowsBetween(Window.unboundedPreceding, -1))
    return ranged.withColumn("__inside", F.coalesce(inside, F.lit(0))).join(parts, cond).select(*by, value, "__c", (F.col("__before") + F.col("__inside")).alias("__less"), "__n")


def trimmed_mean(df: DataFrame, by: list[str], value: str, cut: float) -> DataFrame:
    """Mean per group without the ``floor(n x cut)`` least and greatest values: ``*by, trimmed``. Null values are left out."""
    t = running_counts(df, by, value).withColumn("__drop", F.floor(F.col("__n") * cut))
    kept = F.greatest(F.lit(0), F.least(F.col("__less") + F.col("__c"), F.col("__n") - F.col("__drop")) - F.greatest(F.col("__less"), F.col("__drop")))
    return t.groupBy(*by).agg((F.sum(F.col(value) * kept) / F.sum(kept)).alias("trimmed"))


def quantiles(df: DataFrame, by: list[str], value: str, wanted: dict[str, float]) -> DataFrame:
    """Exact quantiles per group, interpolated between neighbours: ``*by`` and a column for each name of ``wanted``."""
    t = running_counts(df, by, value)
    out = []
    for name, q in wanted.items():
        at = (F.col("__n") - 1) * F.lit(float(q))
        holds = lambda place: (F.col("__less") <= place) & (place < F.col("__less") + F.col("__c"))
        low = F.max(F.when(holds(F.floor(at)), F.col(value).cast("double")))
        high = F.max(F.when(holds(F.ceil(at)), F.col(value).cast("double")))
        share = F.max(at - F.floor(at))
        out.append((low + (high - low) * share).alias(name))
    return t.groupBy(*by).agg(*out)
