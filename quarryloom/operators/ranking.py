"""Order-dependent operators: first rows of a group, deterministic samples, train and test cuts, pages of a grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_group(df: DataFrame, keys: list[str], order: list[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group. The optimiser keeps ``n`` rows a group per map task (window group limit), so hot groups shrink before the shuffle."""
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("__rn") <= n).drop("__rn")


def hash_order(*cols: str, seed: int = 0) -> Column:
    """A repeatable random order: the hash of the seed and the columns."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))


def sample_rows(df: DataFrame, n: int, key: str, mode: str = "random", order: str = "pos", seed: int = 0) -> DataFrame:
    """``n`` rows: the head in ``order``, or a repeatable uniform sample without replacement."""
    return df.orderBy(order, key).limit(n) if mode == "head" else df.orderBy(hash_order(key, seed=seed), key).limit(n)


def page(df: DataFrame, order: list[str | Column], number: int, size: int = 200) -> DataFrame:
    """One page (from 1) of a sorted grid."""
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def split_rows(df: DataFrame, by: list[str], key: str, share: float = 0.8, seed: int = 0, buckets: int = 256) -> DataFrame:
    """Adds ``split``: the first ``floor(share x n)`` rows of each group in hash order are train, the others test.

    Ranks are not computed over whole groups: rows fall into equal ranges of the hash, range counts are summed up per
    group, and only the range that holds the cut is ordered.
    """
    hashed = df.withColumn("__h", hash_order(key, seed=seed)).withColumn("__b", F.conv(F.substring("__h", 1, 2), 16, 10).cast("int"))
    counts = hashed.groupBy(*by, "__b").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*by)
    plan = counts.withColumn("__cut", F.floor(F.sum("__n").over(w) * share)).withColumn(
        "__left", F.col("__cut") - F.coalesce(F.sum("__n").over(w.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select(*by, "__b", "__n", "__left")
    plan = plan.select(*[F.col(c).alias(f"__p_{c}") for c in by], F.col("__b").alias("__pb"), "__n", "__left")
    cond = F.col("__b") == F.col("__pb")
    for c in by:
        cond = cond & F.col(c).eqNullSafe(F.col(f"__p_{c}"))
    joined = hashed.join(plan, cond).drop("__pb", *[f"__p_{c}" for c in by])
    sure = joined.where((F.col("__left") <= 0) | (F.col("__left") >= F.col("__n"))).withColumn("split", F.when(F.col("__left") <= 0, "test").otherwise("train"))
    rank = F.row_number().over(Window.partitionBy(*by, "__b").orderBy("__h", key))
    edge = joined.where((F.col("__left") > 0) & (F.col("__left") < F.col("__n"))).withColumn("split", F.when(rank <= F.col("__left"), "train").otherwise("test"))
    return sure.unionByName(edge).drop("__h", "__b", "__n", "__left")
