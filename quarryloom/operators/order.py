"""Operators on a global order, without a single-partition window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarryloom.runtime import cut, spread


def _ranged(df: DataFrame, order: list[str]) -> DataFrame:
    """Rows range-partitioned and sorted by ``order``, with the number of their range; cut, so that the ranges stay as they are."""
    parts = spread(df, df.count())
    return cut(df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id()))


def enumerate_rows(df: DataFrame, order: list[str], name: str = "row") -> DataFrame:
    """Numbers rows from 1 in a global order: numbers within ranges, plus the rows of all ranges before."""
    base = _ranged(df, order)
    counts = base.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))  # a row per range
    before = counts.select("__part", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    within = base.withColumn("__rn", F.row_number().over(Window.partitionBy("__part").orderBy(*order)))
    return within.join(before, "__part").withColumn(name, (F.col("__rn") + F.col("__before")).cast("bigint")).select(*df.columns, name)


def link_prev_next(chunks: DataFrame, scope: str = "file") -> DataFrame:
    """Adds ``prev`` and ``next`` ids by (pos, id), within each file or across the whole corpus.

    Both ways rows are range-partitioned, so that no task holds a file; within files, links across a change of
    ``filename`` are nulled.
    """
    order = ["pos", "id"] if scope != "file" else ["filename", "pos", "id"]
    base = _ranged(chunks, order)
    w = Window.partitionBy("__part").orderBy(*order)
    own = F.struct("id", *(["filename"] if scope == "file" else []))
    key = F.struct(*order)
    ends = base.groupBy("__part").agg(F.min_by(own, key).alias("__first"), F.max_by(own, key).alias("__last"))  # a row per range
    o = Window.orderBy("__part")
    ends = ends.select("__part", F.lag("__last").over(o).alias("__prev"), F.lead("__first").over(o).alias("__next"))
    out = base.withColumn("__p", F.lag(own).over(w)).withColumn("__n", F.lead(own).over(w)).join(ends, "__part")
    links = []
    for name, near, far in (("prev", "__p", "__prev"), ("next", "__n", "__next")):
        link = F.coalesce(near, far)
        links.append((F.when(link["filename"].eqNullSafe(F.col("filename")), link["id"]) if scope == "file" else link["id"]).alias(name))
    return out.select(*chunks.columns, *links)
