"""Event streams: windows, sessions, deduplication, custom state and upserts, each the same function on batch and stream."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
LATE = "10 minutes"


def read_stream(spark: SparkSession, folder: str, files_per_trigger: int = 8) -> DataFrame:
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def _watermarked(events: DataFrame, late: str) -> DataFrame:
    return events.withWatermark("ts", late) if events.isStreaming else events


def tumbling(events: DataFrame, width: str = "1 hour", late: str = LATE) -> DataFrame:
    """Events, users' values per window and type."""
    w = _watermarked(events, late).groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("total"))
    return w.select(F.col("window.start").alias("start"), "event_type", "events", "total")


def sliding(events: DataFrame, width: str = "1 hour", step: str = "15 minutes", late: str = LATE) -> DataFrame:
    w = _watermarked(events, late).groupBy(F.window("ts", width, step)).agg(F.count(F.lit(1)).alias("events"))
    return w.select(F.col("window.start").alias("start"), "events")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = LATE) -> DataFrame:
    w = _watermarked(events, late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count(F.lit(1)).alias("events"))
    return w.select("user_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "events")


def deduplicated(events: DataFrame, late: str = LATE) -> DataFrame:
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"]) if events.isStreaming else events.dropDuplicates(["event_id"])


def running_totals(events: DataFrame, late: str = LATE) -> DataFrame:
    """Per user the events and the sum so far, updated batch by batch: custom state of two numbers a user."""

    def update(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        n, total = state.get if state.exists else (0, 0.0)
        for b in batches:
            n, total = n + len(b), total + float(b["value"].fillna(0).sum())
        state.update((n, total))
        yield pd.DataFrame({"user_id": [key[0]], "events": [n], "total": [total]})

    return events.groupBy("user_id").applyInPandasWithState(update, "user_id bigint, events bigint, total double", "n bigint, total double", "update", "NoTimeout")


BUCKETS = 64


def _latest(spark: SparkSession, target: str, before: int | None = None) -> dict[int, str]:
    """The newest folder of each bucket among the whole versions (below ``before``)."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(target)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return {}
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    out: dict[int, str] = {}
    for v in sorted(int(n[1:]) for n in names if n.startswith("v") and n[1:].isdigit() and (before is None or int(n[1:]) < before)):
        folder = hadoop.Path(f"{target}/v{v}")
        if fs.exists(hadoop.Path(folder, "_SUCCESS")):
            for b in fs.listStatus(folder):
                if b.getPath().getName().startswith("bucket="):
                    out[int(b.getPath().getName()[7:])] = f"{target}/v{v}/{b.getPath().getName()}"
    return out


def read_store(spark: SparkSession, target: str) -> DataFrame:
    """The rows of a store that ``upsert_batches`` keeps: of each bucket its newest version. Raises where there is no store."""
    return spark.read.parquet(*_latest(spark, target).values())


def upsert_batches(target: str, key: str, order: str, buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that merges each batch into a store of Parquet folders ``v<batch>/bucket=<n>``.

    Rows lie in buckets by the hash of their key. A batch reads and writes the buckets of its own keys only; a version
    counts once it is whole, so a lost job leaves the last one, and a batch that comes again writes the same. Read it
    with ``read_store``.
    """
    from quarryloom.sources.writers import upsert

    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch = batch.where(F.col(key).isNotNull())
        touched = {r[0] for r in batch.select(bucket.alias("b")).distinct().collect()}  # at most ``buckets``
        if not touched:
            return
        paths = [p for b, p in _latest(spark, target, number).items() if b in touched]
        old = spark.read.schema(batch.schema).parquet(*paths) if paths else batch.limit(0)
        upsert(old, batch, key, order).withColumn("bucket", bucket).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{target}/v{number}")

    return run
