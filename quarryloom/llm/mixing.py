"""Problem 9: mixing sources to target weights with hash-random order, distributed prefix sums and exact cuts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarryloom.runtime import cut

#: Ranges of the hash key per source; each range's token sum is one row of the prefix-sum table.
KEY_RANGES = 4096


def _count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = [len(t.split()) if t else 0 for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("src"), pa.array(n, pa.int64())], ["doc_id", "src", "tokens"])


def sized_documents(documents: DataFrame, seed: int = 0) -> DataFrame:
    """``doc_id, src, tokens, key, bucket`` for documents with a source, trimmed and lower-cased.

    Null text has 0 tokens. ``key`` is the first 60 bits of the MD5 of ``doc_id`` and ``seed``; ``bucket`` its
    equal-width range, so that ordering by (bucket, key) within a source is a range sort that needs no sampling.
    """
    src = F.lower(F.trim("source"))
    docs = documents.select("doc_id", "text", src.alias("src")).where(F.col("src").isNotNull() & (F.col("src") != ""))
    counted = docs.mapInArrow(_count_tokens, f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, src string, tokens bigint")
    digest = F.md5(F.concat_ws(":", F.col("doc_id").cast("string"), F.lit(str(seed))))
    return counted.withColumn("key", F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")).withColumn("bucket", F.shiftright("key", 60 - (KEY_RANGES.bit_length() - 1)))


def source_budgets(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Per target source: ``src, target_share, max_repeats, tokens, docs, wanted, repeats``.

    Targets' sources are trimmed and lower-cased too; one stated twice counts with its summed share and greatest
    ``max_repeats``. ``wanted`` = share x tokens of all documents with a source. ``repeats`` = least whole number of
    passes that reaches ``wanted``, at most ``max_repeats`` (null counts as 1); 0 for a source without tokens.
    """
    have = sized.groupBy("src").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    total = have.agg(F.sum("tokens").alias("total"))
    t = targets.groupBy(F.lower(F.trim("source")).alias("src")).agg(
        F.sum(F.coalesce("target_share", F.lit(0.0))).alias("target_share"), F.greatest(F.coalesce(F.max("max_repeats"), F.lit(1)), F.lit(0)).alias("max_repeats"))
    t = t.where(F.col("src").isNotNull() & (F.col("src") != ""))
    joined = t.join(have, "src", "left").crossJoin(F.broadcast(total)).select(
        "src", "target_share", "max_repeats", F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("docs", F.lit(0)).alias("docs"),
        (F.col("target_share") * F.coalesce("total", F.lit(0))).alias("wanted"))
    passes = F.ceil(F.try_divide(F.col("wanted"), F.col("tokens")) - 1e-9)
    return joined.withColumn("repeats", F.when(F.col("tokens") > 0, F.least(F.col("max_repeats").cast("bigint"), passes)).otherwise(0).cast("int"))


def mix_sources(documents: DataFrame, targets: DataFrame, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """``(mix, report)``.

    ``mix``: ``doc_id, source, tokens, copies``, how often each document is in the mix. All passes but the last take
    the whole source; the last takes documents in hash order until the source's budget is reached, so a source
    overshoots by less than one document. ``report``: per source ``target_share, docs, tokens, wanted, repeats,
    mixed_tokens, actual_share``.

    The prefix sums are distributed: token sums per (source, key range) first, of which there are at most
    ``KEY_RANGES`` a source; only the one range in which a source's budget ends is then summed row by row. No task
    sees more of a hot source than one range of it, and no side of a join is broadcast without a look at its size.
    """
    sized = cut(sized_documents(documents, seed))
    budgets = source_budgets(sized, targets)
    sums = sized.groupBy("src", "bucket").agg(F.sum("tokens").alias("sum_tokens"))
    before = F.sum("sum_tokens").over(Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    capacity = F.least(F.col("wanted"), F.col("repeats") * F.col("tokens").cast("double"))
    plan = sums.withColumn("before", F.coalesce(before, F.lit(0))).join(
        budgets.where("repeats > 0").select("src", "repeats", (capacity - (F.col("repeats") - 1) * F.col("tokens")).alias("rest")), "src")
    plan = plan.select("src", "bucket", "repeats", (F.col("rest") - F.col("before")).alias("left"), "sum_tokens")
    rows = sized.join(plan, ["src", "bucket"])
    #: A range that the budget covers, or that lies behind it, needs no order; that of the cut does.
    whole = rows.where((F.col("left") >= F.col("sum_tokens")) | (F.col("left") <= 0)).withColumn("copies", F.col("repeats") - F.when(F.col("left") <= 0, 1).otherwise(0))
    prefix = F.coalesce(F.sum("tokens").over(Window.partitionBy("src", "bucket").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut_range = rows.where((F.col("left") < F.col("sum_tokens")) & (F.col("left") > 0)).withColumn("prefix", prefix)
    cut_range = cut_range.withColumn("copies", F.col("repeats") - F.when(F.col("prefix") < F.col("left"), 0).otherwise(1)).drop("prefix")
    mix = whole.unionByName(cut_range).where("copies > 0").select("doc_id", F.col("src").alias("source"), "tokens", F.col("copies").cast("int").alias("copies"))
    mixed = mix.groupBy(F.col("source").alias("src")).agg(F.sum(F.col("tokens") * F.col("copies")).alias("mixed_tokens"))
    report = budgets.join(mixed, "src", "left").withColumn("mixed_tokens", F.coalesce("mixed_tokens", F.lit(0)))
    all_mixed = F.sum("mixed_tokens").over(Window.partitionBy(F.lit(1)))
    report = report.select(
        F.col("src").alias("source"), "target_share", "max_repeats", "docs", "tokens", "wanted", "repeats", "mixed_tokens",
        F.try_divide(F.col("mixed_tokens").cast("double"), all_mixed).alias("actual_share"))
    return mix, report


def repeated_sources(documents: DataFrame, targets: DataFrame, seed: int = 0) -> DataFrame:
    """``source, repeats``: how often the mix takes its most repeated document of a source, where that is twice or more."""
    mix, _ = mix_sources(documents, targets, seed)
    return mix.groupBy("source").agg(F.max("copies").alias("repeats")).where("repeats >= 2")
