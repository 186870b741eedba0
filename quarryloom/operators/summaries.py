"""Summaries: pluggable backends, prefixes on chunks, and the rollup of a page's summaries under its top heading."""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryloom.functions import text as T

Backend = Callable[[pd.Series], pd.Series]
_BACKENDS: dict[str, Backend] = {}


def register_backend(name: str, backend: Backend) -> None:
    """A summary backend maps a series of texts to a series of summaries; models are loaded inside it, on the worker."""
    _BACKENDS[name] = backend


def _first_sentence(texts: pd.Series) -> pd.Series:
    return texts.fillna("").map(lambda t: re.split(r"(?<=[.!?])\s", t.strip(), maxsplit=1)[0])


register_backend("extractive", _first_sentence)


def summarise(chunks: DataFrame, backend: str = "extractive", min_tokens: int = 50) -> DataFrame:
    """Fills ``chunk_summary`` of chunks of at least ``min_tokens`` tokens; others get an empty one. Unknown backends raise."""
    if backend not in _BACKENDS:
        raise ValueError(f"unknown summary backend: {backend}")
    run = _BACKENDS[backend]
    udf = F.pandas_udf(lambda s: run(s), "string")
    rest = [c for c in chunks.columns if c != "chunk_summary"]
    long = T.token_count(F.col("content")) >= min_tokens
    return chunks.select(*rest, F.when(long, udf(F.when(long, F.col("content")))).otherwise("").alias("chunk_summary")).select(*chunks.columns, *([] if "chunk_summary" in chunks.columns else ["chunk_summary"]))


def with_table_summary(chunks: DataFrame) -> DataFrame:
    """Puts a table chunk's summary before its content, unless it is there already."""
    s, c = T.sentinel_to_null(F.col("chunk_summary")), F.coalesce("content", F.lit(""))
    return chunks.withColumn("content", F.when((F.col("chunk_type") == "table") & s.isNotNull() & ~F.ltrim(c).startswith(s), F.concat(s, F.lit("\n"), c)).otherwise(c))


def with_metadata_prefix(chunks: DataFrame, max_tokens: int = 150) -> DataFrame:
    """Puts the heading path before the content of chunks under ``max_tokens`` tokens; applying it twice changes nothing more."""
    c, line = F.coalesce("content", F.lit("")), F.concat(F.lit("Path: "), F.coalesce("concat_header_path", F.lit("")))
    small = T.token_count(c) < max_tokens
    return chunks.withColumn("content", F.when(small & ~c.startswith(line), F.concat(line, F.lit("\r\n"), c)).otherwise(c))


def page_rollup(forest: DataFrame, chunks: DataFrame) -> DataFrame:
    """Per top heading (or file, for chunks without one): ``key, members, tokens, text``.

    ``text`` is the content of the top chunk and a bullet per summary in corpus order. A page's bullets are gathered
    in one row, as the result holds them in one text.
    """
    keyed = chunks.join(forest.select("id", "root"), "id", "left").withColumn("key", F.coalesce("root", "filename"))
    summary = T.sentinel_to_null(F.col("chunk_summary"))
    out = keyed.groupBy("key").agg(
        F.count(F.lit(1)).alias("members"), F.sum(T.token_count(F.col("content"))).alias("tokens"),
        F.max(F.when(F.col("id") == F.col("key"), F.col("content"))).alias("top"),
        F.array_sort(F.collect_list(F.when(summary.isNotNull(), F.struct("pos", summary.alias("s"))))).alias("parts"))
    bullets = F.array_join(F.transform("parts", lambda p: F.concat(F.lit("- "), p["s"])), "\n")
    return out.select("key", "members", "tokens", F.concat_ws("\n", "top", bullets).alias("text"))
