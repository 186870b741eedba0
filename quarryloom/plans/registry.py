"""Where the core's queries and their DuckDB statements are kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarryloom.runtime import latest, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: Chunks with each id once, as its latest delivery.
CHUNKS = "(SELECT DISTINCT ON (id) * FROM chunks WHERE id IS NOT NULL ORDER BY id, loaded_at DESC)"
LABELLED = "(SELECT DISTINCT ON (query_id) * FROM queries WHERE query_id IS NOT NULL ORDER BY query_id, labelled_at DESC NULLS LAST, text)"


def query(name: str, sql: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = sql
        return f

    return register


def chunks(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    """The named columns (and id) of chunks, each id once."""
    keep = list(dict.fromkeys(["id", *cols, "loaded_at"]))
    out = latest(read_table(spark, d, "chunks").select(*keep), "id", "loaded_at")
    return out if "loaded_at" in cols else out.drop("loaded_at")


def labelled(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    keep = list(dict.fromkeys(["query_id", *cols, "labelled_at"]))
    return latest(read_table(spark, d, "queries").select(*keep), "query_id", "labelled_at").drop("labelled_at")
