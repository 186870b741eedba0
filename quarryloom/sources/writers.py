"""Writers, tables and upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarryloom.functions.text import format_seconds, format_value
from quarryloom.functions.vectors import valid
from quarryloom.sources.readers import CHUNK_SCHEMA, VECTOR_COLUMNS


def ordered_chunks(chunks: DataFrame, metadata: dict[str, str], prov_id: str, vectors: bool = False) -> DataFrame:
    """Chunks in the fixed field order, stamped with title, author, category, description and provenance; vectors go unless wanted."""
    stamps = {k: F.lit(metadata.get(k)) for k in ("title", "author", "category", "description")} | {"prov_id": F.lit(prov_id)}
    df = chunks.withColumns(stamps)
    names = [c for c in CHUNK_SCHEMA.names if vectors or c not in VECTOR_COLUMNS]
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(CHUNK_SCHEMA[c].dataType).alias(c) for c in names])


def write_chunks(chunks: DataFrame, path: str, metadata: dict[str, str], prov_id: str) -> None:
    ordered_chunks(chunks, metadata, prov_id).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_token_report(chunks: DataFrame, path: str) -> None:
    chunks.select("header_level", "heading", "token_count").write.mode("overwrite").option("header", True).csv(path)


def token_report(sections: DataFrame) -> DataFrame:
    """``row, level, heading, tokens, cumulative`` and a last row ``Total``."""
    total = sections.agg(F.lit(None).cast("bigint").alias("row"), F.lit(None).cast("int").alias("level"), F.lit("Total").alias("heading"), F.sum("tokens").alias("tokens"), F.lit(None).cast("bigint").alias("cumulative"))
    return sections.select(F.col("seq").cast("bigint").alias("row"), "level", "heading", "tokens", "cumulative").unionByName(total)


def write_vectors(chunks: DataFrame, path: str, dim: int) -> None:
    """The sidecar: rows without a valid content vector go, invalid summary vectors become null; zstd."""
    cols = [F.when(valid(F.col(c), dim), F.col(c).cast("array<float>")).alias(c) if c in chunks.columns else F.lit(None).cast("array<float>").alias(c) for c in VECTOR_COLUMNS]
    chunks.where(valid(F.col("embedding"), dim)).select("id", *cols).write.mode("overwrite").option("compression", "zstd").parquet(path)


def update_provenance(provenance: DataFrame, section: str, **values: object) -> DataFrame:
    """Replaces one nested section (``summary`` or ``embed``) of provenance rows."""
    return provenance.withColumn(section, F.struct(*[F.lit(v).alias(k) for k, v in values.items()]))


#: Table definitions. Keys and references are enforced by the checks below, as the file format has none.
DDL = {
    "provenance": "prov_id STRING, chunk_model STRING, chunk_size_range STRING, chunk_keyword_density DOUBLE, summary_model STRING, summary_prompt STRING, summary_size INT, summary_temperature DOUBLE, embed_model STRING, embed_vectorsize INT, created_date TIMESTAMP",
    "chunks": ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CHUNK_SCHEMA.fields),
}


def create_tables(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, columns in DDL.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet")


def constraint_violations(chunks: DataFrame, provenance: DataFrame) -> DataFrame:
    """``problem, id``: null or repeated keys, and references to no provenance."""
    key = F.coalesce("id", F.lit(""))
    null = chunks.where(key == "").select(F.lit("null key").alias("problem"), "id")
    twice = chunks.where(key != "").groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.lit("repeated key").alias("problem"), "id")
    lost = chunks.where(F.col("prov_id").isNotNull()).join(provenance, "prov_id", "left_anti").select(F.lit("unknown provenance").alias("problem"), "id")
    return null.unionByName(twice).unionByName(lost)


def upsert(existing: DataFrame, incoming: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """Existing rows not named by ``incoming``, and of those the last row per key (by ``order``). Rows without a key are dropped. Applying it twice changes nothing."""
    good = incoming.where(F.coalesce(F.col(key).cast("string"), F.lit("")) != "")
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order) if order else F.desc(F.xxhash64(*incoming.columns)), F.desc(F.xxhash64(*incoming.columns))))
    newest = good.withColumn("__rn", rank).where("__rn = 1").drop("__rn")
    return newest.unionByName(existing.join(newest.select(key), key, "left_anti").select(*existing.columns), allowMissingColumns=True)


def delete_like(rows: DataFrame, column: str, pattern: str) -> DataFrame:
    """Rows whose column isn't like the SQL pattern; nulls stay."""
    return rows.where(~F.coalesce(F.col(column).like(pattern), F.lit(False)))


def infer_dim(chunks: DataFrame, explicit: int | None = None, default: int = 1536) -> int:
    """The stated vector length, else that of the first vector, else the default."""
    if explicit:
        return explicit
    row = chunks.where(F.size("embedding") > 0).select(F.size("embedding")).first()
    return row[0] if row else default


def write_partitioned(rows: DataFrame, path: str, *by: str, fmt: str = "json") -> None:
    """Rows below ``path/<column>=<value>/...`` (difficulty and split of pairs and triplets, bucket of tokenised rows)."""
    rows.write.mode("overwrite").partitionBy(*by).format(fmt).save(path)


def append_json(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def append_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").option("header", True).option("quoteAll", True).csv(path)


def evaluation_long(summary: DataFrame, group: str = "difficulty") -> DataFrame:
    """``group, metric, value`` rows of a metrics table."""
    metrics = [c for c in summary.columns if c != group]
    return summary.select(group, *[F.col(c).cast("double") for c in metrics]).unpivot(group, metrics, "metric", "value")


#: Fields of the run log, in order.
MASTER_FIELDS = (
    "timestamp", "BASE_CWD", "CODE_CHANGE", "max_length", "batch_size", "lr", "epochs", "candidate_k", "num_chunks", "num_eval_queries", "baseline_mrr", "rerank_mrr", "baseline_recall5", "rerank_recall5", "baseline_ndcg10",
    "rerank_ndcg10", "retrieval_seconds", "rerank_seconds", "total_seconds")


def format_rate(c: Column) -> Column:
    """A learning rate: six digits, below a thousandth one significant digit in powers of ten, null empty."""
    short = F.regexp_replace(F.lower(F.format_string("%.0e", c)), r"e([+-])0+(?=\d)", "e$1")
    return F.coalesce(F.when(c == 0, "0.000000").when(F.abs(c) < 1e-3, short).otherwise(F.format_string("%.6f", c)), F.lit(""))


def master_log(run: DataFrame, baseline: DataFrame, reranker: DataFrame) -> DataFrame:
    """One row of the run log, all strings, in the order of ``MASTER_FIELDS``; what isn't known is empty.

    ``run`` holds the settings, counts and durations of one run, ``baseline`` and ``reranker`` one row each of mean
    ``mrr``, ``recall_5`` and ``ndcg_10``. ``total_seconds`` is the sum of the durations.
    """
    side = lambda df, name: df.select(F.col("mrr").alias(f"{name}_mrr"), F.col("recall_5").alias(f"{name}_recall5"), F.col("ndcg_10").alias(f"{name}_ndcg10"))
    one = run.crossJoin(side(baseline, "baseline")).crossJoin(side(reranker, "rerank"))  # a row each
    seconds = [c for c in ("retrieval_seconds", "rerank_seconds") if c in one.columns]
    one = one.withColumn("total_seconds", sum((F.coalesce(c, F.lit(0.0)) for c in seconds), F.lit(0.0)))
    out = []
    for name in MASTER_FIELDS:
        c = F.col(name) if name in one.columns else F.lit(None).cast("string")
        if name == "lr":
            c = format_rate(c.cast("double"))
        elif name.endswith("_seconds"):
            c = F.format_string("%.2f", c.cast("double"))
        elif name.startswith(("baseline_", "rerank_")):
            c = F.format_string("%.4f", c.cast("double"))
        out.append(F.coalesce(F.when(F.col(name).isNotNull(), c.cast("string")) if name in one.columns else c, F.lit("")).alias(name))
    return one.select(*out)


def master_row(stats: DataFrame) -> DataFrame:
    """Durations and metrics formatted for the run log."""
    return stats.select(*[format_seconds(F.col(c)).alias(c) if c.endswith("_seconds") else format_value(F.col(c)).alias(c) if t == "double" else F.col(c) for c, t in stats.dtypes])


def selected_rows(grid: DataFrame, lines: list[int], path: str) -> None:
    """Saves chosen rows of a grid as CSV by RFC 4180."""
    grid.where(F.col("line").isin(*lines)).orderBy("line").select(csv_row(F.col("cells")).alias("row")).write.mode("overwrite").text(path)


def csv_row(cells: Column) -> Column:
    """One line of CSV by RFC 4180: cells with a comma, a quote or a line end are quoted, quotes doubled; null is empty."""
    cell = lambda c: F.coalesce(F.when(c.rlike('[",\\r\\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c), F.lit(""))
    return F.array_join(F.transform(cells, cell), ",")
