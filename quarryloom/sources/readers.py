"""Readers of the engine's inputs. Schemas are stated, never inferred over a corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as S

from quarryloom.functions.text import blank_to_null, sentinel_to_null

CATALOGUE_COLUMNS = ("ID", "PARSER", "CRAWL_URL", "BASE_DIR", "METADATA_TITLE", "METADATA_AUTHOR", "METADATA_CATEGORY", "METADATA_DESCRIPTION", "TAGS", "METADATA_DATE", "PAGES")
VECTOR_COLUMNS = ("embedding", "embedding_summary_chunk", "embedding_summary_page")

_STR, _INT, _STRS, _VEC = S.StringType(), S.IntegerType(), S.ArrayType(S.StringType()), S.ArrayType(S.FloatType())


def _struct(**types: S.DataType) -> S.StructType:
    return S.StructType([S.StructField(n, t) for n, t in types.items()])


CHUNK_SCHEMA = _struct(
    id=_STR, filename=_STR, parent_id=_STR, id_prev=_STR, id_next=_STR, heading=_STR, header_level=_INT, concat_header_path=_STR, chunk_type=_STR, content=_STR, examples=_STRS, chunk_summary=_STR, page_summary=_STR,
    title=_STR, author=_STR, category=_STR, description=_STR, language=_STR, token_count=_INT, embedding=_VEC, embedding_summary_chunk=_VEC, embedding_summary_page=_VEC, prov_id=_STR)
FILTER_SCHEMA = _struct(field=_STR, fields=_STRS, contains=_STR, contains_all=_STRS, contains_any=_STRS, max_matches=_INT)
QUERY_SCHEMA = _struct(
    id=_STR, query_id=_STR, query=_STR, text=_STR, difficulty=_STR, split=_STR, positives=_STRS, positive_ids=_STRS, min_positives=_INT, min_results=_INT, min_positive_hits=_INT, positive_filters=S.ArrayType(FILTER_SCHEMA))
TRIPLET_SCHEMA = _struct(anchor=_STR, positive=_STR, negative=_STR, difficulty=_STR, pair_type=_STR)


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """The metadata catalogue; short rows get nulls."""
    schema = S.StructType([S.StructField(c, S.StringType()) for c in CATALOGUE_COLUMNS])
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)


def catalogue_row(catalogue: DataFrame, crawl_id: str) -> dict[str, str]:
    """The one row with this id; ``BASE_DIR`` is ``run`` where blank. Raises ``LookupError`` if there is none."""
    rows = catalogue.where(F.col("ID") == crawl_id).limit(2).collect()
    if not rows:
        raise LookupError(f"no catalogue row {crawl_id}")
    out = rows[0].asDict()
    out["BASE_DIR"] = (out.get("BASE_DIR") or "").strip() or "run"
    return out


def read_markdown(spark: SparkSession, folder: str) -> DataFrame:
    """``path, text`` of every Markdown file below a folder, a path once."""
    raw = spark.read.format("text").option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.{md,markdown,mdx}").load(folder)
    return raw.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")).dropDuplicates(["path"])


def read_markdown_source(spark: SparkSession, folder: str) -> DataFrame:
    """The merged file ``<folder>/<name>.md`` if it exists, else all files below the folder."""
    name = folder.rstrip("/").rsplit("/", 1)[-1]
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    single = hadoop.Path(f"{folder.rstrip('/')}/{name}.md")
    if single.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(single):
        return spark.read.format("text").option("wholetext", True).load(single.toString()).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    return read_markdown(spark, folder)


def _list_or_wrapped(spark: SparkSession, path: str, schema: S.StructType, wrapper: str) -> DataFrame:
    """Records of a JSON list, JSON lines, or an object that holds them under ``wrapper``; ``pos`` is their order."""
    both = S.StructType([*schema.fields, S.StructField(wrapper, S.ArrayType(schema))])
    lines = path.endswith(".jsonl")
    raw = spark.read.schema(both).option("multiLine", not lines).json(path).withColumn("__at", F.monotonically_increasing_id())
    flat = raw.where(F.col(wrapper).isNull()).select("__at", F.lit(0).alias("__i"), *schema.names)
    nested = raw.where(F.col(wrapper).isNotNull()).select("__at", F.posexplode(wrapper).alias("__i", "r")).select("__at", "__i", "r.*")
    from quarryloom.operators.order import enumerate_rows

    return enumerate_rows(flat.unionByName(nested), ["__at", "__i"], "pos").withColumn("pos", F.col("pos") - 1).drop("__at", "__i")


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """A chunk corpus (list or ``{"chunks": [...]}``); the string "false" in summaries becomes null, ``embeddable`` tells it."""
    df = _list_or_wrapped(spark, path, CHUNK_SCHEMA, "chunks")
    summaries = {c: sentinel_to_null(F.col(c)) for c in ("chunk_summary", "page_summary")}
    return df.withColumns(summaries).withColumn("embeddable", F.col("embedding").isNotNull())


def corpus_texts(chunks: DataFrame) -> DataFrame:
    """``id, text`` for retrieval: the summary, else the content; chunks without id or text go."""
    text = F.coalesce(blank_to_null(sentinel_to_null(F.col("chunk_summary"))), blank_to_null(F.col("content")))
    return chunks.select("id", text.alias("text")).where((F.coalesce("id", F.lit("")) != "") & F.col("text").isNotNull())


def read_queries(spark: SparkSession, path: str) -> DataFrame:
    """Labelled queries from a JSON list, JSON lines, or ``{"queries": [...]}``; blank ones go, missing ids are ``q0001`` by position."""
    from quarryloom.operators.order import enumerate_rows

    df = enumerate_rows(_list_or_wrapped(spark, path, QUERY_SCHEMA, "queries"), ["pos"], "n")
    return df.select(
        F.coalesce("query_id", "id", F.format_string("q%04d", "n")).alias("query_id"), F.coalesce("text", "query").alias("text"), F.coalesce("positives", "positive_ids").alias("positives"),
        F.coalesce("difficulty", F.lit("hard")).alias("difficulty"), F.coalesce("split", F.lit("train")).alias("split"), "positive_filters",
        F.coalesce("min_positives", "min_results", F.lit(1)).alias("min_positives"), F.coalesce("min_positive_hits", F.lit(1)).alias("min_positive_hits")).where(blank_to_null(F.col("text")).isNotNull())


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """The embedding sidecar; optional vector columns that are absent come as nulls. Raises without ``id`` or ``embedding``."""
    df = spark.read.parquet(path)
    if missing := {"id", "embedding"} - set(df.columns):
        raise ValueError(f"columns missing: {sorted(missing)}")
    return df.select("id", *[F.col(c).cast("array<float>") if c in df.columns else F.lit(None).cast("array<float>").alias(c) for c in VECTOR_COLUMNS])


def read_triplets(spark: SparkSession, folder: str, limit: int | None = None) -> DataFrame:
    """Triplets below ``<folder>/<difficulty>/triplets_<split>.json``, with ``difficulty`` and ``split`` from the path. Raises where anchor or negative is missing."""
    df = spark.read.schema(TRIPLET_SCHEMA).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "triplets_*.json").json(folder)
    path = F.col("_metadata.file_path")
    df = df.select("anchor", "positive", "negative", "pair_type", F.coalesce("difficulty", F.regexp_extract(path, r"/([^/]+)/triplets_", 1)).alias("difficulty"), F.regexp_extract(path, r"triplets_(\w+)\.json", 1).alias("split"))
    if not df.where(F.col("anchor").isNull() | F.col("negative").isNull()).isEmpty():
        raise ValueError("triplets without anchor or negative")
    return df.orderBy("difficulty", "split", "anchor").limit(limit) if limit is not None else df


def difficulty_order(requested: str | None, epoch: str | None = None) -> list[str]:
    """Difficulties in the order in which their files are sought."""
    order = [requested, requested.lower()] if requested else ([epoch] if epoch else [])
    return list(dict.fromkeys([*order, *([] if requested else ["easy", "medium", "hard"])]))


def read_pairs(spark: SparkSession, folder: str, difficulties: list[str], split: str, limit: int | None = None) -> DataFrame:
    """Labelled pairs from ``<folder>/difficulty=<d>/split=<s>`` JSON lines."""
    df = spark.read.json(folder).where(F.col("difficulty").isin(*difficulties) & (F.col("split") == split))
    return df.limit(limit) if limit is not None else df


def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    v = F.trim("value")
    return spark.read.text(path).where((v != "") & ~v.startswith("#")).select(v.alias("url"))


#: Starts of banner lines in token reports.
BANNERS = ("Token count analysis", "Using tiktoken", "====")


def read_grid(spark: SparkSession, path: str) -> DataFrame:
    """A CSV or log grid as ``line, cells``: banners and blank lines go, the header is the first line with a comma (line 1)."""
    v = F.col("value")
    keep = F.trim(v) != ""
    for b in BANNERS:
        keep = keep & ~v.startswith(b)
    from quarryloom.operators.order import enumerate_rows

    rows = spark.read.text(path).withColumn("at", F.monotonically_increasing_id()).where(keep & v.contains(","))
    cells = F.transform(F.split(v, r",(?=(?:[^\"]*\"[^\"]*\")*[^\"]*$)"), lambda c: F.replace(F.regexp_replace(F.trim(c), r'^"|"$', ""), F.lit('""'), F.lit('"')))
    return enumerate_rows(rows, ["at"], "line").select("line", cells.alias("cells"))


def tree_files(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Files below the roots of a repository listing ``path, parent, kind``, at any depth, each once; what hangs in loops has no root."""
    from quarryloom.operators.forest import ROOT, resolve_forest
    from quarryloom.runtime import cut

    nodes = edges.select("path", F.when(F.col("parent").isin(""), None).otherwise(F.col("parent")).alias("parent"), "kind")
    f = resolve_forest(cut(nodes), "path", "parent", "path", ("path",)).where(F.col("status") == ROOT)
    below = f.join(roots.select(F.col("path").alias("root")), "root", "left_semi").select(F.col("id").alias("path"))
    return below.join(nodes.where("kind = 'file'"), "path", "left_semi").where(F.col("path").rlike(r"\.mdx?$|\.markdown$"))


def read_stats(spark: SparkSession, path: str) -> dict[str, object]:
    """The figures of a difficulty's statistics file (one JSON object), or nothing where there is no such file."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return {}
    row = spark.read.option("multiLine", True).json(path).first()
    return row.asDict(recursive=True) if row else {}
