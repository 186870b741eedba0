"""Collects the registered queries and their DuckDB statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarryloom.operators.forest import chunk_forest, descendants, hierarchy_defects
from quarryloom.plans import document_queries, evaluation_queries, relational_queries, scalar_queries  # noqa: F401  (register their queries)
from quarryloom.plans.document_sql import rollup_sql
from quarryloom.plans.registry import CHUNKS, ORACLE_SQL, QUERIES
from quarryloom.runtime import read_table

#: Lexical retrieval: BM25 top 10 of every evaluation item over all documents.
FLAGSHIP = "q_r1_a5_a6_bm25_topk"


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy_defects(read_table(spark, d, "chunks"))


def p6_tree(spark: SparkSession, d: str) -> DataFrame:
    """Path, depth, root and state of every chunk."""
    return chunk_forest(read_table(spark, d, "chunks")).select("id", "status", "root", "depth", "path")


def p6_descendants(spark: SparkSession, d: str) -> DataFrame:
    """Every chunk's descendants, one row each."""
    return descendants(chunk_forest(read_table(spark, d, "chunks")))


QUERIES.update({f.__name__: f for f in (p6_found, p6_tree, p6_descendants)})

_SUMMARY = "CASE WHEN regexp_replace(c.chunk_summary, '^\\s+|\\s+$', '', 'g') <> '' AND lower(regexp_replace(c.chunk_summary, '^\\s+|\\s+$', '', 'g')) <> 'false' THEN c.chunk_summary END"

_P6 = """
WITH RECURSIVE n AS (SELECT DISTINCT ON (id) id, nullif(parent_id, '') AS parent, coalesce(heading, '') AS heading, concat_header_path AS stored FROM chunks ORDER BY id, loaded_at DESC),
up(id, top, nxt, path, steps) AS (
  SELECT id, id, parent, heading, 0 FROM n
  UNION ALL
  SELECT u.id, p.id, p.parent, p.heading || ' > ' || u.path, u.steps + 1 FROM up u JOIN n p ON p.id = u.nxt WHERE u.steps < 64 AND u.nxt <> u.id),
last AS (SELECT id, r.t AS top, r.n AS nxt, r.p AS path, steps FROM (SELECT id, arg_max(struct_pack(t := top, n := nxt, p := path), steps) AS r, max(steps) AS steps FROM up GROUP BY id)),
s AS (SELECT l.*, n.stored, CASE WHEN l.nxt = l.id THEN 'cycle' WHEN l.steps >= 64 THEN 'below_cycle' WHEN l.nxt IS NULL THEN 'root' ELSE 'dangling' END AS status FROM last l JOIN n USING (id))"""
ORACLE_SQL["p6_found"] = _P6 + """
SELECT id, CASE WHEN status <> 'root' THEN status ELSE 'path' END AS defect FROM s WHERE status <> 'root' OR stored IS NULL OR stored <> path"""
ORACLE_SQL["p6_tree"] = _P6 + """
SELECT id, status, CASE WHEN status = 'root' THEN top END AS root, CASE WHEN status IN ('root', 'dangling') THEN CAST(steps AS INTEGER) END AS depth, CASE WHEN status IN ('root', 'dangling') THEN path END AS path FROM s"""
ORACLE_SQL["p6_descendants"] = _P6 + """
SELECT u.top AS ancestor, u.id AS descendant, CAST(u.steps AS INTEGER) AS distance FROM up u JOIN s ON s.id = u.id WHERE s.status IN ('root', 'dangling') AND u.steps > 0"""

ORACLE_SQL["q_h3_h4_h5_page_rollup"] = rollup_sql(CHUNKS, ORACLE_SQL["p6_tree"], _SUMMARY)
