"""Relevant chunks of labelled queries: explicit ids and filters on chunk fields."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarryloom.functions.text import FIELD_ALIASES
from quarryloom.runtime import cut

FIELDS = ("content", "heading", "concat_header_path", "category", "title", "chunk_summary", "filename")
#: Distinct filters that one pass over the chunks looks for; more are looked for in further passes.
SPEC_BLOCK = 20_000


def _automaton(needles: set[str]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for n in needles:
        found.add_word(n, n)
    found.make_automaton()
    return found


def _matcher(specs, names: tuple[str, ...]):
    """Map side: all needles of all filters in one pass over a value; of each filter the first matches of the task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = specs.value
        needles = {n for s in rows for n in (s["contains"], *s["every"], *s["some"]) if n}
        by_needle: dict[str, list[int]] = {}
        for i, s in enumerate(rows):
            for n in {s["contains"]} - {""} or set(s["every"][:1]) or set(s["some"]):
                by_needle.setdefault(n, []).append(i)
        search = _automaton(needles).iter
        held: list[list] = [[] for _ in rows]
        for b in batches:
            ids, pos = b.column("id").to_pylist(), b.column("pos").to_pylist()
            done: set[tuple[int, int]] = set()
            for field in names:
                for r, value in enumerate(b.column(field).to_pylist()):
                    if not value:
                        continue
                    hits = {n for _, n in search(value)}
                    for n in hits:
                        for i in by_needle.get(n, ()):
                            s = rows[i]
                            if field not in s["fields"] or (i, r) in done or (s["contains"] and s["contains"] not in hits):
                                continue
                            if not hits.issuperset(s["every"]) or (s["some"] and hits.isdisjoint(s["some"])):
                                continue
                            done.add((i, r))
                            heap = held[i]
                            heapq.heappush(heap, _Late(pos[r], ids[r]))
                            if len(heap) > s["most"]:
                                heapq.heappop(heap)
        out = [(rows[i]["spec"], x.pos, x.id) for i, heap in enumerate(held) for x in heap]
        cols = zip(*out, strict=True) if out else [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string()), strict=True)], ["spec", "pos", "id"])

    return work


class _Late:
    """Heap order with the last (pos, id) first, null positions before all others as in an ascending sort."""

    __slots__ = ("id", "key", "pos")

    def __init__(self, pos: int | None, id: str) -> None:
        self.pos, self.id, self.key = pos, id, (pos is not None, pos or 0, id)

    def __lt__(self, other: _Late) -> bool:
        return self.key > other.key


def ground_truth(queries: DataFrame, chunks: DataFrame) -> DataFrame:
    """``query_id, positive``: explicit positives (trimmed, lower-cased) and the first ``max_matches`` (default 5) chunks of each filter.

    A filter names a ``field`` or several ``fields`` (any of them may match; without one, the summary) and states
    ``contains``, ``contains_all`` and ``contains_any``; all that are stated must hold in one field, without regard to
    letter case. Columns of the filter struct that aren't there count as not stated; a filter that states nothing, or
    only unknown fields, matches nothing. Distinct filters are resolved once, however many queries state them, all
    in one pass over the chunks by a multi-pattern search, in blocks of ``SPEC_BLOCK``; each task gives at most as
    many matches of a filter as are asked for.
    """
    given = queries.schema["positive_filters"].dataType.elementType.fieldNames()
    text = lambda c: F.trim(F.lower(F.coalesce(c, F.lit(""))))
    none = F.array().cast("array<string>")
    stated = lambda n: F.coalesce(F.col(f"f.{n}"), none) if n in given else none
    lowered = lambda c: F.array_sort(F.array_distinct(F.filter(F.transform(c, lambda x: F.lower(x)), lambda x: x.isNotNull() & (F.trim(x) != ""))))
    names = F.create_map(*[F.lit(x) for p in {**{n: n for n in FIELDS}, **FIELD_ALIASES}.items() for x in p])
    one = F.array(F.coalesce(F.nullif(text(F.col("f.field")), F.lit("")), F.lit("chunk_summary")) if "field" in given else F.lit("chunk_summary"))
    fields = F.when(F.size(lowered(stated("fields"))) > 0, lowered(stated("fields"))).otherwise(one)
    limit = F.coalesce(F.col("f.max_matches"), F.lit(5)) if "max_matches" in given else F.lit(5)
    f = queries.select("query_id", F.explode("positive_filters").alias("f")).select(
        "query_id", limit.alias("k"), text(F.col("f.contains") if "contains" in given else F.lit("")).alias("contains"), lowered(stated("contains_all")).alias("every"), lowered(stated("contains_any")).alias("some"),
        F.array_distinct(F.filter(F.transform(fields, lambda x: F.try_element_at(names, x)), lambda x: x.isNotNull())).alias("fields"))
    f = f.where(((F.col("contains") != "") | (F.size("every") > 0) | (F.size("some") > 0)) & (F.size("fields") > 0) & (F.col("k") > 0))
    f = cut(f.withColumn("spec", F.xxhash64("contains", "every", "some", "fields")))
    specs = cut(f.groupBy("spec", "contains", "every", "some", "fields").agg(F.max("k").alias("most")))
    values = chunks.select("id", F.col("pos").cast("bigint").alias("pos"), *[F.lower(F.coalesce(c, F.lit(""))).alias(c) for c in FIELDS])
    spark, found = queries.sparkSession, None
    blocks = -(-specs.count() // SPEC_BLOCK)
    for n in range(blocks):
        rows = specs.where(F.pmod(F.col("spec"), F.lit(blocks)) == n).collect()  # about SPEC_BLOCK
        if rows:
            part = values.mapInArrow(_matcher(spark.sparkContext.broadcast([r.asDict() for r in rows]), FIELDS), "spec bigint, pos bigint, id string")
            found = part if found is None else found.unionByName(part)
    explicit = queries.select("query_id", F.explode("positives").alias("p")).where(F.trim(F.coalesce("p", F.lit(""))) != "").select("query_id", F.lower(F.trim("p")).alias("positive"))
    if found is None:
        return explicit.distinct()
    rank = F.row_number().over(Window.partitionBy("spec").orderBy("pos", "id"))
    first = found.withColumn("rn", rank).join(specs.select("spec", "most"), "spec").where(F.col("rn") <= F.col("most"))
    by_filter = f.join(first.select("spec", "rn", "id"), "spec").where(F.col("rn") <= F.col("k")).select("query_id", F.lower(F.trim("id")).alias("positive"))
    return by_filter.unionByName(explicit).distinct()
