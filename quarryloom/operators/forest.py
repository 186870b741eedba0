"""Problem 6: parent-child rows of unknown depth to full hierarchies.

Partition-local parent chains are contracted to fragment exits, the smaller quotient forest of fragments is solved
recursively, and the fragments are then expanded again.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryloom.runtime import ROWS_PER_TASK, cut, latest, spread

ROOT, DANGLING, CYCLE, BELOW_CYCLE, OPEN = "root", "dangling", "cycle", "below_cycle", "open"

_OUT = pa.schema([
    ("id", pa.string()), ("top", pa.string()), ("exit", pa.string()), ("status", pa.string()),
    ("labels", pa.list_(pa.string())), ("ids", pa.list_(pa.string()))])
_DDL = "id string, top string, exit string, status string, labels array<string>, ids array<string>"


def resolve_locally(nodes: dict[str, tuple[str | None, list[str], list[str]]]) -> Iterator[tuple]:
    """Chains of ``id -> (parent, labels, ids)`` within one dict, each node visited once.

    Yields ``(id, top, exit, status, labels, ids)``: the highest reachable node, the parent it points to outside the
    dict, and the labels and ids joined from ``top`` down to the node. ``status`` is root (no parent), open (the exit
    lies elsewhere), cycle or below_cycle; members of a loop and nodes below one carry their own labels only.
    """
    done: dict[str, tuple] = {}
    for start in nodes:
        chain, on_chain, at = [], {}, start
        while at in nodes and at not in done and at not in on_chain:
            on_chain[at] = len(chain)
            chain.append(at)
            at = nodes[at][0]
        if at in on_chain:
            loop_from = on_chain[at]
            for x in chain[loop_from:]:
                done[x] = (x, None, CYCLE, nodes[x][1], nodes[x][2])
            chain = chain[:loop_from]
        for x in reversed(chain):
            parent, labels, ids = nodes[x]
            if parent is None:
                done[x] = (x, None, ROOT, labels, ids)
            elif parent not in nodes:
                done[x] = (x, parent, OPEN, labels, ids)
            else:
                top, out, status, up_labels, up_ids = done[parent]
                if status in (CYCLE, BELOW_CYCLE):
                    done[x] = (x, None, BELOW_CYCLE, labels, ids)
                else:
                    done[x] = (top, out, status, up_labels + labels, up_ids + ids)
    for x, (top, out, status, labels, ids) in done.items():
        yield x, top, out, status, labels, ids


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    nodes: dict[str, tuple[str | None, list[str], list[str]]] = {}
    for b in batches:
        for i, p, labels, ids in zip(*(b.column(c).to_pylist() for c in ("id", "parent", "labels", "ids")), strict=True):
            nodes[i] = (p, labels, ids)
    rows: list[tuple] = []
    for row in resolve_locally(nodes):
        rows.append(row)
        if len(rows) == 20_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _OUT, strict=True)], schema=_OUT)
            rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _OUT, strict=True)], schema=_OUT)


def _loop_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ids between each entry of a looping fragment and its top."""
    for b in batches:
        ids = sorted({x for own in b.column("ids").to_pylist() for x in own})
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string())], ["id"])


def _solve(nodes: DataFrame, count: int, per_task: int, level: int) -> DataFrame:
    """``nodes``: ``id, parent, labels, ids, place``, parents null for roots. Gives ``id, status, stop, labels, ids``.

    ``stop`` is the root, or the missing id above a dangling node. ``place`` orders nodes so that kin are mostly close.
    """
    parts = 1 if count <= per_task else spread(nodes, count, per_task)
    placed = nodes.coalesce(1) if count <= per_task and level else (nodes.repartition(1) if parts == 1 else nodes.repartitionByRange(parts, "place", "id"))
    local = cut(placed.select("id", "parent", "labels", "ids").mapInArrow(_contract, _DDL))
    closed = local.where(F.col("status") != OPEN).select("id", "status", F.when(F.col("status") == ROOT, F.col("top")).alias("stop"), "labels", "ids")
    if parts == 1:
        left = local.where(F.col("status") == OPEN).select("id", F.lit(DANGLING).alias("status"), F.col("exit").alias("stop"), "labels", "ids")
        return closed.unionByName(left)
    #: Fragments: open tops, each with the node its exit leads to; that node's own fragment is its parent.
    tops = local.where((F.col("status") == OPEN) & (F.col("id") == F.col("top"))).select(F.col("id").alias("frag"), "exit")
    target = local.select(F.col("id").alias("exit"), F.col("top").alias("t_top"), F.col("status").alias("t_status"), F.col("labels").alias("t_labels"), F.col("ids").alias("t_ids"))
    edges = cut(tops.join(target, "exit", "left"))
    frags = edges.count()
    ended = edges.where(F.coalesce(F.col("t_status"), F.lit("")) != OPEN).select(
        "frag", F.coalesce(F.when(F.col("t_status") == CYCLE, BELOW_CYCLE).otherwise(F.col("t_status")), F.lit(DANGLING)).alias("f_status"),
        F.when(F.col("t_status").isNull(), F.col("exit")).when(F.col("t_status") == ROOT, F.col("t_top")).alias("f_stop"),
        F.coalesce("t_labels", F.array().cast("array<string>")).alias("f_labels"), F.coalesce("t_ids", F.array().cast("array<string>")).alias("f_ids"))
    # An ended fragment acts as a root of the quotient; an open one hangs below the fragment its exit lies in.
    quotient = edges.select(
        F.col("frag").alias("id"), F.when(F.col("t_status") == OPEN, F.col("t_top")).alias("parent"),
        F.when(F.col("t_status") == OPEN, F.col("t_labels")).otherwise(F.array().cast("array<string>")).alias("labels"),
        F.when(F.col("t_status") == OPEN, F.col("t_ids")).otherwise(F.array().cast("array<string>")).alias("ids"), F.col("frag").alias("place"))
    if frags * 2 > count:
        # Badly placed kin: by the fall of a coin for each node and level, every fourth child is placed with its parent, so
        # that the next level has fewer nodes in any case and no task grows.
        coin = lambda c: F.xxhash64(c, F.lit(level)).bitwiseAND(1)
        quotient = quotient.withColumn("place", F.when((coin("id") == 0) & (coin("parent") == 1), F.col("parent")).otherwise(F.col("id")))
    solved = _solve(quotient, frags, per_task, level + 1)
    ends = ended.select(F.col("frag").alias("stop"), "f_status", "f_stop", "f_labels", "f_ids")
    solved = solved.select(F.col("id").alias("top"), F.col("status").alias("q_status"), "stop", F.col("labels").alias("q_labels"), F.col("ids").alias("q_ids"))
    heads = solved.join(ends, "stop", "left").select(
        "top", "q_status", F.when(F.col("q_status") == ROOT, F.col("f_status")).otherwise(F.col("q_status")).alias("h_status"), F.col("f_stop").alias("h_stop"),
        F.concat(F.coalesce("f_labels", F.array().cast("array<string>")), "q_labels").alias("h_labels"),
        F.concat(F.coalesce("f_ids", F.array().cast("array<string>")), "q_ids").alias("h_ids"))
    # A loop of fragments passes each of them from the entry up to the top only; all else in them lies below it.
    looping = solved.where(F.col("q_status") == CYCLE).select("top")
    entries = edges.where(F.col("t_status") == OPEN).join(looping.withColumnRenamed("top", "frag"), "frag", "left_semi")
    on_loop = entries.select(F.col("t_ids").alias("ids")).mapInArrow(_loop_members, "id string").distinct().withColumn("on_loop", F.lit(True))
    opened = local.where(F.col("status") == OPEN).join(heads, "top").join(on_loop, "id", "left")
    looped = F.col("h_status").isin(CYCLE, BELOW_CYCLE)
    status = F.when(F.col("on_loop") & (F.col("q_status") == CYCLE), CYCLE).when(looped, BELOW_CYCLE).otherwise(F.col("h_status"))
    opened = opened.select(
        "id", status.alias("status"), F.col("h_stop").alias("stop"),
        F.when(looped, F.col("labels")).otherwise(F.concat("h_labels", "labels")).alias("labels"), F.when(looped, F.col("ids")).otherwise(F.concat("h_ids", "ids")).alias("ids"))
    return closed.unionByName(opened)


def resolve_forest(nodes: DataFrame, id_col: str = "id", parent_col: str = "parent_id", label_col: str = "heading",
                   place_cols: tuple[str, ...] = ("filename", "pos"), per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Per node: ``id, parent, status, root, stop, depth, labels, path_ids``.

    ``status``: root = the parents end at a root (the node itself may be one), dangling = at an id that is no node,
    cycle = on a loop, below_cycle = leading into one. ``root`` is set for status root, ``stop`` also for dangling
    (the missing id). ``depth`` of a root is 0; it, ``labels`` and ``path_ids`` (root to node) are null on and below
    loops, and start at the highest existing node of dangling ones. Null or empty parents mark roots; rows with a
    null id are dropped; of rows with equal ids one is taken (as ``latest`` orders them); null labels count as "".

    No task holds more than ``per_task`` nodes on average, however badly kin are placed; a third of all
    nodes in one tree is spread over tasks by ``place_cols`` like any others.
    """
    place = F.concat_ws("\x00", *[F.lpad(F.col(c).cast("string"), 20, "0") if dict(nodes.dtypes)[c] in ("bigint", "int") else F.coalesce(F.col(c).cast("string"), F.lit("")) for c in place_cols]) if place_cols else F.col(id_col).cast("string")
    flat = nodes.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("string").alias("id"), F.nullif(F.col(parent_col).cast("string"), F.lit("")).alias("parent"),
        F.array(F.coalesce(F.col(label_col).cast("string"), F.lit(""))).alias("labels"), F.array(F.col(id_col).cast("string")).alias("ids"), place.alias("place"))
    flat = cut(flat.dropDuplicates(["id"]))
    count = flat.count()
    solved = _solve(flat, count, per_task, 0)
    looped = F.col("status").isin(CYCLE, BELOW_CYCLE)
    return flat.select("id", "parent").join(solved, "id").select(
        "id", "parent", "status", F.when(F.col("status") == ROOT, F.col("stop")).alias("root"), "stop",
        F.when(~looped, F.size("ids") - 1).alias("depth"), F.when(~looped, F.col("labels")).alias("labels"), F.when(~looped, F.col("ids")).alias("path_ids"))


def descendants(forest: DataFrame) -> DataFrame:
    """Every (``ancestor``, ``descendant``, ``distance``) of a resolved forest; one row per ancestor of a node, none collected in one place."""
    return forest.where(F.col("path_ids").isNotNull()).select(F.col("id").alias("descendant"), "depth", F.posexplode("path_ids").alias("at", "ancestor")).where(
        F.col("at") < F.col("depth")).select("ancestor", "descendant", (F.col("depth") - F.col("at")).alias("distance"))


def chunk_forest(chunks: DataFrame, per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``resolve_forest`` over chunks, an id once (its latest delivery), with the stored path: adds ``stored_path, path``."""
    rows = latest(chunks.select("id", "parent_id", "heading", "concat_header_path", "filename", "pos", "loaded_at"), "id", "loaded_at")
    rows = cut(rows)
    forest = resolve_forest(rows, per_task=per_task)
    return forest.join(rows.select("id", F.col("concat_header_path").alias("stored_path")), "id").withColumn("path", F.array_join("labels", " > "))


def hierarchy_defects(chunks: DataFrame, per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``id, defect``: cycle, below_cycle, dangling, or path (a tree's stored path is null or not the headings from the root)."""
    f = chunk_forest(chunks, per_task)
    wrong = F.col("stored_path").isNull() | (F.col("stored_path") != F.col("path"))
    return f.select("id", F.when(F.col("status") != ROOT, F.col("status")).when(wrong, "path").alias("defect")).where(F.col("defect").isNotNull())
