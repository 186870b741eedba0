"""Problem 2: the most similar vectors for every vector, by collision-counting hashing.

Each vector is read along many single projections. Vectors of one cell are kept as arrays sorted by a projection; a
query-centred window over the array is widened level by level (virtual rehashing), the projections in whose windows
two vectors fall together are counted, and pairs above the collision threshold are verified by their cosine.
``similar_pairs`` ends that widening at a least cosine. ``nearest`` has none: there the window is the whole field, so
that every vector gets its ``k`` nearest exactly, at a cost that grows with the square of the distinct vectors.

Cells: along one projection of 48-dimensional unit vectors, a pair of cosine 0.93 differs by 0.054 and a chance pair
by 0.204 (standard deviations), so a window that keeps the one keeps half of all others, and windows over whole
tables would meet every pair many times. Each of several copies of a field is therefore cut into cells first, as many
as keep a cell's mean size the same however large the field is: a vector's cell is the greatest of its coordinates
along random axes, and that again along others. How often a pair at the least cosine shares a cell is measured on
random pairs, and the number of copies follows from it and from the recall asked for.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarryloom.llm.bits import only_maybe
from quarryloom.runtime import cut

FIELDS = ("embedding", "embedding_summary_chunk", "embedding_summary_page")
DIM = 48
#: Rows that one shard of cells holds at most on average.
SHARD_ROWS = 60_000
#: Distinct vectors whose nearest one task of ``nearest`` looks for, and the tile of cosines it computes at once.
QUERY_ROWS = 48_000
TILE = (512, 2048)


@dataclass(frozen=True)
class Params:
    """``min_cosine`` ends the widening of windows; ``projections`` counted per pair, of which ``share`` must collide.

    ``recall``: with what probability a pair at the least cosine meets in one of the tables; ``cell_rows``: mean size of a
    cell. A vector stops asking once its ``k``-th verified neighbour lies so near that the windows searched so far were at
    least ``sure`` deviations of such a pair wide (the termination of the method); how many it met doesn't matter.
    """

    k: int = 10
    min_cosine: float = 0.93
    recall: float = 0.985
    cell_rows: int = 128
    projections: int = 16
    share: float = 0.75
    sure: float = 4.0
    seed: int = 7

    @property
    def radius(self) -> float:
        return math.sqrt(2 - 2 * self.min_cosine)


@dataclass(frozen=True)
class Cells:
    """How one field is cut: ``tables`` copies, in each a vector's cell is its greatest coordinate along each set of ``axes``."""

    axes: tuple[int, ...]
    tables: int

    def hashes(self, x: np.ndarray, seed: int) -> Iterator[np.ndarray]:
        """The cell of every vector, table by table."""
        for t in range(self.tables):
            rng = np.random.default_rng((seed, t))
            cell = np.zeros(len(x), np.uint64)
            for n in self.axes:
                y = x @ rng.standard_normal((x.shape[1], n)).astype(np.float32)
                top = np.abs(y).argmax(1)
                side = y[np.arange(len(x)), top] > 0
                cell = cell * np.uint64(2 * n) + (2 * top + side).astype(np.uint64)
            yield cell


def plan_cells(rows: int, p: Params, dim: int) -> Cells:
    """Cells for a field of ``rows`` vectors."""
    want, axes = rows / p.cell_rows, []
    while want >= 2:
        axes.append(min(dim, round(want / 2)))
        want /= 2 * axes[-1]
    if not axes:
        return Cells((), 1)
    rng = np.random.default_rng(p.seed)
    a, b = rng.standard_normal((2, 4000, dim))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b -= (a * b).sum(1)[:, None] * a
    b = p.min_cosine * a + math.sqrt(1 - p.min_cosine**2) * b / np.linalg.norm(b, axis=1)[:, None]
    tries = Cells(tuple(axes), 8)
    meet = np.mean([(u == v).mean() for u, v in zip(tries.hashes(a.astype(np.float32), p.seed), tries.hashes(b.astype(np.float32), p.seed), strict=True)])
    return Cells(tuple(axes), math.ceil(math.log(1 - p.recall) / math.log(1 - min(max(meet, 1e-3), 0.999))))


def valid_vectors(column: pa.Array, dim: int = DIM) -> tuple[np.ndarray, np.ndarray]:
    """``(rows, unit vectors)`` of a list column: those with ``dim`` finite values that are not all zero."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    offsets = column.offsets.to_numpy()[: n + 1]
    values = column.values
    flat = values.to_numpy(zero_copy_only=False).astype(np.float32, copy=False)
    ok = np.diff(offsets) == dim
    if column.null_count:
        ok &= column.is_valid().to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(ok)
    if not len(rows):
        return rows, np.empty((0, dim), np.float32)
    x = flat[offsets[rows][:, None] + np.arange(dim)].astype(np.float64)
    norm = np.sqrt((x * x).sum(1))
    good = np.isfinite(norm) & (norm > 0)
    return rows[good], (x[good] / norm[good, None]).astype(np.float32)


#: What rounding to such steps changes in a cosine, at most.
ROUNDING = 0.01
#: One record of a shard: field, table and cell; row number; vector in steps of 1/127.
_REC = np.dtype([("cell", np.uint64), ("row", np.int64), ("v", np.int8, (DIM,))])


def _emit(p: Params, cells: list[Cells], shards: int, dim: int):
    """Map side: every valid vector, equal ones of a batch once, in each table; packed into one block per shard and task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if not parts:
                return
            shard = np.concatenate([a for a, _ in parts])
            rec = np.concatenate([b for _, b in parts])
            parts.clear()
            order = np.argsort(shard, kind="stable")
            shard, rec = shard[order], rec[order]
            keys, starts = np.unique(shard, return_index=True)
            ends = np.append(starts[1:], len(shard))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array([rec[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary())], ["shard", "block"])

        held = 0
        for b in batches:
            if not b.num_rows:
                continue
            ids, once = np.unique(b.column("row").to_numpy(), return_index=True)
            x = np.frombuffer(b"".join(b.column("unit").take(pa.array(once)).to_pylist()), np.float32).reshape(-1, dim)
            q = np.clip(np.rint(x * 127), -127, 127).astype(np.int8)
            for f, own in enumerate(cells):
                mine = np.flatnonzero(ids % 4 == f)
                if not len(mine):
                    continue
                for t, cell in enumerate(own.hashes(x[mine], p.seed)):
                    rec = np.empty(len(mine), _REC)
                    rec["row"], rec["v"] = ids[mine], q[mine]
                    rec["cell"] = cell | np.uint64((f << 16 | t) << 40)
                    mixed = (rec["cell"] ^ (rec["cell"] >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
                    parts.append((((mixed >> np.uint64(32)) % np.uint64(shards)).astype(np.int32), rec))
                    held += len(mine)
            if held > 400_000:
                yield from flush()
                held = 0
        yield from flush()

    return work


def _search_block(rec: np.ndarray, p: Params, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Candidates of one shard's records, the ``k`` nearest of each that it holds and what rounding can't tell from them:
    ``(row, its neighbour, approximate cosine)``."""
    x = rec["v"].astype(np.float32)
    x /= np.maximum(np.sqrt((x * x).sum(1)), 1e-9)[:, None]
    proj = x @ axes
    order = np.lexsort((rec["row"], proj[:, 0], rec["cell"]))
    again = np.append(False, (rec["cell"][order][1:] == rec["cell"][order][:-1]) & (rec["row"][order][1:] == rec["row"][order][:-1]))
    order = order[~again]  # equal vectors from other batches
    cell, row, x, proj = rec["cell"][order], rec["row"][order], x[order], proj[order]
    few = [np.ascontiguousarray(proj[:, c]) for c in range(1, 5)]
    n = len(row)
    #: Half widths of the windows: virtual rehashing doubles them up to 2.5 deviations of a pair at the least cosine.
    widths = [2.5 * p.radius * s for s in (0.25, 0.5, 1.0)]
    first = proj[:, 0]
    need = math.ceil(p.share * p.projections)
    best = _Best(n, p.k, ROUNDING)
    stopped = np.zeros(n, bool)
    for level, wide in enumerate(widths):
        narrow = widths[level - 1] if level else -1.0
        live = np.arange(n - 1)
        step = 1
        while len(live):
            live = live[live + step < n]
            other = live + step
            gap = first[other] - first[live]
            inside = (cell[other] == cell[live]) & (gap <= wide)
            live, other = live[inside], other[inside]
            # Who stops is settled between levels only: so whatever an earlier level's windows held has been counted.
            todo = ~(stopped[live] & stopped[other])
            a, b = live[todo], other[todo]
            for lo in range(0, len(a), 200_000):
                i, j = a[lo : lo + 200_000], b[lo : lo + 200_000]
                # The first few projections discard most chance pairs before all are counted.
                near = np.zeros(len(i), np.int8)
                for c in few:
                    near += np.abs(c[i] - c[j]) <= wide
                keep = near >= 3
                i, j = i[keep], j[keep]
                d = np.abs(proj[i] - proj[j])
                hits = (d <= wide).sum(1) >= need
                if narrow > 0:  # a pair that an earlier level met isn't counted again
                    hits &= ~((d[:, 0] <= narrow) & ((d[:, 1:5] <= narrow).sum(1) >= 3) & ((d <= narrow).sum(1) >= need))
                i, j = i[hits], j[hits]
                c = np.einsum("ij,ij->i", x[i], x[j])
                for q, o in ((i, j), (j, i)):
                    good = c >= np.maximum(best.least[q], p.min_cosine - ROUNDING)
                    if good.any():
                        best.add(q[good], c[good], o[good])
            step += 1
        best.reduce()
        # ``least`` is that much below the k-th cosine; near 1, where this can hold, rounding shifts a cosine far less.
        stopped = best.least + ROUNDING - ROUNDING / 4 >= 1 - (wide / p.sure) ** 2 / 2
    q, c, o = best.reduce()[:3]
    return row[q], row[o], c


def _find(p: Params, dim: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        axes = np.random.default_rng(p.seed).standard_normal((dim, p.projections)).astype(np.float32)
        held: dict[int, list[bytes]] = {}
        for b in batches:
            for s, block in zip(b.column("shard").to_pylist(), b.column("block").to_pylist(), strict=True):
                held.setdefault(s, []).append(block)
        for s in sorted(held):
            rec = np.frombuffer(b"".join(held.pop(s)), _REC)
            a, b, _ = _search_block(rec, p, axes)
            low, high = np.minimum(a, b), np.maximum(a, b)
            pairs = np.unique(np.stack([low, high], 1), axis=0) if len(a) else np.empty((0, 2), np.int64)
            pairs = pairs[pairs[:, 0] != pairs[:, 1]]
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["row_a", "row_b"])

    return work


def _units(dim: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("id")
            for f, field in enumerate(FIELDS):
                if field in b.schema.names:
                    rows, x = valid_vectors(b.column(field), dim)
                    yield pa.RecordBatch.from_arrays([pa.array([f] * len(rows), pa.int32()), ids.take(pa.array(rows)), pa.array([v.tobytes() for v in x], pa.binary())], ["f", "id", "unit"])

    return work


def _keyed(chunks: DataFrame, dim: int) -> DataFrame:
    """``row, id, unit`` of every valid vector; equal vectors of a field have the same ``row``, and ``row % 4`` is the field."""
    fields = [f for f in FIELDS if f in chunks.columns]
    units = chunks.where(F.col("id").isNotNull()).select("id", *fields).mapInArrow(_units(dim), "f int, id string, unit binary")
    return units.select((F.xxhash64("unit").bitwiseAND((1 << 61) - 1) * 4 + F.col("f")).alias("row"), "id", "unit")


def _classes(chunks: DataFrame, dim: int) -> tuple[DataFrame, DataFrame]:
    """Equal vectors of a field as one class: ``(row, unit)`` per class, and its members ``(row, id)``."""
    keyed = _keyed(chunks, dim)
    return cut(keyed.select("row", "unit").dropDuplicates(["row"])), cut(keyed.select("row", "id").distinct())


def _named(near: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """``field, id, neighbour, rank, cosine`` from ``row, other, cosine`` of classes, a class with itself among them.

    A class stands for its ``k + 1`` smallest ids: one may be the asking vector itself.
    """
    place = F.row_number().over(Window.partitionBy("row").orderBy("id"))
    heads = members.withColumn("place", place).where(F.col("place") <= k + 1).select(F.col("row").alias("other"), F.col("id").alias("neighbour"))
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("cosine"), "neighbour"))
    best = near.join(heads, "other").withColumn("rank", rank).where(F.col("rank") <= k + 1)
    lists = best.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("rank", "neighbour", "cosine"))).alias("list"))
    own = members.join(lists, "row").select("row", "id", F.posexplode(F.slice(F.filter("list", lambda x: x["neighbour"] != F.col("id")), 1, k)).alias("at", "x"))
    field = F.element_at(F.array(*[F.lit(f) for f in FIELDS]), (F.col("row") % 4 + 1).cast("int"))
    return own.select(field.alias("field"), "id", "x.neighbour", (F.col("at") + 1).alias("rank"), "x.cosine")


def _copies(members: DataFrame) -> DataFrame:
    """Classes of several members."""
    return members.groupBy("row").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a <> z").select("row")


def _spread(groups: list[int], dim: int):
    """Map side of the scan: each class once as a query of its part, and once as data for every part of its field."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = np.concatenate([[0], np.cumsum(groups)])
        rec = np.dtype([("row", np.int64), ("v", np.float32, (dim,))])
        for b in batches:
            x = np.empty(b.num_rows, rec)
            x["row"] = b.column("row").to_numpy()
            if len(x):
                x["v"] = np.frombuffer(b"".join(b.column("unit").to_pylist()), np.float32).reshape(-1, dim)
            f, part, data, block = x["row"] % 4, [], [], []
            g = (x["row"] >> 2) % np.maximum(np.array(groups)[f], 1)
            for n, k in ((n, k) for n in range(len(groups)) for k in range(groups[n])):
                for is_data, take in ((False, (f == n) & (g == k)), (True, f == n)):
                    if take.any():
                        part.append(int(first[n] + k))
                        data.append(is_data)
                        block.append(x[take].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(data, pa.bool_()), pa.array(block, pa.binary())], ["part", "data", "block"])

    return work


class _Best:
    """The ``k`` greatest cosines of each of ``n`` queries so far, and those within rounding of the k-th."""

    def __init__(self, n: int, k: int, slack: float = 1e-6) -> None:
        self.k, self.slack, self.least = k, slack, np.full(n, -2, np.float32)
        self.held: list[tuple[np.ndarray, ...]] = []
        self.size, self.most = 0, max(1_000_000, 4 * n * k)

    def add(self, query: np.ndarray, *rest: np.ndarray) -> None:
        self.held.append((query, *rest))
        self.size += len(query)
        if self.size > self.most:
            self.reduce()
            self.most = max(self.most, 2 * self.size)

    def reduce(self) -> tuple[np.ndarray, ...]:
        if not self.held:
            return np.empty(0, np.int64), np.empty(0, np.float32), np.empty(0, np.int64), np.empty(0)  # as in ``add``
        cols = [np.concatenate(x) for x in zip(*self.held, strict=True)]
        order = np.lexsort((-cols[1], cols[0]))
        cols = [c[order] for c in cols]
        query = cols[0]
        starts = np.flatnonzero(np.append(True, query[1:] != query[:-1]))
        sizes = np.diff(np.append(starts, len(query)))
        full = sizes >= self.k
        self.least[query[starts[full]]] = cols[1][starts[full] + self.k - 1] - self.slack
        keep = cols[1] >= self.least[query]
        self.held = [tuple(c[keep] for c in cols)]
        self.size = int(keep.sum())
        return self.held[0]


def _scan(k: int, dim: int):
    """Every query of a part against every class of its field, in tiles: ``row, other, cosine`` of the ``k`` nearest and their ties."""
    rec = np.dtype([("row", np.int64), ("v", np.float32, (dim,))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[bytes] = []
        rows = x = best = None
        buffer = np.empty(TILE[0] * TILE[1], np.float32)
        waiting: list[np.ndarray] = []

        def score() -> None:
            data = np.concatenate(waiting)
            waiting.clear()
            y = np.ascontiguousarray(data["v"])
            for lo in range(0, len(rows), TILE[0]):
                q = x[lo : lo + TILE[0]]
                for at in range(0, len(y), TILE[1]):
                    z = y[at : at + TILE[1]]
                    s = np.matmul(q, z.T, out=buffer[: len(q) * len(z)].reshape(len(q), len(z)))
                    least = best.least[lo : lo + TILE[0]]
                    if least.min() < -1 and len(z) > k + 1:  # a first bound; the query itself may be among them
                        least = np.maximum(least, np.partition(s, len(z) - k - 1, 1)[:, len(z) - k - 1] - best.slack)
                        best.least[lo : lo + TILE[0]] = least
                    i, j = np.divmod(np.flatnonzero(s >= least[:, None]), len(z))
                    other = data["row"][at + j]
                    new = other != rows[lo + i]
                    i, j = i[new], j[new]
                    if len(i):
                        exact = np.einsum("ij,ij->i", q[i].astype(np.float64), z[j].astype(np.float64))
                        best.add(lo + i, s[i, j], other[new], np.minimum(exact, 1.0))
            best.reduce()

        for b in batches:
            for is_data, block in zip(b.column("data").to_pylist(), b.column("block").to_pylist(), strict=True):
                if not is_data:
                    parts.append(block)
                    continue
                if rows is None:  # the queries come first
                    mine = np.frombuffer(b"".join(parts), rec)
                    rows, x, best = mine["row"].copy(), np.ascontiguousarray(mine["v"]), _Best(len(mine), k)
                waiting.append(np.frombuffer(block, rec))
                if sum(map(len, waiting)) >= 8 * TILE[1]:
                    score()
        if waiting:
            score()
        if best is not None:
            query, _, other, exact = best.reduce()
            for lo in range(0, len(query), 100_000):
                s = slice(lo, lo + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(rows[query[s]]), pa.array(other[s]), pa.array(exact[s])], ["row", "other", "cosine"])

    return work


def nearest(chunks: DataFrame, k: int = Params.k, dim: int = DIM) -> DataFrame:
    """``field, id, neighbour, rank, cosine``: the ``k`` nearest of every valid vector among the others of its field, exactly.

    There are fewer only where the field has fewer others. Ties go to the smaller id; invalid vectors, null and
    redelivered ids are treated as in ``similar_pairs``. Every pair of distinct vectors is compared.
    """
    classes, members = _classes(chunks, dim)
    counts = {r[0]: r[1] for r in classes.groupBy((F.col("row") % 4).cast("int")).count().collect()}
    groups = [-(-counts.get(f, 0) // QUERY_ROWS) for f in range(len(FIELDS))]
    blocks = classes.mapInArrow(_spread(groups, dim), "part int, data boolean, block binary")
    parts = blocks.repartitionById(max(1, sum(groups)), F.col("part")).sortWithinPartitions("part", "data")
    near = cut(parts.mapInArrow(_scan(k, dim), "row bigint, other bigint, cosine double"))
    return _named(near.unionByName(_copies(members).select("row", F.col("row").alias("other"), F.lit(1.0).alias("cosine"))), members, k)


def _cosines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        cos = [float(np.dot(np.frombuffer(u, np.float32).astype(np.float64), np.frombuffer(v, np.float32).astype(np.float64))) for u, v in zip(b.column("ua").to_pylist(), b.column("ub").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("row_a"), b.column("row_b"), pa.array(cos, pa.float64())], ["row_a", "row_b", "cosine"])


def similar_pairs(chunks: DataFrame, p: Params = Params(), dim: int = DIM) -> DataFrame:
    """``field, id_a, id_b, cosine`` of pairs at or above ``min_cosine`` of which one is among the other's ``k`` nearest.

    ``id_a < id_b``. Vectors that are null, of another length, not finite or all zero take no part; null ids neither;
    redelivered ids count once. Equal vectors are searched for once; they tie, and ties go to the smaller id. ``p`` sets
    the accuracy. However many partners a vector has, none is left out for another that is less near.
    """
    spark = chunks.sparkSession
    keyed = cut(_keyed(chunks, dim))
    counts = {r[0]: r[1] for r in keyed.groupBy((F.col("row") % 4).cast("int")).count().collect()}
    cells = [plan_cells(counts.get(f, 0), p, dim) for f in range(len(FIELDS))]
    records = sum(counts.get(f, 0) * c.tables for f, c in enumerate(cells))
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-records // SHARD_ROWS))
    blocks = keyed.select("row", "unit").mapInArrow(_emit(p, cells, shards, dim), "shard int, block binary")
    found = cut(blocks.repartition(shards, "shard").mapInArrow(_find(p, dim), "row_a bigint, row_b bigint").distinct())
    copies = cut(_copies(keyed.select("row", "id")))
    asked = found.select(F.explode(F.array("row_a", "row_b")).alias("row")).unionByName(copies).distinct()
    met = cut(only_maybe(keyed, "row", asked))
    units, members = met.select("row", "unit").dropDuplicates(["row"]), met.select("row", "id").distinct()
    sides = found.join(units.select(F.col("row").alias("row_a"), F.col("unit").alias("ua")), "row_a").join(units.select(F.col("row").alias("row_b"), F.col("unit").alias("ub")), "row_b")
    exact = sides.mapInArrow(_cosines, "row_a bigint, row_b bigint, cosine double").where(F.col("cosine") >= p.min_cosine)
    both = exact.select(F.explode(F.array(F.struct(F.col("row_a").alias("row"), F.col("row_b").alias("other")), F.struct(F.col("row_b").alias("row"), F.col("row_a").alias("other")))).alias("p"), F.least("cosine", F.lit(1.0)).alias("cosine"))
    near = both.select("p.row", "p.other", "cosine").unionByName(copies.select("row", F.col("row").alias("other"), F.lit(1.0).alias("cosine")))
    named = _named(near, members, p.k)
    return named.groupBy("field", F.least("id", "neighbour").alias("id_a"), F.greatest("id", "neighbour").alias("id_b")).agg(F.max("cosine").alias("cosine"))
