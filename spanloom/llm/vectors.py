"""What both vector searches share: which vectors take part, cells of bounded size that a query may skip, and the best rows of all.

Vectors are dealt once to cells, which a bounded sample lays out, and written with them; a cell with many rows is dealt on to shards by a hash, so that
a frequent vector spreads. Each query first searches one shard, of the cell that promises most. The kth score found there goes
with it to all other shards of cells whose bound leaves room for a better one, and to no others.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import in_arrow, materialize

#: Vectors in a shard, and queries that meet a shard at once.
SHARD_ROWS, QUERY_BLOCK = 16_384, 4_096
#: With fewer cells a small table would keep a few tasks busy only; more would be too much for a driver's tables.
LEAST_CELLS, MOST_CELLS = 32, 1_024
#: Vectors that cells are laid out from: a bounded sample, chosen by a hash. Every vector is indexed.
SAMPLE = 8_192


def finite(v: Column) -> Column:
    """Neither null nor holding a null or non-finite component, nor empty."""
    big = float("inf")
    return v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (x < big) & (x > -big))


def matrix(column: pa.ChunkedArray, dtype: type = np.float64) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    flat = pa.concat_arrays([c.flatten() for c in column.chunks]) if column.num_chunks else pa.array([], pa.float64())
    n = len(column)
    return flat.to_numpy(zero_copy_only=False).astype(dtype).reshape(n, -1) if n else np.zeros((0, 0), dtype)


def collapse(ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Equal vectors become one point with its smallest ids: k rows of an id and 2 k rows in all, so that k are left without those of any one id."""
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], np.ascontiguousarray(x[order])
    rows = x.view([("", x.dtype)] * x.shape[1]).ravel() if x.shape[1] else np.zeros(len(x))
    _, first, inverse = np.unique(rows, return_index=True, return_inverse=True)
    by = np.argsort(inverse, kind="stable")
    point, own = inverse[by], ids[by]
    new = np.concatenate([[True], (point[1:] != point[:-1]) | (own[1:] != own[:-1])]) if len(by) else np.zeros(0, bool)
    at = np.arange(len(by))
    few = at - np.maximum.accumulate(np.where(new, at, 0)) < k
    point, own = point[few], own[few]
    cuts = np.searchsorted(point, np.arange(len(first) + 1))
    return x[first], [own[a : min(b, a + 2 * k)] for a, b in zip(cuts, cuts[1:])]


class Others:
    """How many rows of each point have another id than a query."""

    def __init__(self, members: list[np.ndarray]) -> None:
        self.counts = np.array([len(m) for m in members], np.int64)
        ids, points = np.concatenate([*members, np.zeros(0, np.int64)]), np.repeat(np.arange(len(members)), self.counts)
        order = np.argsort(ids, kind="stable")
        self.ids, self.points = ids[order], points[order]

    def than(self, me: int) -> np.ndarray:
        a, b = np.searchsorted(self.ids, me, "left"), np.searchsorted(self.ids, me, "right")
        if a == b:
            return self.counts
        out = self.counts.copy()
        np.subtract.at(out, self.points[a:b], 1)
        return out


class Layout(Protocol):
    """Cells of the vectors of one length. ``extent`` are numbers of which a cell keeps the largest over its rows."""

    cells: int

    def deal(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the cell of each row, its extent)."""

    def promise(self, q: np.ndarray, extents: np.ndarray) -> np.ndarray:
        """No row of a cell (column) has a better score with a query (row) than this; larger is better."""


@dataclass
class Map:
    """All cells: by length of vectors the layout, extents of cells that hold rows, and the first shard of each."""

    layouts: dict[int, Layout]
    extents: dict[int, np.ndarray] = field(default_factory=dict)
    rows: dict[int, np.ndarray] = field(default_factory=dict)

    def shards(self, dim: int) -> np.ndarray:
        """How many shards each cell has."""
        return -(-self.rows[dim] // SHARD_ROWS)


def _by_length(b: pa.RecordBatch, at: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places of the rows with that length, their matrix)."""
    lists = b.column(at)
    n = np.diff(lists.offsets.to_numpy())
    for dim in np.unique(n).tolist():
        rows = np.flatnonzero(n == dim)
        yield dim, rows, lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(rows), dim)


def lay_out(vectors: DataFrame, make: Callable[[np.ndarray, int], Layout], shape: Callable[[np.ndarray], np.ndarray]) -> dict[int, Layout]:
    """Cells by length of vectors, from a sample of ``vec_id, v``. A length that the sample lacks has one cell, around nothing."""
    want = min(MOST_CELLS, max(LEAST_CELLS, math.ceil(4 * vectors.count() / SHARD_ROWS)))
    sample: dict[int, list] = {}
    for r in vectors.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(SAMPLE).select("v").collect():
        sample.setdefault(len(r["v"]), []).append(r["v"])
    return {n: make(shape(np.array(x, float)), want) for n, x in sample.items()}


def deal(vectors: DataFrame, layouts: dict[int, Layout], make: Callable[[np.ndarray, int], Layout], shape: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """``vec_id, h, v`` with ``dim, cell, extent``. The last bits of a product depend on which rows are multiplied together, so what this gives must be written, not computed again."""
    names = ["vec_id", "h", "v", "dim", "cell", "extent"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for dim, rows, x in _by_length(b, 2):
                cell, extent = (layouts.get(dim) or make(shape(np.zeros((1, dim))), 1)).deal(shape(x))
                yield pa.RecordBatch.from_arrays([*b.take(pa.array(rows)).columns, pa.array(np.full(len(rows), dim), pa.int32()), pa.array(cell, pa.int32()), pa.array(list(extent), pa.list_(pa.float64()))], names=names)

    return in_arrow(vectors, run, "vec_id bigint, h bigint, v array<double>, dim int, cell int, extent array<double>")


def measure(dealt: DataFrame, layouts: dict[int, Layout], make: Callable[[np.ndarray, int], Layout], shape: Callable[[np.ndarray], np.ndarray]) -> Map:
    """What the cells of a written table hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims, cells = b.column(0).to_numpy(), b.column(1).to_numpy()
            for dim in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == dim)
                cell = cells[rows]
                extent = b.column(2).take(pa.array(rows)).flatten().to_numpy().reshape(len(rows), -1)
                own = np.unique(cell)
                most = np.stack([extent[cell == c].max(0) for c in own])
                yield pa.record_batch({"dim": pa.array(np.full(len(own), dim), pa.int32()), "cell": pa.array(own, pa.int32()), "rows": pa.array(np.bincount(cell)[own], pa.int64()), "extent": pa.array(list(most), pa.list_(pa.float64()))})

    each = in_arrow(dealt.select("dim", "cell", "extent"), run, "dim int, cell int, rows bigint, extent array<double>").select("dim", "cell", "rows", F.posexplode("extent").alias("i", "x"))
    each = each.groupBy("dim", "cell", "i").agg(F.sum("rows").alias("rows"), F.max("x").alias("x"))
    m = Map(dict(layouts))
    for r in each.groupBy("dim", "cell").agg(F.max("rows").alias("rows"), F.sort_array(F.collect_list(F.struct("i", "x"))).alias("e")).collect():  # a row for each cell
        if r["dim"] not in m.layouts:
            m.layouts[r["dim"]] = make(shape(np.zeros((1, r["dim"]))), 1)
        if r["dim"] not in m.rows:
            m.rows[r["dim"]] = np.zeros(m.layouts[r["dim"]].cells, np.int64)
            m.extents[r["dim"]] = np.full((m.layouts[r["dim"]].cells, len(r["e"])), -np.inf)
        m.rows[r["dim"]][r["cell"]] = r["rows"]
        m.extents[r["dim"]][r["cell"]] = [x["x"] for x in r["e"]]
    return m


def search_cells(
    vectors: DataFrame, is_query: Column, make: Callable[[np.ndarray, int], Layout], shape: Callable[[np.ndarray], np.ndarray],
    work: Callable[[pa.Table, pa.Table], pa.Table], score_type: str, k: int, best_first: bool, repeat: bool = True,
) -> DataFrame:
    """``query_id, rank, vec_id, score``. ``work(queries, shard)`` gets ``vec_id, h, v`` of both and ``least`` of the queries, a score that
    k rows are known to reach (null: none), and returns ``query_id, h, vec_id, score`` of the shard's best.

    vectors: ``vec_id, v``; shape: what layouts see of a vector. A query row that is repeated is searched once and, with ``repeat``, answered as often.
    """
    spark = vectors.sparkSession
    layouts = lay_out(vectors, make, shape)
    hashed = F.xxhash64("vec_id", "v")
    dealt = materialize(deal(vectors.select("vec_id", hashed.alias("h"), "v"), layouts, make, shape), "dealt")
    m = measure(dealt, layouts, make, shape)
    shared = spark.sparkContext.broadcast(m)  # MOST_CELLS for each length of vectors that there is
    better = 1 if best_first else -1
    queries = dealt.filter(is_query).groupBy("vec_id", "v").agg(F.count("*").alias("times")).withColumn("h", hashed)
    names = ["vec_id", "h", "v", "dim", "cell", "shard", "least"]
    kinds = f"vec_id bigint, h bigint, v array<double>, dim int, cell int, shard int, least {score_type}"

    def rows_of(b: pa.RecordBatch, rows: np.ndarray, dim: int, cell: np.ndarray, shard: np.ndarray) -> pa.RecordBatch:
        own = b.take(pa.array(rows))
        return pa.RecordBatch.from_arrays([*own.columns[:3], *(pa.array(x, pa.int32()) for x in (np.full(len(rows), dim), cell, shard)), own.column(3)], names=names)

    def homes(m: Map, dim: int, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(promise of each cell, the best of them, and the shard there that a query searches first)."""
        promise = m.layouts[dim].promise(x, m.extents[dim])
        home = np.argmax(promise, 1)
        return promise, home, h % m.shards(dim)[home]

    def go_home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for dim, rows, x in _by_length(b, 2):
                _, home, shard = homes(shared.value, dim, shape(x), b.column(1).to_numpy()[rows])
                yield rows_of(b, rows, dim, home, shard)

    def go_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query to all shards but the first whose cells may hold better rows."""
        for b in batches:
            for part in (b.slice(i, 256) for i in range(0, b.num_rows, 256)):
                for dim, rows, x in _by_length(part, 2):
                    m = shared.value
                    promise, home, first = homes(m, dim, shape(x), part.column(1).to_numpy()[rows])
                    least = part.column(3).take(pa.array(rows)).to_numpy(zero_copy_only=False).astype(float)
                    row, cell = np.nonzero((promise >= np.where(np.isnan(least), -np.inf, better * least)[:, None]) & (m.rows[dim] > 0))
                    each = m.shards(dim)[cell]
                    row, cell = np.repeat(row, each), np.repeat(cell, each)
                    shard = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
                    on = (cell != home[row]) | (shard != first[row])
                    yield rows_of(part, rows[row[on]], dim, cell[on], shard[on])

    none = F.lit(None).cast(score_type).alias("least")
    shards = [(dim, int(c), int(n)) for dim in m.rows for c, n in enumerate(m.shards(dim)) if n]
    shards = F.broadcast(spark.createDataFrame(shards, "dim int, cell int, shards int"))  # a row for each cell
    placed = dealt.join(shards, ["dim", "cell"]).select("vec_id", "h", "v", "dim", "cell", F.pmod("h", "shards").cast("int").alias("shard"), none)
    key = ["dim", "cell", "shard", "block"]

    def meet(asked: DataFrame) -> DataFrame:
        """asked: rows of ``names``. As many blocks for a cell as its queries need; cells without queries aren't shuffled."""
        blocks = asked.groupBy("dim", "cell", "shard").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("blocks"))
        blocks = materialize(blocks.groupBy("dim", "cell").agg(F.max("blocks").alias("blocks")), "blocks")  # a row for each cell at most
        left = asked.join(F.broadcast(blocks), ["dim", "cell"]).withColumn("block", F.pmod(F.col("h"), F.col("blocks")).cast("int")).select(*names, "block")
        right = placed.join(F.broadcast(blocks), ["dim", "cell"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(*names, "block")
        return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(lambda q, c: work(q, c), f"query_id bigint, h bigint, vec_id bigint, score {score_type}")

    found = materialize(meet(in_arrow(queries.select("vec_id", "h", "v", none), go_home, kinds)), "home")
    worst = F.min("score") if best_first else F.max("score")
    least = found.groupBy(F.col("query_id").alias("vec_id"), "h").agg(F.when(F.count("*") >= k, worst).alias("least"))
    asked = queries.select("vec_id", "h", "v").join(least, ["vec_id", "h"], "left").select("vec_id", "h", "v", "least")
    found = found.unionByName(meet(in_arrow(asked, go_on, kinds)))
    if not repeat:
        return _ranked(found, k, best_first)
    times = queries.filter("times > 1").select(F.col("vec_id").alias("query_id"), "h", F.least("times", F.lit(k)).alias("times"))
    found = found.join(times, ["query_id", "h"], "left").withColumn("_n", F.explode(F.sequence(F.lit(1).cast("long"), F.coalesce("times", F.lit(1).cast("long")))))
    return _ranked(found, k, best_first)


def _ranked(found: DataFrame, k: int, best_first: bool) -> DataFrame:
    order = F.col("score").desc() if best_first else F.col("score").asc()
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(order, "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def result(query_ids: list, hashes: list, vec_ids: list, scores: list, kind: pa.DataType) -> pa.Table:
    cat = lambda xs, t: pa.array(np.concatenate(xs) if xs else np.zeros(0), t)
    return pa.table({"query_id": cat(query_ids, pa.int64()), "h": cat(hashes, pa.int64()), "vec_id": cat(vec_ids, pa.int64()), "score": cat(scores, kind)})
