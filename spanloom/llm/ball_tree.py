"""Exact top-k by inner product: ball-tree branch and bound in each shard (operator 10).

Components become ``floor(256 * x)``. The upper bound of a node's ball is ``q . centre + |q| * radius``. A search keeps a queue of
nodes with the largest bound first, opens inner nodes, scans leaves, and ends when the first bound falls below the kth score;
what is below a node that is never opened costs nothing. Nodes whose bound equals the kth score are still opened, as ties go to
the smaller id.

The kth score is shared: every query first searches the shard that promises most, and starts in all others with the kth score
found there. Cells of shards are balls too, and those whose bound is below that score aren't searched at all.

Defined results: vectors that are null, empty, or hold a null or non-finite component take no part; zero vectors do. Rows
with a null id take no part. Equal vectors of a shard are one point with their smallest ids. A repeated id counts as so
many rows, as query as well, but rows of the query's own id are no candidates. A query with fewer than k candidates gets all. Only vectors of the same length are compared. Scores beyond the
range of a long are held at its ends. An empty table gives no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .vectors import Others, collapse, finite, matrix, result, search_cells

LEAF, LEAST = 32, -(2**63)


def whole(x: np.ndarray) -> np.ndarray:
    return np.floor(256.0 * x)


def exact(points: np.ndarray, queries: np.ndarray) -> bool:
    """Whether no product of these integers can leave what a double holds exactly."""
    return float(np.abs(points).max(initial=0)) * float(np.abs(queries).max(initial=0)) * points.shape[1] < 2**52


def products(points: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact integer inner products as int64."""
    if exact(points, q):
        return (points @ q).astype(np.int64)
    a = [int(v) for v in q]
    return np.array([min(max(sum(int(u) * v for u, v in zip(row, a)), LEAST), 2**63 - 1) for row in points], np.int64)


def halves(own: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Places in the order of a line between two far points; d: distances from the centre."""
    one = own[int(np.argmax(d))]
    other = own[int(np.argmax(((own - one) ** 2).sum(1)))]
    return np.argpartition(own @ (other - one), len(own) // 2)


def slack(b: np.ndarray) -> np.ndarray:
    """A bound that rounding can't bring below what it bounds."""
    return b + 1e-9 * (np.abs(b) + 1)


class BallTree:
    """Nodes in pairs of siblings; ``child`` is the first of a node's two children, or -1 for a leaf."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF) -> None:
        self.order = np.arange(len(points))
        self.span, self.child = [(0, len(points))], [-1]
        centre, radius = [], []
        me = 0
        while me < len(self.span):
            a, b = self.span[me]
            own = points[self.order[a:b]]
            c = own.mean(0)
            d = np.sqrt(((own - c) ** 2).sum(1))
            centre.append(c)
            radius.append(float(d.max()) * (1 + 1e-9) + 1e-9)
            if b - a > leaf and d.max() > 0:
                self.order[a:b] = self.order[a:b][halves(own, d)]
                mid = a + (b - a) // 2
                self.child[me] = len(self.span)
                self.span += [(a, mid), (mid, b)]
                self.child += [-1, -1]
            me += 1
        self.centre, self.radius = np.array(centre), np.array(radius)
        self.safe = False  # whether products of doubles are exact
        self.bounded = self.scanned = 0  # nodes whose bound was computed, leaves that were read

    def bounds(self, a: int, b: int, q: np.ndarray, norm: float) -> list[float]:
        """No point of these nodes has a larger product with q."""
        self.bounded += b - a
        return slack(self.centre[a:b] @ q + norm * self.radius[a:b]).tolist()

    def search(self, points: np.ndarray, counts: np.ndarray, q: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """points, counts (without the query's own rows): in the order of the leaves. Rows and scores of every point that may be among the k best; least: a score that k rows are known to reach."""
        rows, scores = [], []
        best = np.zeros(0, np.int64)
        kth = least
        norm = float(np.sqrt(q @ q))
        queue = [(-b, i) for i, b in enumerate(self.bounds(0, 1, q, norm))]
        while queue:
            bound, node = heapq.heappop(queue)
            if -bound < kth:
                break
            if (first := self.child[node]) >= 0:
                for i, b in enumerate(self.bounds(first, first + 2, q, norm)):
                    if b >= kth:
                        heapq.heappush(queue, (-b, first + i))
                continue
            self.scanned += 1
            a, b = self.span[node]
            s = (points[a:b] @ q).astype(np.int64) if self.safe else products(points[a:b], q)
            hit = np.flatnonzero(s >= kth)
            if len(hit):
                rows.append(hit + a)
                scores.append(s[hit])
                best = np.sort(np.concatenate([best, np.repeat(s[hit], counts[hit + a])]))[::-1][:k]
                if len(best) == k:
                    kth = max(kth, int(best[-1]))
        return (np.concatenate(rows), np.concatenate(scores)) if rows else (np.zeros(0, np.int64), np.zeros(0, np.int64))


class Balls:
    """Cells around centres that a ball tree over a sample has; a cell's extent is its radius and whether it has rows."""

    def __init__(self, sample: np.ndarray, cells: int) -> None:
        sample = np.unique(sample, axis=0)
        tree = BallTree(sample, max(1, len(sample) // cells))
        self.centres = tree.centre[[i for i, c in enumerate(tree.child) if c < 0]]
        self.cells = len(self.centres)

    def deal(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cell = np.empty(len(x), np.int64)
        half = (self.centres**2).sum(1) / 2
        for i in range(0, len(x), 1024):
            cell[i : i + 1024] = np.argmin(half - x[i : i + 1024] @ self.centres.T, 1)
        return cell, np.sqrt(((x - self.centres[cell]) ** 2).sum(1))[:, None]

    def promise(self, q: np.ndarray, extents: np.ndarray) -> np.ndarray:
        r = extents[:, 0] * (1 + 1e-9) + 1e-9
        with np.errstate(invalid="ignore"):
            return np.where(r < 0, -np.inf, slack(q @ self.centres.T + np.sqrt((q * q).sum(1))[:, None] * np.maximum(r, 0)))


def search(q_ids: np.ndarray, queries: np.ndarray, least: list[int | None], ids: np.ndarray, x: np.ndarray, k: int) -> tuple[list, list, list]:
    points, members = collapse(ids, x, k)
    tree = BallTree(points)
    points, members = points[tree.order], [members[i] for i in tree.order]  # a leaf is a slice
    others = Others(members)
    tree.safe = exact(points, queries)
    out_q, out_v, out_s = [], [], []
    for me, q, floor in zip(q_ids, queries, least, strict=True):
        rows, s = tree.search(points, others.than(me), q, k, LEAST if floor is None else floor)
        v = np.concatenate([members[r] for r in rows] or [np.zeros(0, np.int64)])
        s = np.repeat(s, others.counts[rows])
        own = v != me
        v, s = v[own], s[own]
        top = np.lexsort((v, -s.astype(object) if len(s) and s.min() == LEAST else -s))[:k]
        out_q.append(np.full(len(top), me))
        out_v.append(v[top])
        out_s.append(s[top])
    return out_q, out_v, out_s


def top_products(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k largest integer inner products of every row for which ``is_query`` (over ``vec_id``) holds."""
    v = F.col(vec_col)
    rows = vectors.filter(F.col(id_col).isNotNull() & finite(v)).select(F.col(id_col).cast("long").alias("vec_id"), v.cast("array<double>").alias("v"))

    def work(q: pa.Table, c: pa.Table) -> pa.Table:
        if not q.num_rows or not c.num_rows:
            return result([], [], [], [], pa.int64())
        found = search(q["vec_id"].to_numpy(), whole(matrix(q["v"])), q["least"].to_pylist(), c["vec_id"].to_numpy(), whole(matrix(c["v"])), k)
        return result(found[0], [np.full(len(x), h) for x, h in zip(found[0], q["h"].to_pylist())], *found[1:], pa.int64())

    return search_cells(rows, is_query, Balls, whole, work, "bigint", k, best_first=True)
