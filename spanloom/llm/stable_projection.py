"""Approximate nearest neighbours by stable projections (operator 1).

Vectors are projected to a few dimensions with Gaussian (2-stable) weights, the same everywhere, and the projections are indexed by
kd-trees: one over a sample lays out the cells of shards, and each shard has one of its own. A query takes its projected
neighbours one after another, in increasing distance, from a queue of nodes; each is verified by the exact distance, and then
a chi-square test may end the search: the squared projected distance over the squared distance follows a chi-square law with
as many degrees of freedom as dimensions, so once the projected distance ``r`` satisfies ``chi2(r**2 / d_k**2) >= confidence`` for the
kth distance ``d_k`` found so far, a closer vector that has not come yet is that unlikely. Nodes beyond that are never opened.

The kth distance is shared: a query first searches the shard that is nearest in projection, and takes the distance found there
to all others; cells that the same test rules out aren't searched. Every row is indexed.

Defined results: vectors that are null, zero, empty, or hold a null or non-finite component take no part, neither as query
nor as candidate; rows with a null id neither. Equal distances are ordered by the smaller id; equal vectors of a shard are
one point with their smallest ids, whatever their number. A repeated id counts as so many rows, but rows of the query's own id
are no candidates. Each distinct vector of a query's id is searched once, and the k best of all are kept. A query with fewer
than k candidates gets all. Vectors are compared only with those of the same length. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
from bisect import insort

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .vectors import Others, collapse, finite, matrix, result, search_cells

#: Projected dimensions (even), rows of a leaf, confidence of the stopping test.
DIMENSIONS, LEAF, CONFIDENCE = 8, 128, 0.97


def chi_square(x: np.ndarray | float, degrees: int) -> np.ndarray | float:
    """The distribution function for an even number of degrees, in closed form."""
    h = np.asarray(x, float) / 2
    term = total = np.ones_like(h)
    for i in range(1, degrees // 2):
        term = term * h / i
        total = total + term
    return 1 - np.exp(-h) * total


def threshold(degrees: int, confidence: float) -> float:
    """The squared ratio at which ``chi_square`` reaches the confidence."""
    lo, hi = 0.0, 1000.0
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi_square(mid, degrees) < confidence else (lo, mid)
    return hi


class KdTree:
    """Nodes cut at the median of their widest side, in pairs of siblings; ``child`` is the first of a node's two children, or -1 for a leaf."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF) -> None:
        self.order = np.arange(len(points))
        self.span, self.child, self.cut = [(0, len(points))], [-1], [(0, 0.0)]
        low, high = [], []
        me = 0
        while me < len(self.span):
            a, b = self.span[me]
            own = points[self.order[a:b]]
            low.append(own.min(0))
            high.append(own.max(0))
            axis = int(np.argmax(high[me] - low[me]))
            if b - a > leaf and high[me][axis] > low[me][axis]:
                by = np.argpartition(own[:, axis], (b - a) // 2)
                self.order[a:b] = self.order[a:b][by]
                mid = a + (b - a) // 2
                self.child[me] = len(self.span)
                self.cut[me] = axis, float(own[by[(b - a) // 2], axis])
                self.span += [(a, mid), (mid, b)]
                self.child += [-1, -1]
                self.cut += [(0, 0.0)] * 2
            me += 1
        self.low, self.high = np.array(low), np.array(high)
        self.points = points[self.order]
        self.bounded = self.verified = 0  # nodes whose distance was computed, points that were verified

    def gaps(self, a: int, b: int, q: np.ndarray) -> list[float]:
        """Squared distances of the boxes of these nodes."""
        self.bounded += b - a
        gap = np.maximum(0, np.maximum(self.low[a:b] - q, q - self.high[a:b]))
        return np.einsum("ij,ij->i", gap, gap).tolist()

    def neighbours(self, q: np.ndarray):
        """(squared projected distances, places in ``order``) in runs; distances increase within and between runs. ``send`` a distance beyond which none are wanted."""
        queue = [(d, 0) for d in self.gaps(0, 1, q)]
        wait_d, wait_at = np.zeros(0), np.zeros(0, np.int64)  # points of open leaves that come later
        most = math.inf
        while queue or len(wait_d):
            reach = queue[0][0] if queue else math.inf
            ready = wait_d <= reach
            if ready.any():
                by = np.argsort(wait_d[ready], kind="stable")
                most = yield wait_d[ready][by], wait_at[ready][by]
                wait_d, wait_at = wait_d[~ready], wait_at[~ready]
            if not queue:
                break
            d, node = heapq.heappop(queue)
            if d > most:
                return
            if (first := self.child[node]) >= 0:
                for i, g in enumerate(self.gaps(first, first + 2, q)):
                    heapq.heappush(queue, (g, first + i))
            else:
                a, b = self.span[node]
                x = self.points[a:b] - q
                wait_d, wait_at = np.append(wait_d, np.einsum("ij,ij->i", x, x)), np.append(wait_at, np.arange(a, b))


class Boxes:
    """Cells that a kd-tree over a sample cuts projected space into; a cell's extent are the far sides of its box, the low ones negated."""

    def __init__(self, sample: np.ndarray, cells: int, limit: float) -> None:
        tree = KdTree(sample, max(1, len(sample) // cells))
        self.limit = limit
        self.child, self.cut = np.array(tree.child), tree.cut
        leaves = np.flatnonzero(self.child < 0)
        self.cells, self.number = len(leaves), {int(n): i for i, n in enumerate(leaves)}

    def deal(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cell = np.zeros(len(p), np.int64)
        todo = [(0, np.arange(len(p)))]
        while todo:
            node, rows = todo.pop()
            if (first := int(self.child[node])) < 0:
                cell[rows] = self.number[node]
            else:
                axis, at = self.cut[node]
                low = p[rows, axis] < at
                todo += [(first, rows[low]), (first + 1, rows[~low])]
        return cell, np.concatenate([p, -p], 1)

    def promise(self, q: np.ndarray, extents: np.ndarray) -> np.ndarray:
        """Minus the kth distance from which on the test would end the search before the box."""
        m = q.shape[1]
        total = np.zeros((len(q), len(extents)))
        for j in range(m):
            gap = np.maximum(0, np.maximum(-extents[:, m + j] - q[:, j : j + 1], q[:, j : j + 1] - extents[:, j]))
            total += np.minimum(gap, 1e150) ** 2
        return -np.sqrt(total / self.limit) * (1 - 1e-12)


def weights(dim: int, degrees: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim, degrees]).standard_normal((dim, degrees))


def distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    d = x - q
    return np.sqrt(np.einsum("ij,ij->i", d, d))


def search(
    q_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int, confidence: float = CONFIDENCE, degrees: int = DIMENSIONS, seed: int = 7,
    least: list[float | None] | None = None, count: list[int] | None = None,
) -> tuple[list, list, list]:
    """The k nearest of one shard for each query: lists of query ids, vector ids and distances. least: a distance within which k rows are known to be; count: takes the numbers of bounded nodes and verified points."""
    points, members = collapse(ids, x, k)
    w = weights(x.shape[1], degrees, seed)
    tree, limit = KdTree(points @ w), threshold(degrees, confidence)
    points, members = points[tree.order], [members[i] for i in tree.order]
    out_q, out_v, out_s = [], [], []
    others = Others(members)
    for me, q, p, known in zip(q_ids, queries, queries @ w, least or [None] * len(q_ids), strict=True):
        counts = others.than(me)
        best = [math.inf] * k if known is None else [known] * k  # distances of the nearest so far
        rows, dist = [np.zeros(0, np.int64)], [np.zeros(0)]
        run = tree.neighbours(p)
        more, ended = next(run, None), False
        while more is not None and not ended:
            r2, at = more
            d, a = distances(q, points[at]), 0
            while a < len(at):
                # While no neighbour is nearer than the kth, the test asks the same of all: the first to pass it ends the search.
                stop = max(a, int(np.searchsorted(r2, max(limit * best[-1] ** 2, 5e-324))))
                nearer = np.flatnonzero(d[a:stop] < best[-1])
                upto = a + int(nearer[0]) + 1 if len(nearer) else stop
                tree.verified += upto - a
                if len(nearer):
                    i = upto - 1
                    for _ in range(min(int(counts[at[i]]), k)):
                        insort(best, float(d[i]))
                    del best[k:]
                elif stop < len(at):
                    ended = True
                    break
                a = upto
            kept = np.flatnonzero(d[:a] <= best[-1])
            rows.append(at[kept])
            dist.append(d[kept])
            if not ended:
                try:
                    more = run.send(limit * best[-1] ** 2)
                except StopIteration:
                    more = None
        d = np.concatenate(dist)
        near = d <= best[-1]
        chosen = np.concatenate(rows)[near]
        v = np.concatenate([members[r] for r in chosen] or [np.zeros(0, np.int64)])
        s = np.repeat(d[near], others.counts[chosen])
        own = v != me
        v, s = v[own], s[own]
        top = np.lexsort((v, s))[:k]
        out_q.append(np.full(len(top), me))
        out_v.append(v[top])
        out_s.append(s[top])
    if count is not None:
        count += [tree.bounded, tree.verified]
    return out_q, out_v, out_s


def nearest(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 10, confidence: float = CONFIDENCE, degrees: int = DIMENSIONS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found for every row for which ``is_query`` (over ``vec_id``) holds."""
    if degrees % 2 or not math.isfinite(confidence):
        raise ValueError("the number of projected dimensions must be even")
    v = F.col(vec_col)
    rows = vectors.filter(F.col(id_col).isNotNull() & finite(v)).filter(F.exists(v, lambda x: x != 0)).select(F.col(id_col).cast("long").alias("vec_id"), v.cast("array<double>").alias("v"))
    seed, limit = 7, threshold(degrees, confidence)

    def work(q: pa.Table, c: pa.Table) -> pa.Table:
        if not q.num_rows or not c.num_rows:
            return result([], [], [], [], pa.float64())
        found = search(q["vec_id"].to_numpy(), matrix(q["v"]), c["vec_id"].to_numpy(), matrix(c["v"]), k, confidence, degrees, seed, q["least"].to_pylist())
        return result(found[0], [np.full(len(x), h) for x, h in zip(found[0], q["h"].to_pylist())], *found[1:], pa.float64())

    return search_cells(rows, is_query, lambda x, n: Boxes(x, n, limit), lambda x: x @ weights(x.shape[1], degrees, seed), work, "double", k, best_first=False, repeat=False)
