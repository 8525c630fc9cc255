"""Both vector searches against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.llm import ball_tree, stable_projection
from spanloom.llm import vectors as shared
from spanloom.llm.queries import queries
from spanloom.session import table

SCHEMA = "vec_id bigint, embedding array<float>, label int, score string, v int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if x is None else [None if c is None else float(c) for c in x], 0, "clash", 1) for i, x in rows], SCHEMA)


def odd_rows():
    rng = np.random.default_rng(5)
    same = [0.5, -0.25, 0.75, 0.125]
    rows = [(i, rng.normal(size=4)) for i in range(60)] + [(100 + i, same) for i in range(40)]
    rows += [(200, None), (210, [0, 0, 0, 0]), (220, [1, None, 2, 3]), (230, [1, float("nan"), 2, 3]), (240, [1, float("inf"), 2, 3]), (250, []), (None, same), (260, [1, 2]), (270, [2, 1])]
    return rows + [(7, same), (100, same)]


def usable(rows, zero):
    out = [(i, np.array(x, np.float32).astype(float)) for i, x in rows if i is not None and x is not None and len(x) and all(c is not None for c in x)]
    return [(i, x) for i, x in out if np.isfinite(x).all() and (zero or x.any())]


def nearest(rows, every, k):
    rows = usable(rows, zero=False)
    out = set()
    for q, x in rows:
        if q % every == 0:
            best = sorted({(n, float(np.sqrt(((y - x) ** 2).sum())), i) for n, (i, y) in enumerate(rows) if i != q and len(y) == len(x)}, key=lambda t: (round(t[1], 12), t[2]))[:k]
            out |= {(q, r + 1, i, round(s, 9)) for r, (_, s, i) in enumerate(best)}
    return out


def largest(rows, every, k):
    rows = [(i, [int(np.floor(256 * c)) for c in x]) for i, x in usable(rows, zero=True)]
    out = set()
    for q, x in rows:
        if q % every == 0:
            best = sorted(((sum(a * b for a, b in zip(x, y)), i) for i, y in rows if i != q and len(y) == len(x)), key=lambda t: (-t[0], t[1]))[:k]
            out |= {(q, r + 1, i, s) for r, (s, i) in enumerate(best)}
    return out


def distinct_ids(rows):
    seen, out = set(), []
    for i, x in rows:
        if i is None or i not in seen:
            out.append((i, x))
        seen.add(i)
    return out


def test_nearest_with_odd_rows(spark):
    rows = distinct_ids(odd_rows())
    got = stable_projection.nearest(vectors(spark, rows), F.col("vec_id") % 10 == 0, k=10).collect()
    got = {(r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in got}
    want = nearest(rows, 10, 10)
    assert len(got) == len(want) and len(got & want) >= 0.95 * len(want)
    assert {r for r in got if r[0] in (260, 270)} == {r for r in want if r[0] in (260, 270)}


def test_top_products_with_odd_rows(spark):
    rows = distinct_ids(odd_rows())
    got = ball_tree.top_products(vectors(spark, rows), F.col("vec_id") % 10 == 0, k=5).collect()
    assert {tuple(r) for r in got} == largest(rows, 10, 5)


def test_repeated_ids_run(spark):
    rows = odd_rows()
    assert ball_tree.top_products(vectors(spark, rows), F.col("vec_id") % 10 == 0).count() > 0
    assert stable_projection.nearest(vectors(spark, rows), F.col("vec_id") % 10 == 0).count() > 0


def test_huge_components(spark):
    rows = [(i, [10.0**15 * (i + 1), 1.0]) for i in range(4)]
    got = {tuple(r) for r in ball_tree.top_products(vectors(spark, rows), F.col("vec_id") == 0, k=2).collect()}
    assert {r[2] for r in got} == {1, 2} or {r[2] for r in got} == {2, 3}
    assert all(r[3] <= 2**63 - 1 for r in got)


@pytest.mark.parametrize("f", [stable_projection.nearest, ball_tree.top_products])
def test_empty_table(spark, f):
    assert f(vectors(spark, []), F.col("vec_id") % 10 == 0).count() == 0


def test_recall_on_the_table(spark, sf):
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, sf, "embeddings").collect()]
    got = {(r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in queries()["op1_stable_projection"](spark, sf).collect()}
    want = nearest(rows, 100, 10)
    assert len(got & want) >= 0.9 * len(want)


def test_products_of_the_table(spark, sf):
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, sf, "embeddings").collect()]
    assert {tuple(r) for r in queries()["op10_ball_tree"](spark, sf).collect()} == largest(rows, 50, 5)


def test_chi_square():
    assert abs(stable_projection.chi_square(stable_projection.threshold(8, 0.95), 8) - 0.95) < 1e-9
    assert abs(stable_projection.threshold(8, 0.95) - 15.507) < 1e-2


# What trees leave out


def clusters(n=6000, dim=16):
    rng = np.random.default_rng(12)
    return rng.normal(size=(40, dim))[rng.integers(40, size=n)] + 0.05 * rng.normal(size=(n, dim))


def test_ball_tree_opens_few_nodes():
    x = ball_tree.whole(clusters())
    tree = ball_tree.BallTree(x)
    x, tree.safe = x[tree.order], True
    leaves, tries = sum(c < 0 for c in tree.child), x[::300]
    for q in tries:
        rows, s = tree.search(x, np.ones(len(x), int), q, 5, ball_tree.LEAST)
        assert sorted(s)[-5:] == sorted((x @ q).astype(int))[-5:]
    assert tree.scanned < 0.25 * leaves * len(tries) and tree.bounded < 0.4 * len(tree.child) * len(tries)
    read = tree.scanned
    for q in tries:  # with the kth score known from the start
        tree.search(x, np.ones(len(x), int), q, 5, int(np.sort(x @ q)[-5]))
    assert tree.scanned - read <= read


def test_projected_neighbours_come_in_order_and_end_early():
    x = clusters()
    tree = stable_projection.KdTree(x @ stable_projection.weights(16, 8, 7))
    q = x[5] @ stable_projection.weights(16, 8, 7)
    r = np.concatenate([r for r, _ in _drain(tree.neighbours(q))])
    assert len(r) == len(x) and (np.diff(r) >= 0).all()
    count = []
    ids = np.arange(len(x))
    _, v, s = stable_projection.search(ids[::300], x[::300], ids, x, 10, count=count)
    exact = [set(np.argsort(((x - p) ** 2).sum(1), kind="stable")[1:11]) for p in x[::300]]
    assert np.mean([len(set(a) & b) / 10 for a, b in zip(v, exact)]) >= 0.9
    assert count[1] < 0.2 * len(x) * len(x[::300])


def _drain(run):
    item = next(run, None)
    while item is not None:
        yield item
        try:
            item = run.send(float("inf"))
        except StopIteration:
            return


def test_cells_are_left_out():
    x = ball_tree.whole(clusters())
    layout = ball_tree.Balls(x[::4], 32)
    cell, extent = layout.deal(x)
    extents = np.full((layout.cells, 1), -np.inf)
    np.maximum.at(extents[:, 0], cell, extent[:, 0])
    q = x[::300]
    promise = layout.promise(q, extents)
    best = np.full((len(q), layout.cells), -np.inf)
    for c in np.unique(cell):
        best[:, c] = (q @ x[cell == c].T).max(1)
    assert (best <= promise).all()
    kth = np.sort(q @ x.T, 1)[:, -5]
    assert (promise >= kth[:, None]).mean() < 0.4
    boxes = stable_projection.Boxes(x[::4, :8], 32, 16.0)
    cell, extent = boxes.deal(x[:, :8])
    assert len(np.unique(cell)) == boxes.cells >= 32
    extents = np.stack([extent[cell == c].max(0) for c in range(boxes.cells)])
    for c in range(boxes.cells):
        d = np.sqrt(((q[:, None, :8] - x[None, cell == c, :8]) ** 2).sum(2)).min(1)
        assert (boxes.promise(q[:, :8], extents)[:, c] >= -d / 4 - 1e-9).all()


def test_vectors_are_dealt_once(spark, sf, monkeypatch):
    """Cells, extents and shards come from one written table, whatever batches a later reading makes."""
    calls = []
    monkeypatch.setattr(shared, "deal", lambda *a, real=shared.deal: calls.append(1) or real(*a))
    df = table(spark, sf, "embeddings")
    want = ball_tree.top_products(df, F.col("vec_id") % 50 == 0).collect()
    assert len(calls) == 1
    monkeypatch.setattr(shared, "SHARD_ROWS", 7)  # many shards, and other batches
    got = ball_tree.top_products(df.repartition(9), F.col("vec_id") % 50 == 0).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
