"""Rows that repeat an id with another text or vector."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.llm import ball_tree, prefix_join, stable_projection
from spanloom.llm.queries import OP10_SQL

T1, T2 = "one two three four five six", " ".join(f"w{i}" for i in range(60))
T3 = T2 + " end"


def test_a_repeated_id_hides_no_link(spark):
    for other in (T1, T1 + " 0"):  # sets whose hash is smaller and larger than that of T2
        df = spark.createDataFrame([(5, other), (5, T2), (7, T2), (9, T3)], "doc_id bigint, text string")
        got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in prefix_join.link_components(df).collect()}
        assert got == {(5, len(other.split()) - 3, 5), (5, 57, 5), (7, 57, 5), (9, 58, 5)}


def test_texts_of_one_id_have_their_own_components(spark):
    rows = [(3, T1), (5, T1), (5, T2), (7, T2), (9, T3), (9, T3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in prefix_join.link_components(df).collect())
    assert got == [(3, 3, 3), (5, 3, 3), (5, 57, 5), (7, 57, 5), (9, 58, 5), (9, 58, 5)]


def test_keep_first_drops_by_text(spark):
    rows = [(2, T3), (5, T1), (5, T2), (7, T2)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(map(tuple, prefix_join.keep_first(df, 4, 85).collect())) == [(2, T3), (5, T1)]


def test_repeats_are_verified_once(spark, monkeypatch):
    compared = []
    real = prefix_join.similarities

    def counted(pairs, *more):
        out = real(pairs, *more)
        compared.append((pairs.count(), out.count()))
        return out

    monkeypatch.setattr(prefix_join, "similarities", counted)
    df = spark.createDataFrame([(5, T2)] * 200 + [(7, T3)] * 300 + [(7, T1)] * 3, "doc_id bigint, text string")
    got = prefix_join.link_components(df).groupBy("doc_id", "n_shingles", "component_id").count().collect()
    assert sorted(map(tuple, got)) == [(5, 57, 5, 200), (7, 3, 7, 3), (7, 58, 5, 300)]
    assert all(a == b <= 2 for a, b in compared)


# Vectors


def repeated_vectors():
    rng = np.random.default_rng(8)
    far = [(i, [float(c) for c in rng.integers(-8, 9, 3)]) for i in range(1, 60) if i % 50]
    same = [(100 + i, [3.0, 1.0, 2.0]) for i in range(1, 30)]
    return far + same + [(0, [3.0, 1.0, 2.0])] * 25 + [(50, [1.0, 1.0, 1.0])] * 2 + [(50, [-5.0, 0.0, 4.0])] + [(7, [1.0, 1.0, 1.0])] * 30


def brute_nearest(rows, k):
    out = set()
    for q in (0, 50):
        near = []
        for x in {tuple(x) for i, x in rows if i == q}:
            near += [(float(np.sqrt(((np.array(y) - x) ** 2).sum())), i) for i, y in rows if i != q]
        out |= {(q, n + 1, i, round(d, 9)) for n, (d, i) in enumerate(sorted(near)[:k])}
    return out


@pytest.mark.parametrize("shift", [0, 1000])
def test_nearest_of_repeated_ids(spark, shift):
    rows = [(i + shift, x) for i, x in repeated_vectors()]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = {(r["query_id"] - shift, r["rank"], r["vec_id"] - shift, round(r["score"], 9)) for r in stable_projection.nearest(df, F.col("vec_id").isin(shift, 50 + shift)).collect()}
    assert got == brute_nearest([(i - shift, x) for i, x in rows], 10)


def test_products_of_repeated_ids_match_sql(spark):
    df = spark.createDataFrame(repeated_vectors(), "vec_id bigint, embedding array<float>")
    con = duckdb.connect()
    embeddings = df.toArrow()  # noqa: F841
    want = con.execute(OP10_SQL).fetchall()
    got = ball_tree.top_products(df, F.col("vec_id") % 50 == 0, k=5).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_own_rows_take_no_place():
    x = np.array([[1.0, 2.0]] * 40 + [[1.0, 2.0]] * 5 + [[0.5, 0.0]] * 3)
    ids = np.array([3] * 40 + [11, 12, 13, 14, 15] + [21, 22, 23])
    _, v, _ = stable_projection.search(np.array([3]), x[:1], ids, x, 7)
    assert v[0].tolist() == [11, 12, 13, 14, 15, 21, 22]
    _, v, _ = ball_tree.search(np.array([3]), x[:1], [None], ids, x, 7)
    assert v[0].tolist() == [11, 12, 13, 14, 15, 21, 22]
