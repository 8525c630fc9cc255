"""Percentiles by a running sum over counts of values, against the built-in ones."""

import random

from pyspark.sql import functions as F

from spanloom.plans.marts import _tallied


def test_ranks_nulls_and_ties(spark):
    r = random.Random(3)
    rows = [(k, None if r.random() < 0.2 else r.randrange(m), r.choice([None, 1, 5])) for k, n, m in (("a", 200, 1000), ("b", 7, 3), ("c", 2, 90), ("d", 1, 9)) for _ in range(n)]
    df = spark.createDataFrame([*rows, ("e", None, None), (None, 4, 2)], "k string, v long, w long")
    got = _tallied(df, ("k",), "v", {"p50": 0.5, "p90": 0.9}, "w")
    want = df.groupBy("k").agg(F.count("*").alias("n"), F.avg("v").alias("avg_v"), F.avg("w").alias("avg_w"), F.percentile("v", 0.5).alias("p50"), F.percentile("v", 0.9).alias("p90"))
    assert got.columns == want.columns
    near = lambda rows: sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in t) for t in rows), key=str)
    assert near(got.collect()) == near(want.collect())


def test_empty(spark):
    assert _tallied(spark.createDataFrame([], "k string, v long"), ("k",), "v", {"p50": 0.5}).count() == 0
