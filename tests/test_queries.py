"""Every query of the engine against its SQL twin, on the smallest tables."""

import os

import duckdb
import pytest

from spanloom.plans import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con(request):
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    sf = "/root/testdata/sf0.001"
    for t in os.listdir(sf):
        c.execute(f"CREATE VIEW {t.split('.')[0]} AS SELECT * FROM read_parquet('{sf}/{t}')")
    return c


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(round(r[i], 9) if isinstance(r[i], float) else r[i] for i in order) for r in data), key=str)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf, con, name):
    got = QUERIES[name](spark, sf)
    want = con.execute(SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert rows(got.columns, got.collect()) == rows(columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
