"""Bundles as data sources: what a commit leaves, what a failed one doesn't, and which bytes a reader touches."""

import os

import pytest
from pyspark.sql import functions as F

from spanloom.sources import bundles

LINES = "trace_id string, session_id string, value string, seq long, date string, hour int"


def lines(spark, n=60):
    return spark.createDataFrame([(f"t{i % 12}", f"s{i % 4}" if i % 5 else "", f'{{"n":{i}}}', i, f"2024-01-0{1 + i % 2}", i % 3) for i in range(n)], LINES)


def files(path):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(path) for f in names)


@pytest.fixture
def packed(spark, tmp_path):
    path = f"{tmp_path}/bundles"
    bundles.write(bundles.pack(lines(spark)), f"file://{path}", bundle_bytes=60)
    return path


def test_all_lines_come_back_with_and_without_the_index(spark, packed):
    url = f"file://{packed}"
    want = sorted(r["value"] for r in lines(spark).collect())
    got = bundles.read(spark, url)
    assert sorted(r["value"] for r in got.collect()) == want and sorted(r["value"] for r in bundles.read_lines(spark, url).collect()) == want
    index = bundles.index(spark, url).collect()
    assert len(index) == 12 and len({r["path"] for r in index}) == 6  # two frames fill one
    one = got.filter("trace_id = 't7'").collect()
    assert sorted(r["value"] for r in one) == sorted(r["value"] for r in lines(spark).filter("trace_id = 't7'").collect())
    assert [r["seq"] for r in one] == list(range(5)) and {r["session_id"] for r in one} == {"s3"}


def test_only_wanted_frames_are_read(spark, packed):
    url = f"file://{packed}"
    index = bundles.index(spark, url).collect()
    for r in index:
        if r["trace_id"] != "t7":
            with open(f"{packed}/{r['path']}", "r+b") as f:
                f.seek(r["offset"])
                f.write(b"\0" * r["len"])
    assert bundles.read(spark, url).filter("trace_id = 't7'").count() == 5
    assert bundles.read(spark, url).filter("trace_id IN ('t7', 'none') AND hour = 1").count() == 5
    assert bundles.read(spark, url).filter("trace_id = 't7' AND hour = 2").count() == 0
    places = bundles.index(spark, url).filter(F.col("trace_id") == "t7")
    assert bundles.read_frames(places, url).count() == 5
    with pytest.raises(Exception, match="zstd|frame"):
        bundles.read(spark, url).collect()


def test_folders_leave_bundles_out_before_tasks_start(packed):
    from pyspark.sql.datasource import EqualTo

    r = bundles.BundleReader(f"file://{packed}")
    assert list(r.pushFilters([EqualTo(("hour",), 1), EqualTo(("value",), "x")])) == [EqualTo(("value",), "x")]
    names = [n for p in r.partitions() for n in p.indexes]
    assert names and all("/hour=1/" in n for n in names)


def test_a_failed_write_leaves_nothing(spark, packed):
    before = files(packed)
    boom = bundles.pack(lines(spark)).withColumn("frame", F.when(F.col("trace_id") == "t11", F.raise_error("no more")).otherwise(F.col("frame")))
    with pytest.raises(Exception, match="no more"):
        bundles.write(boom, f"file://{packed}")
    assert files(packed) == before and bundles.read(spark, f"file://{packed}").count() == 60


def test_appended_and_empty_writes(spark, packed):
    url = f"file://{packed}"
    bundles.write(bundles.pack(lines(spark, 10)), url)
    assert bundles.read(spark, url).count() == 70
    bundles.write(bundles.pack(lines(spark).limit(0)), url)
    assert bundles.read(spark, url).count() == 70 and bundles.read(spark, url + "-none").count() == 0


def test_overwrite_replaces(spark, packed):
    w = bundles.pack(lines(spark, 10)).write.format(bundles.FORMAT).mode("overwrite")
    w.save(f"file://{packed}")
    assert bundles.read(spark, f"file://{packed}").count() == 10 and len(bundles._indexes(packed)) == len([f for f in files(packed) if f.endswith(".zst")])
