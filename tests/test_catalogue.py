"""Tables of the catalogue: what a writer fills in, batches that are repeated, and a store that later windows don't shuffle again."""

import pytest
from pyspark.sql import functions as F

from spanloom.operators import dedup
from spanloom.plans import tables


@pytest.fixture
def database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS loom_rows")
    tables.create(spark, "loom_rows")
    yield "loom_rows"
    spark.sql("DROP DATABASE loom_rows CASCADE")


def test_rows_get_their_time_and_date(spark, database):
    rows = spark.createDataFrame([("s", "p")], "session_id string, span_id string").withColumn("ts", F.to_timestamp(F.lit("2024-01-02 03:04:05")))
    tables.append(rows, "tf_spans", database)
    tables.append(spark.createDataFrame([("s", "dialog_exhausted", 3)], "session_id string, end_reason string, turns long"), "session_end_reason", database)
    r = spark.table(f"{database}.tf_spans").first()
    assert (r["session_id"], str(r["date"]), r["model"]) == ("s", "2024-01-02", None) and r["inserted_at"] is not None
    assert spark.table(f"{database}.session_end_reason").first()["classified_at"] is not None
    with pytest.raises(ValueError):
        tables.append(rows, "nope", database)


def test_the_store_is_dealt_once(spark, database):
    data = [(dedup_hash, bytearray(b"x%d" % i), 2, 0) for i, dedup_hash in enumerate(f"{i:064x}" for i in range(300))]
    chunks = spark.createDataFrame(data, "hash string, data binary, raw_len int, crc long")
    for batch in (0, 1, 1):
        tables.append(chunks.filter(F.crc32("hash") % 2 == batch).withColumn("batch_id", F.lit(batch)), "cas_chunks", database, replace_batch=True)
    store = spark.table(f"{database}.cas_chunks")
    assert store.count() == 300
    places = spark.createDataFrame([("t", "s", i, -1, 0, 0, f"{i % 300:064x}") for i in range(900)], "trace_id string, span_id string, seq long, event_index int, attr_index int, pos int, hash string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        joined = places.join(store, "hash")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 900
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    # The one exchange deals the places to the store's buckets.
    assert plan.count("Exchange") == 1 and f"hashpartitioning(hash#" in plan and f", {tables.BUCKETS})" in plan
    assert dedup.ref_places is not None
