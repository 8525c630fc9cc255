"""Deduplication across batches, its counters, and messages that don't parse."""

import hashlib
import time

from conftest import kvs, span
from pyspark.sql import functions as F

from spanloom.functions import attrs as A
from spanloom.operators import dedup
from spanloom.sources import otlp, raw, thin
from spanloom.streaming import metrics, runner

TEXTS = [c * 2000 for c in "abcaabdcae"]


def heavy_spans(spans_df, first=0, texts=TEXTS):
    return spans_df([span(trace_id=f"{first + i:032x}", span_id=f"{first + i:016x}", attributes=kvs(gen_ai__system_instructions=t, session__id="s"), seq=first + i) for i, t in enumerate(texts)])


def ended(listener, query):
    until = time.time() + 30
    while str(query.runId) not in listener.ended and time.time() < until:
        time.sleep(0.05)
    assert str(query.runId) in listener.ended


def test_batches_store_each_chunk_once_and_read_no_old_one(spark, spans_df, tmp_path):
    base = f"file://{tmp_path}"
    for k in range(5):
        otlp.encode(heavy_spans(spans_df, 2 * k, TEXTS[2 * k : 2 * k + 2])).coalesce(1).write.mode("append").parquet(f"{base}/raw")
    sink, listener = runner.Tables(spark, f"{base}/tables"), metrics.DedupMetrics()
    spark.streams.addListener(listener)
    try:
        stream = lambda: otlp.decode_all(raw.raw_stream(spark, "parquet", f"{base}/raw", maxFilesPerTrigger="1"))
        q = runner.run_dedup(stream(), sink, f"{base}/c")
        q.awaitTermination()
        ended(listener, q)
    finally:
        spark.streams.removeListener(listener)
    stored = sink.read("chunks").collect()
    assert sorted(r["hash"] for r in stored) == sorted(hashlib.sha256(t.encode()).hexdigest() for t in set(TEXTS))
    assert len({r["batch_id"] for r in stored}) > 2
    want = dedup.dedup_stats(heavy_spans(spans_df)).collect()[0].asDict()
    assert want == {k: listener.totals[k] for k in want} and listener.rows(spark).collect()[0]["hits"] == 5
    back = dedup.restore(thin.decode(sink.read("thin").select("value", "seq")), sink.read("chunks"))
    assert sorted(r["t"] for r in back.select(A.string("gen_ai.system_instructions").alias("t")).collect()) == sorted(TEXTS)
    # Without the old chunks the stream still knows them: what comes now is written, what came before isn't read.
    sink.reset("chunks")
    otlp.encode(heavy_spans(spans_df, 50, ["a" * 2000, "z" * 2000])).coalesce(1).write.mode("append").parquet(f"{base}/raw")
    runner.run_dedup(stream(), sink, f"{base}/c").awaitTermination()
    assert [r["hash"] for r in sink.read("chunks").collect()] == [hashlib.sha256(b"z" * 2000).hexdigest()]


def test_known_chunks_and_content_cuts(spark, spans_df, tmp_path):
    base = f"file://{tmp_path}"
    otlp.encode(heavy_spans(spans_df)).write.parquet(f"{base}/raw")
    sink = runner.Tables(spark, f"{base}/tables")
    known = spark.createDataFrame([(hashlib.sha256(b"a" * 2000).hexdigest(),)], "hash string")
    runner.run_dedup(otlp.decode(raw.raw_stream(spark, "parquet", f"{base}/raw")), sink, f"{base}/c", known=known).awaitTermination()
    assert sink.read("chunks").count() == len(set(TEXTS)) - 1 and not sink.exists("quarantine")
    runner.run_dedup(otlp.decode(raw.raw_stream(spark, "parquet", f"{base}/raw")), runner.Tables(spark, f"{base}/cut"), f"{base}/c2", kind="fastcdc").awaitTermination()
    assert runner.Tables(spark, f"{base}/cut").read("thin").count() == len(TEXTS)


def test_a_bad_message_lands_in_quarantine(spark, spans_df, tmp_path):
    base = f"file://{tmp_path}"
    good = otlp.encode(heavy_spans(spans_df, texts=TEXTS[:3]))
    good.unionByName(spark.createDataFrame([(bytearray(b"broken"), 7)], otlp_messages())).write.parquet(f"{base}/raw")
    sink = runner.Tables(spark, f"{base}/tables")
    runner.run_dedup(otlp.decode_all(raw.raw_stream(spark, "parquet", f"{base}/raw")), sink, f"{base}/c").awaitTermination()
    assert sink.read("thin").count() == 3
    assert [(bytes(r["value"]), r["seq"]) for r in sink.read("quarantine").collect()] == [(b"broken", 7)]
    # Another message than these three: null, which is an empty request.
    odd = spark.createDataFrame([(None, 1), (bytearray(b"broken"), None)], otlp_messages())
    assert [tuple(r) for r in otlp.decode_all(odd).select("seq", "bad").collect()] == [(None, bytearray(b"broken"))]


def otlp_messages():
    return "value binary, seq bigint"


def test_late_offsets_keep_their_order(spark, spans_df):
    value = otlp.encode(heavy_spans(spans_df, texts=TEXTS[:1])).first()["value"]
    orders = [0, 1, 8_600_000_000, 17_000_000_000 * 1024, 2**44, 2**46, 2**62]
    got = otlp.decode(spark.createDataFrame([(value, n) for n in orders], otlp_messages())).select("seq").collect()
    seqs = [r["seq"] for r in got]
    assert seqs == sorted(set(seqs)) and seqs[4] == 2**44 << otlp.SPAN_BITS


def test_timed_raw_read(spark, tmp_path):
    from datetime import datetime, timezone

    path = f"file://{tmp_path}/raw"
    spark.range(10).select(F.col("id").cast("string").cast("binary").alias("value"), F.col("id").alias("seq"), F.timestamp_seconds(F.col("id") * 60).alias("timestamp")).write.parquet(path)
    at = lambda m: datetime.fromtimestamp(60 * m, timezone.utc)
    read = lambda **k: [r["seq"] for r in raw.raw_batch(spark, "parquet", path, schema="value binary, seq bigint, timestamp timestamp", **k).orderBy("seq").collect()]
    assert read() == list(range(10)) and read(since=at(3), until=at(7)) == [3, 4, 5, 6] and read(until=at(2)) == [0, 1] and read(since=at(8), limit=1) == [8]
