"""Bundles from a stream: flushed when they are large, when they are old, and at the end."""

import time

from conftest import kvs, span

from spanloom.sources import bundles, thin
from spanloom.streaming import flush

HOUR = 3_600_000_000_000


def put(spans_df, base, first, n, text="x"):
    rows = [span(trace_id=f"{first + i:032x}", span_id=f"{i:016x}", start_ns=(1 + i % 2) * HOUR, attributes=kvs(session__id="s1", note=text), seq=first + i) for i in range(n)]
    thin.encode(spans_df(rows)).select("value", "seq").coalesce(1).write.mode("append").parquet(f"{base}/lines")


def wait(spark, path, n, seconds=60):
    until = time.time() + seconds
    while time.time() < until:
        if bundles.read(spark, path).count() == n:
            return
        time.sleep(0.5)
    assert bundles.read(spark, path).count() == n


def test_size_time_and_last_flush(spark, spans_df, tmp_path):
    base = f"file://{tmp_path}"
    path = f"{base}/bundles"
    put(spans_df, base, 0, 6, "y" * 4000)
    stream = lambda: spark.readStream.schema("value string, seq bigint").parquet(f"{base}/lines")
    # By size: nothing would be old for an hour. Six lines of 4000 bytes are above the bound of any key.
    q = flush.run_bundles(stream(), path, f"{base}/c", most=3000, seconds=3600)
    wait(spark, path, 6)
    put(spans_df, base, 100, 4)
    flush.caught_up(q)
    assert bundles.read(spark, path).count() == 6, "small lines wait"
    q.stop()
    # What waits is in the checkpoint. New lines are flushed by time; the first ones keep their own timer.
    put(spans_df, base, 200, 5)
    q = flush.run_bundles(stream(), f"{base}/other", f"{base}/c2", most=1 << 20, seconds=1)
    wait(spark, f"{base}/other", 15)
    put(spans_df, base, 300, 3)
    flush.finish(q, 1)
    got = bundles.read(spark, f"{base}/other").collect()
    assert len(got) == 18 and {(r["hour"], r["session_id"]) for r in got} == {(1, "s1"), (2, "s1")}
    back = thin.decode(bundles.read(spark, f"{base}/other").select("value", "seq"))
    assert back.select("trace_id").distinct().count() == 18


def test_a_repeated_batch_replaces_its_bundles(spark, spans_df, tmp_path):
    path = f"file://{tmp_path}/b"
    lines = spark.createDataFrame([("t", "s", "{}", 1, "2024-01-01", 1)], "trace_id string, session_id string, value string, seq long, date string, hour int")
    for name, n in (("b1", 1), ("b1", 1), ("b12", 2), ("b1", 2)):
        bundles.write(bundles.pack(lines), path, batch=name)
        assert bundles.read(spark, path).count() == n
