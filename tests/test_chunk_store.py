"""The store's layout: what a look-up reads, segments by a running sum, sums over ranges, and what moves when chunks are stored."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from spanloom.operators import chunk_store, chunkers, dedup
from spanloom.operators.running import running


def chunk(i):
    data = f"chunk {i} ".encode() * (1 + i % 50)
    return hashlib.sha256(data).hexdigest(), data, len(data), zlib.crc32(data)


def scan_metrics(df):
    """(files, rows) that the scans of a finished query have read."""
    files = rows = 0
    todo = [df._jdf.queryExecution().executedPlan()]
    while todo:
        p = todo.pop()
        name = p.getClass().getSimpleName()
        if name == "FileSourceScanExec":
            m = p.metrics()
            files, rows = files + m.get("numFiles").get().value(), rows + m.get("numOutputRows").get().value()
        if name == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(p.plan())
        kids = p.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return files, rows


def test_point_reads_skip_files_and_row_groups(spark, tmp_path):
    store = chunk_store.ChunkStore(spark, f"file://{tmp_path}/store", row_group=1 << 14)
    rows = [chunk(i) for i in range(6000)]
    for k in range(3):
        store.append(spark.createDataFrame(rows[k::3], chunk_store.CHUNK), k)
    store.append(spark.createDataFrame(rows[2::3], chunk_store.CHUNK), 2)  # a repeated batch
    assert store.read().count() == 6000
    wanted = [rows[17], rows[4001]]
    keys = spark.createDataFrame([(r[0],) for r in wanted] + [("0" * 64,), (None,), (wanted[0][0],)], "hash string")
    got = store.lookup(keys)
    assert sorted(map(tuple, got.collect())) == sorted(wanted)
    files, read = scan_metrics(got)
    # At most a file of each batch in three folders of 256, and there only row groups that may hold a hash.
    assert 2 <= files <= 9 + 3 and read < 200, (files, read)
    everything = store.lookup(spark.createDataFrame([(r[0],) for r in rows[:1500]], "hash string"))
    assert everything.count() == 1500
    assert store.lookup(keys.limit(0)).count() == 0


def test_no_copies_and_no_stored_bytes_move(spark):
    chunks = spark.createDataFrame([(*[""] * 2, 0, -1, 0, 0, *chunk(i % 5)[:2]) for i in range(100)], "trace_id string, span_id string, seq long, event_index int, attr_index int, pos int, hash string, data binary")
    known = spark.createDataFrame([chunk(0), chunk(1)], chunk_store.CHUNK)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = dedup.new_chunks(chunks, known)
        plan = new._jdf.queryExecution().sparkPlan().toString()
        assert sorted(r["raw_len"] for r in new.collect()) == sorted(chunk(i)[2] for i in (2, 3, 4))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Copies are taken together before the join, and the store's side of it has hashes alone.
    assert plan.index("Join") < plan.index("partial_first(data") and "Project [hash#" in plan


@pytest.mark.parametrize("full", [1, 100, 1000, 10**9])
def test_segments(spark, full):
    rng = random.Random(full)
    rows = [(f"{rng.random():.12f}", rng.choice([0, 1, 7, 90, 2500])) for _ in range(400)]
    got, _ = chunk_store.segments(spark.createDataFrame(rows, "hash string, len int"), full)
    want, at, first = [], 0, {}
    for h, n in sorted(rows):
        first.setdefault(at // full, at)
        want.append((h, n, at // full, at - first[at // full]))
        at += n
    assert sorted(map(tuple, got.collect())) == want


def test_segments_hold_frames_that_come_back(spark):
    chunks = spark.createDataFrame([chunk(i) for i in range(200)], chunk_store.CHUNK)
    packed = chunk_store.packed(chunks).withColumn("len", F.octet_length("frame"))
    got, _ = chunk_store.segments(packed, 1000)
    rows = got.orderBy("segment", "offset").collect()
    blobs = {}
    for r in rows:
        blobs[r["segment"]] = blobs.get(r["segment"], b"") + r["frame"]
    assert len(blobs) > 3
    cut = [(r["hash"], blobs[r["segment"]][r["offset"] : r["offset"] + r["len"]], r["crc"]) for r in rows]
    back = chunk_store.unpacked(spark.createDataFrame(cut, "hash string, frame binary, crc bigint"))
    assert {(r["hash"], bytes(r["data"])) for r in back.collect()} == {chunk(i)[:2] for i in range(200)}
    bad = spark.createDataFrame([(*cut[0][:2], 1), cut[1]], "hash string, frame binary, crc bigint")
    assert chunk_store.unpacked(bad, strict=False).count() == 1
    with pytest.raises(Exception, match="checksum"):
        chunk_store.unpacked(bad).collect()


def test_running_sums_of_a_hot_group(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["hot"] * 8 + ["b", "c", None]), i, rng.randrange(10)) for i in range(2000)]
    rng.shuffle(rows)
    got, _ = running(spark.createDataFrame(rows, "k string, i long, v int").repartition(6), ["k"], ["i"], {"before": "v", "nth": F.lit(1)})
    sums, want = {}, []
    for k, i, v in sorted(rows, key=lambda r: r[1]):
        s, n = sums.get(k, (0, 0))
        want.append((k, i, v, s, n))
        sums[k] = s + v, n + 1
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == want
    assert running(spark.createDataFrame([], "k string, i long"), ["k"], ["i"], {"n": F.lit(1)})[0].count() == 0


def test_gear_config_reaches_the_cuts(spark):
    data = bytes(random.Random(1).randrange(256) for _ in range(100_000))
    df = spark.createDataFrame([(1, data)], "k int, value binary")
    usual, small = chunkers.gear_chunks(df).collect(), chunkers.gear_chunks(df, chunkers.GearConfig(256, 512, 1024)).collect()
    for rows, low, high in ((usual, 2048, 8192), (small, 256, 1024)):
        rows.sort(key=lambda r: r["pos"])
        assert b"".join(r["data"] for r in rows) == data and all(low <= len(r["data"]) <= high for r in rows[:-1])
    assert len(small) > 4 * len(usual)
