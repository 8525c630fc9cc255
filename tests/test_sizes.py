"""What one task, one worker or one folder holds doesn't grow with the table."""

from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
from conftest import kvs, span
from pyspark.sql import functions as F

from spanloom.operators import archive, dedup
from spanloom.plans import registry
from spanloom.session import BATCH_BYTES, kept
from spanloom.sources import otlp, thin
from spanloom.sources.adapters import as_spans, kv
from spanloom.streaming import runner

BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def heavy(spans_df, n=12):
    prompt = {"name": "gen_ai.content.prompt", "time_ns": 1, "attributes": kvs(text="é" * 900, note="n" * 1500)}
    other = {"name": "other", "time_ns": 1, "attributes": kvs(text="y" * 2000)}
    rows = [span(trace_id=f"{i:032x}", span_id=f"{i:016x}", attributes=kvs(gen_ai__system_instructions="x" * (1000 + 10 * i), note="z" * 2000), events=[prompt, other], seq=i) for i in range(n)]
    return spans_df([*rows, span(trace_id="f" * 32, attributes=None, events=None, seq=n), span(trace_id="e" * 32, attributes=kvs(turn__input="k" * 1100), seq=None)])


def test_references_of_whole_fields_are_joined_with_nothing(spans_df):
    spans = heavy(spans_df)
    got = dedup.thin(spans)[0]
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    joined = dedup.with_texts(spans, dedup.refs_of(dedup.chunks_of(dedup.candidates(spans))).withColumnRenamed("ref", "text"))
    key = lambda df: sorted(map(str, df.filter("seq IS NOT NULL").collect()))
    assert key(got) == key(joined) and got.schema == spans.schema
    assert got.filter("seq IS NULL").first()["attributes"][0]["value"]["s"].startswith("ref:"), "a span without an order of arrival is no exception"


def test_messages_land_without_a_task_that_gathers_a_batch(spark, spans_df, tmp_path):
    rows = otlp.encode(heavy(spans_df).filter("seq IS NOT NULL").repartition(3))
    where, most = registry._landed(rows, f"file://{tmp_path}/raw", 2)
    files = list(Path(tmp_path, "raw").rglob("*.parquet"))
    assert len(files) > 2 and int(most) == -(-len(files) // 2)
    stream = spark.readStream.schema("value binary, seq bigint").option("maxFilesPerTrigger", most).parquet(where)
    assert stream.columns == ["value", "seq"]
    seen = []
    stream.writeStream.foreachBatch(lambda b, i: seen.append(sorted(r["seq"] for r in b.collect()))).option("checkpointLocation", f"file://{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    assert len(seen) == 2 and sorted(sum(seen, [])) == list(range(13))


def test_a_task_of_a_batch_reads_a_bounded_part(spark, spans_df, tmp_path, monkeypatch):
    """Neither files nor row groups make a task's part of the kept batch grow with the table."""
    monkeypatch.setattr(runner, "FILE_BYTES", 1 << 20)
    monkeypatch.setattr(registry, "LANDED_GROUP", 1 << 20)
    rows = spark.range(0, 400, 1, 2).select(F.encode(F.expr("array_join(transform(sequence(1, 500), i -> sha2(concat(id, '-', i), 256)), '')"), "UTF-8").alias("value"), F.col("id").alias("seq"))
    where, most = registry._landed(rows, f"file://{tmp_path}/raw", 1)
    before = spark.conf.get(runner.FILE_SETTING)
    sizes, stream = [], spark.readStream.schema("value binary, seq bigint").option("maxFilesPerTrigger", most).parquet(where)
    try:
        runner._start(stream, lambda b, i: sizes.extend(r["n"] for r in b.groupBy(F.spark_partition_id()).agg(F.sum(F.octet_length("value")).alias("n")).collect()), f"file://{tmp_path}/c", None).awaitTermination()
        assert sum(sizes) == 400 * 32_000 and max(sizes) <= 4 << 20, sizes
        spark.conf.set(runner.FILE_SETTING, "64k")
        runner._start(stream, lambda b, i: None, f"file://{tmp_path}/c2", None).awaitTermination()
        assert spark.conf.get(runner.FILE_SETTING) == "64k", "a smaller bound stays"
    finally:
        spark.conf.set(runner.FILE_SETTING, before)


def test_long_rows_after_short_ones_end_a_row_group_in_time(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(registry.LINES, "parquet.block.size", 1 << 20)
    text = "array_join(transform(sequence(1, IF(id < 9000, 1, 500)), i -> sha2(concat(id, '-', i), 256)), '')"
    registry._landed(spark.range(0, 9400, 1, 1).select(F.expr(text).alias("value"), F.col("id").alias("seq")), f"file://{tmp_path}/raw", 1, **registry.LINES)
    metas = [pq.read_metadata(p) for p in Path(tmp_path, "raw").rglob("*.parquet")]
    sizes = [m.row_group(i).total_byte_size for m in metas for i in range(m.num_row_groups)]
    assert sum(m.num_rows for m in metas) == 9400 and sum(sizes) > 13_000_000 and max(sizes) <= 2 << 20, sizes


def test_a_task_of_a_consumer_keeps_a_bounded_part_of_the_lines(spark, sf, tmp_path, monkeypatch):
    monkeypatch.setattr(runner, "LINE_BYTES", 1 << 20)
    monkeypatch.setitem(registry.LINES, "parquet.block.size", 1 << 20)
    text = F.expr("array_join(transform(sequence(1, 500), i -> sha2(concat(id, '-', i), 256)), '')")
    hexed = lambda n: F.lpad(F.hex("id"), n, "0")
    spans = as_spans(spark.range(0, 400, 1, 1).select(hexed(32).alias("trace_id"), hexed(16).alias("span_id"), F.lit(0).alias("start_ns"), F.lit(1).alias("end_ns"), F.array(kv("note", "s", text)).alias("attributes"), F.col("id").alias("seq")))
    where, most = registry._landed(thin.encode(spans).select("value", "seq"), f"file://{tmp_path}/lines", 1, **registry.LINES)
    sizes, before = [], spark.conf.get(runner.FILE_SETTING)

    def processor(spans):
        sizes.extend(r["n"] for r in spans.groupBy(F.spark_partition_id()).agg(F.sum(F.octet_length(F.col("attributes")[0]["value"]["s"])).alias("n")).collect())
        return {}

    with kept(spark, runner.FILE_SETTING):
        stream = spark.readStream.schema("value string, seq bigint").option("maxFilesPerTrigger", most).parquet(where)
        runner.run_stream(stream, processor, runner.Tables(spark, f"file://{tmp_path}/t"), f"file://{tmp_path}/c").awaitTermination()
    assert sum(sizes) == 400 * 32_000 and max(sizes) <= 5 << 19, sizes
    registry.stream_facts_equal_batch(spark, sf)
    assert spark.conf.get(runner.FILE_SETTING) == before, "other queries read files as before"


def test_workers_of_messages_get_modest_batches(spark, spans_df):
    for plan in (otlp.encode, lambda s: otlp.decode(s.select(F.lit(b"").alias("value"), "seq")), lambda s: dedup.chunks_of(dedup.candidates(s), "fastcdc")):
        spark.conf.set(BYTES, str(64 << 20))
        plan(heavy(spans_df))
        assert int(spark.conf.get(BYTES)) == BATCH_BYTES


def test_hashes_that_a_partition_forgets_are_only_repeated(spark, monkeypatch):
    monkeypatch.setattr(dedup, "REMEMBERED", 10)
    rows = spark.range(0, 5000, 1, 1).select((F.col("id") % 50).cast("string").alias("hash"), F.lit(1).cast("long").alias("len"))
    got = [r["hash"] for r in dedup.once_a_partition(rows).collect()]
    assert set(got) == {str(i) for i in range(50)} and len(got) > 50


def test_quiet_hours_share_folders(spark, spans_df, tmp_path):
    a = archive.Archive(spark, f"file://{tmp_path}/archive")
    hour = 3_600_000_000_000
    a.append(spans_df([span(trace_id=f"{i:032x}", span_id=f"{i:016x}", start_ns=i * hour, seq=i) for i in range(72)]).repartition(4), 0)
    assert len({p.parent for p in Path(tmp_path).rglob("spans/**/*.parquet")}) == 6
    assert len(list(Path(tmp_path).rglob("index/**/*.parquet"))) == 3, "one file a date, however many tasks"
    assert sorted((r["date"].day, r["hour"]) for r in a.spans().collect()) == [(d, h) for d in (1, 2, 3) for h in range(24)]
    assert a.load_trace(f"{30:032x}").first()["hour"] == 6 and a.spans().columns == [*spans_df([]).columns, "hour", "date", "batch_id"]


def test_texts_move_once_to_their_spans(spark, spans_df, tmp_path):
    """Shuffles of a restore: references, chunks, texts by span, spans."""
    lean, chunks = dedup.thin(heavy(spans_df).filter("seq IS NOT NULL"), "fastcdc")
    lean.write.parquet(f"file://{tmp_path}/lean")
    chunks.write.parquet(f"file://{tmp_path}/chunks")
    read = spark.read.parquet
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = dedup.restore(read(f"file://{tmp_path}/lean"), read(f"file://{tmp_path}/chunks"))
        assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    key = lambda df: sorted(map(str, df.filter("seq IS NOT NULL").collect()))
    assert key(got) == key(heavy(spans_df))


def test_rows_of_a_batch_are_those_of_arrow(spans_df):
    value = {"s": "é", "i": 1, "d": 0.5, "b": True, "a": ["x", None], "x": None}
    odd = [None, [], [{"key": "k", "value": None}, {"key": None, "value": value}, None], [{"key": "l", "value": value | {"a": []}}]]
    kind = otlp._schema().field("attributes").type
    for x in (pa.array(odd * 3, kind), pa.array([{"a": o, "n": i} if i % 3 else None for i, o in enumerate(odd * 3)], pa.struct([("a", kind), ("n", pa.int64())]))):
        for part in (x, x.slice(2), x.slice(3, 5), x.slice(4, 1), x.slice(4, 0)):
            assert otlp.as_rows(part) == part.to_pylist()


def test_only_unknown_fields_are_the_rest_of_a_span():
    span_class = type(otlp.request_class()().resource_spans.add().scope_spans.add().spans.add())
    known, unknown = span_class(name="n"), span_class.FromString(b"\x2a\x01n\xa2\x06\x03abc")
    assert otlp._rest(known) == b"" and otlp._rest(unknown) == b"\xa2\x06\x03abc"
