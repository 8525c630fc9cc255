"""All queries of the engine by name, each over whole tables."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import attrs as A
from ..functions import content as C
from ..functions import refs
from ..operators import archive, audit, chunk_store, chunkers, dedup, dialog, facts, restore
from ..operators.latest import latest_of
from ..schemas import TF_SPANS, USER_SESSIONS
from ..session import files_of, kept, new_path, table
from ..sources import adapters, bundles, otlp, raw, thin
from ..sources.adapters import AS_OF, conversation_spans, document_spans, document_values, event_facts, event_user_sessions
from ..streaming import metrics, runner
from . import marts, oracles

Query = Callable[[SparkSession, str], DataFrame]


def _spans(spark: SparkSession, d: str) -> DataFrame:
    return latest_of(event_facts(spark, d), TF_SPANS)


def _store(spark: SparkSession, d: str, kind: str = "wholefield") -> DataFrame:
    return dedup.new_chunks(dedup.chunks_of(document_values(spark, d), kind), None)


def _millis(c: str) -> F.Column:
    return F.unix_millis(c)


def _start_ms() -> F.Column:
    return F.expr("start_ns div 1000000").alias("start_ms")


def m1(spark, d):
    spans = conversation_spans(spark, d)
    return marts.end_reason_by_version(dialog.end_reasons(spans), facts.tf_spans(spans))


def m3(spark, d):
    return marts.dialog_funnel(dialog.end_reasons(conversation_spans(spark, d)))


def spans_latest(spark, d):
    return _spans(spark, d).select("session_id", _millis("ts").alias("ts_ms"), "span_id", "latency_ms", "inserted_at")


def session_rollup(spark, d):
    return _spans(spark, d).groupBy("session_id").agg(
        F.count("*").alias("spans"), F.count_distinct("trace_id").alias("traces"), F.unix_millis(F.min("ts")).alias("first_ms"), F.unix_millis(F.max("ts")).alias("last_ms"), F.count_if(F.col("status_code") == "ERROR").alias("errors")
    )


def trace_rollup(spark, d):
    return dialog.traces(conversation_spans(spark, d)).select("trace_id", "session_id", "spans", _start_ms(), F.expr("end_ns div 1000000").alias("end_ms"))


def root_user_sessions(spark, d):
    return facts.user_sessions(conversation_spans(spark, d)).select("user_id", "session_id", "trace_id", F.col("date").cast("string").alias("date"))


def span_getters(spark, d):
    f = facts.tf_spans(conversation_spans(spark, d))
    return f.withColumns({"ts": _millis("ts"), "temperature": F.round(F.col("temperature").cast("double"), 2)})


def heavy_candidates(spark, d):
    """``note`` is as long but isn't on the list of paths."""
    return dedup.candidates(document_spans(spark, d)).select(F.col("seq").alias("doc_id"), "path", F.octet_length("value").cast("long").alias("bytes"))


def wholefield_chunks(spark, d):
    c = dedup.chunks_of(document_values(spark, d))
    return c.groupBy("hash").agg(F.count("*").alias("uses"), F.max(F.octet_length("data").cast("long")).alias("bytes"))


def cas_anti_join(spark, d):
    v = document_values(spark, d)
    known = dedup.new_chunks(dedup.chunks_of(v.filter("seq % 3 = 0")), None)
    return dedup.new_chunks(dedup.chunks_of(v), known).select("hash", F.col("raw_len").cast("long").alias("raw_len"))


def cas_first_seen(spark, d):
    return dedup.first_seen(dedup.chunks_of(document_values(spark, d))).select(F.col("seq").alias("doc_id"), "hash", "miss")


def ref_roundtrip(spark, d):
    r = dedup.refs_of(dedup.chunks_of(document_values(spark, d)))
    return r.select(F.col("seq").alias("doc_id"), "ref", F.get(refs.parse_ref(F.col("ref")), F.lit(0)).alias("first_hash"), refs.is_ref(F.col("ref")).alias("is_ref"))


def restore_spans(spark, d):
    lean, chunks = dedup.thin(document_spans(spark, d))
    return dedup.restore(lean, chunks).select(F.col("seq").alias("doc_id"), F.sha2(A.string("gen_ai.system_instructions"), 256).alias("system_sha"), F.sha2(A.string("note"), 256).alias("note_sha"))


def fastcdc_restore_equal(spark, d):
    c = dedup.chunks_of(document_values(spark, d), "fastcdc")
    joined = F.aggregate(F.sort_array(F.collect_list(F.struct("pos", "data"))), F.lit(b""), lambda a, x: F.concat(a, x["data"]))
    return c.groupBy("seq").agg(joined.alias("b")).select(F.col("seq").alias("doc_id"), F.sha2("b", 256).alias("sha"), F.octet_length("b").cast("long").alias("bytes"))


def chunker_report(spark, d):
    """Whole fields against content-defined chunks on long histories, where only the latter save; ``delta_bytes``: what they save beyond whole fields."""
    long = dedup.candidates(_padded(conversation_spans(spark, d)))
    return dedup.compare(dedup.meter(long, "wholefield"), dedup.meter(long, "fastcdc"))


def chunker_report_wholefield(spark, d):
    """The report's row of whole fields alone, which SQL can tell."""
    return dedup.meter(dedup.candidates(_padded(conversation_spans(spark, d))), "wholefield")


def _padded(spans: DataFrame, turn_bytes: int = 2500) -> DataFrame:
    """Flat and JSON histories joined into one text each, every shorter turn filled up to ``turn_bytes``; longer ones stay whole."""
    pad = lambda x: F.when(F.octet_length(x) < turn_bytes, F.substring(F.repeat(F.concat(x, F.lit(" ")), turn_bytes), 1, turn_bytes)).otherwise(x)
    turns = F.transform(C.prompt_messages(), lambda m: F.concat(m["role"], F.lit(": "), pad(m["content"])))
    return spans.withColumn("attributes", F.array(adapters.kv("gen_ai.input.messages", "s", F.array_join(turns, "\n"))))


def dialog_messages(spark, d):
    return dialog.dialogs(conversation_spans(spark, d)).select(F.col("session").alias("session_id"), F.posexplode("dialog").alias("pos", "m")).select("session_id", F.col("pos").cast("long").alias("pos"), "m.role", F.sha2("m.content", 256).alias("content_sha"))


def dialog_turns(spark, d):
    x = F.col("dialog")
    return dialog.dialogs(conversation_spans(spark, d)).select(F.col("session").alias("session_id"), dialog.count_turns(x).alias("turns"), dialog.distinct_turns(x).alias("distinct_turns"), F.size(x).cast("long").alias("messages"))


def end_reason(spark, d):
    return dialog.end_reasons(conversation_spans(spark, d)).withColumn("date", F.col("date").cast("string"))


def prompt_text(spark, d):
    return conversation_spans(spark, d).select("span_id", F.sha2(C.prompt(), 256).alias("prompt_sha"), F.sha2(C.completion(), 256).alias("completion_sha"))


def _frames(spark, d):
    return archive.frames(conversation_spans(spark, d)).withColumn("date", F.col("date").cast("string"))


def archive_index(spark, d):
    return _frames(spark, d).select("trace_id", "date", "hour", _millis("ts").alias("ts_ms"), "session_id", "spans")


def scratch(spark: SparkSession) -> str:
    """A new folder that driver and executors share."""
    return new_path(spark, "run")


def _archived(spark: SparkSession, d: str) -> archive.Archive:
    a = archive.Archive(spark, scratch(spark))
    a.append(conversation_spans(spark, d), 0)
    return a


def archive_range(spark, d):
    got = _archived(spark, d).load_range(datetime(2024, 1, 5, tzinfo=timezone.utc), datetime(2024, 1, 12, tzinfo=timezone.utc))
    return got.select("span_id", A.session_id().alias("session_id"))


def archive_session(spark, d):
    return _archived(spark, d).load_session("sess-7").select("span_id", _start_ms())


def sample_traces(spark, d):
    return _archived(spark, d).sample_traces(20)


def restore_trace(spark, d):
    """One trace of the archive, its text resolved."""
    lean, chunks = dedup.thin(document_spans(spark, d))
    a = archive.Archive(spark, scratch(spark))
    a.append(lean, 0)
    trace = F.md5(F.lit("d3").cast("binary"))
    trace_id = spark.range(1).select(trace.alias("t")).first()["t"]
    return restore.restore_trace(a, chunks, trace_id).select(F.col("seq").alias("doc_id"), F.sha2(A.string("gen_ai.system_instructions"), 256).alias("text_sha"))


def retention_verify(spark, d):
    lean, chunks = dedup.thin(conversation_spans(spark, d), config=dedup.ExtractConfig(min_size=64))
    return restore.verify(archive.frames(lean), lean, chunks).withColumn("bytes", F.col("bytes") > 0)


def raw_audit(spark, d):
    return audit.raw_audit(document_spans(spark, d)).select("spans", "with_session", "services", "system_prompts", "unique_system_prompts", "heavy_fields", "heavy_bytes", "unique_bytes")


def smoke_asserts(spark, d):
    return audit.smoke_asserts(audit.raw_audit(document_spans(spark, d)))


def table_counts_union(spark, d):
    n = lambda name, df: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
    return n("tf_spans", _spans(spark, d)).unionByName(n("user_sessions", latest_of(event_user_sessions(spark, d), USER_SESSIONS))).unionByName(n("session_end_reason", dialog.end_reasons(conversation_spans(spark, d))))


def regroup_export(spark, d):
    """Requests for export: how many spans of a service and scope each holds, and that a span comes in one."""
    r = restore.regrouped(document_spans(spark, d), most=100)
    s = F.transform("spans", lambda x: x["span_id"])
    return r.select("service", "scope", "part", F.size("spans").cast("long").alias("spans"), F.sha2(F.array_join(s, ","), 256).alias("span_ids_sha"))


def compacted_spans(spark, d):
    """Facts that came in four batches: two compacted, one compacted on top, one fresh; the latest row of each key."""
    tables, rows = runner.Tables(spark, scratch(spark)), event_facts(spark, d)
    for k in range(4):
        tables.write(TF_SPANS.name, rows.filter((F.col("seq") + F.col("inserted_at")) % 4 == k), k)
        if k in (1, 2):
            tables.compact(TF_SPANS)
    return tables.read_latest(TF_SPANS).select("session_id", _millis("ts").alias("ts_ms"), "span_id", "latency_ms", "inserted_at")


def retention_plan(spark, d):
    """What a window whose traces restore lets go at the source."""
    lean, chunks = dedup.thin(conversation_spans(spark, d), config=dedup.ExtractConfig(min_size=64))
    at = datetime(2024, 1, 1, tzinfo=timezone.utc)
    return restore.deletion_plan(restore.verify(archive.frames(lean), lean, chunks), "dialogs", at, at).drop("bytes")


def _brief(spans: DataFrame) -> DataFrame:
    return spans.select("span_id", A.session_id().alias("session_id"), _start_ms(), F.sha2(C.completion(), 256).alias("completion_sha"))


def thin_roundtrip(spark, d):
    return _brief(thin.decode(thin.encode(conversation_spans(spark, d))))


def otlp_roundtrip(spark, d):
    return _brief(otlp.decode(otlp.encode(conversation_spans(spark, d))))


def late_span_hours(spark, d):
    """Odd spans arrive a batch late and still land in the hour of their event."""
    spans = conversation_spans(spark, d)
    a = archive.Archive(spark, scratch(spark))
    a.append(spans.filter("seq % 2 = 0"), 0)
    a.append(spans.filter("seq % 2 = 1"), 1)
    return a.spans().groupBy("trace_id", "date", "hour").agg(F.count("*").alias("spans")).withColumn("date", F.col("date").cast("string"))


def lazy_facts(spark, d):
    """Over the view with resolved text; the plan reads no chunk, as only numbers are asked for."""
    lean, chunks = dedup.thin(conversation_spans(spark, d), config=dedup.ExtractConfig(min_size=64))
    return restore.full_view(lean, chunks).groupBy(A.session_id().alias("session_id")).agg(F.count("*").alias("spans"), F.sum(F.expr("(end_ns - start_ns) div 1000000")).alias("latency_ms"))


def stream_facts_equal_batch(spark, d):
    """Thin lines through a stream to fact tables; the result equals the batch."""
    base = scratch(spark)
    where, most = _landed(thin.encode(conversation_spans(spark, d)).select("value", "seq"), f"{base}/lines", 1, **LINES)
    tables = runner.Tables(spark, f"{base}/tables")
    stream = spark.readStream.schema("value string, seq bigint").option("maxFilesPerTrigger", most).parquet(where)
    with kept(spark, runner.FILE_SETTING):
        runner.run_stream(stream, facts.fact_processor, tables, f"{base}/checkpoint").awaitTermination()
    return tables.read("tf_spans").select("span_id", "session_id", "latency_ms")


def _odd_spans(spark, d):
    """Spans of ``conversations`` with values of every kind, a span kind and a trace state."""
    x = lambda text: F.struct(F.lit(None).cast("string").alias("s"), F.lit(None).cast("bigint").alias("i"), F.lit(None).cast("double").alias("d"), F.lit(None).cast("boolean").alias("b"), F.lit(None).cast("array<string>").alias("a"), text.alias("x"))
    kv = lambda key, text: F.struct(F.lit(key).alias("key"), x(text).alias("value"))
    own = F.array(
        kv("numbers", F.format_string('{"arrayValue":{"values":[{"intValue":"%d"},{"stringValue":"two"},{"boolValue":true}]}}', "seq")),
        kv("nested", F.format_string('{"kvlistValue":{"values":[{"key":"inner","value":{"intValue":"%d"}}]}}', F.col("seq") + 1)),
        kv("bytes", F.concat(F.lit('{"bytesValue":"'), F.base64(F.col("seq").cast("string").cast("binary")), F.lit('"}'))),
    )
    kind = F.element_at(F.array(*map(F.lit, otlp.KINDS[1:])), (F.col("seq") % 5 + 1).cast("int"))
    return conversation_spans(spark, d).withColumns({"attributes": F.concat("attributes", own), "kind": kind, "trace_state": F.concat(F.lit("s="), F.col("seq"))})


def span_fidelity(spark, d):
    """Through protobuf, JSON lines and protobuf again: kinds of values and fields that plain columns would lose."""
    back = otlp.decode(otlp.encode(thin.decode(thin.encode(otlp.decode(otlp.encode(_odd_spans(spark, d)))))))
    get = lambda key, path: F.try_variant_get(F.parse_json(A.attr(key)["x"]), path, "string")
    return back.select(
        "span_id", "kind", "trace_state", get("numbers", "$.arrayValue.values[0].intValue").alias("first"), get("numbers", "$.arrayValue.values[1].stringValue").alias("second"),
        get("numbers", "$.arrayValue.values[2].boolValue").alias("third"), get("nested", "$.kvlistValue.values[0].value.intValue").alias("inner_value"),
        F.unbase64(get("bytes", "$.bytesValue")).cast("string").alias("bytes_text"), A.string("gen_ai.prompt.version").alias("plain"),
    )


def restore_range(spark, d):
    """Eight hours of the archive, texts resolved."""
    lean, chunks = dedup.thin(document_spans(spark, d))
    a = archive.Archive(spark, scratch(spark))
    a.append(lean, 0)
    got = restore.restore_range(a, chunks, datetime(2024, 1, 1, tzinfo=timezone.utc), datetime(2024, 1, 1, 8, tzinfo=timezone.utc))
    return got.select(F.col("seq").alias("doc_id"), F.sha2(A.string("gen_ai.system_instructions"), 256).alias("text_sha"))


def run_batch(spark, d):
    """The stream's fact processor over a window of the archive."""
    got = runner.run_batch(_archived(spark, d), facts.fact_processor, datetime(2024, 1, 5, tzinfo=timezone.utc), datetime(2024, 1, 12, tzinfo=timezone.utc))
    return got["tf_spans"].select("span_id", "session_id", "latency_ms")


def run_dedup(spark, d):
    """Raw messages through the deduplicating stream; its thin lines and chunks give the spans again."""
    base = scratch(spark)
    otlp.encode(document_spans(spark, d)).write.parquet(f"{base}/raw")
    tables = runner.Tables(spark, f"{base}/tables")
    runner.run_dedup(otlp.decode_all(raw.raw_stream(spark, "parquet", f"{base}/raw")), tables, f"{base}/checkpoint").awaitTermination()
    back = dedup.restore(thin.decode(tables.read("thin").select("value", "seq")), tables.read("chunks"))
    return back.select("span_id", F.sha2(A.string("gen_ai.system_instructions"), 256).alias("text_sha"), F.sha2(A.string("note"), 256).alias("note_sha"))


#: Bytes of a row group of messages that land, before compression; a task reads whole ones.
LANDED_GROUP = 16 << 20
#: Settings of the writer for lines: smaller row groups, looked at every ten rows. Left alone it guesses from the rows so far, and long rows after short ones fill a group with many times its size.
LINES = {"parquet.block.size": 4 << 20, "parquet.page.size.row.check.min": 10, "parquet.page.size.row.check.max": 10}


def _landed(rows: DataFrame, path: str, batches: int, **settings: int) -> tuple[str, str]:
    """Write ``rows`` for a stream that takes them in so many batches; returns the pattern of its folders and its ``maxFilesPerTrigger``.

    Each task deals its own rows to the batches, so no task gathers a batch and nothing is shuffled.
    """
    rows.withColumn("part", F.pmod("seq", F.lit(batches))).write.options(**{"parquet.block.size": LANDED_GROUP} | settings).partitionBy("part").parquet(path)
    return f"{path}/part=*", str(-(-files_of(rows.sparkSession, path) // batches))


def _deduplicated(spark: SparkSession, d: str, parts: int, bad: DataFrame | None = None) -> runner.Tables:
    """Raw messages that the deduplicating stream takes in several batches."""
    base = scratch(spark)
    messages = otlp.encode(document_spans(spark, d))
    where, most = _landed(messages if bad is None else messages.unionByName(bad), f"{base}/raw", parts)
    tables = runner.Tables(spark, f"{base}/tables")
    stream = otlp.decode_all(raw.raw_stream(spark, "parquet", where, maxFilesPerTrigger=most))
    runner.run_dedup(stream, tables, f"{base}/checkpoint").awaitTermination()
    return tables


def run_dedup_batches(spark, d):
    """Chunks that several batches stored: each once over all of them, as the stream remembers hashes."""
    return _deduplicated(spark, d, 4).read("chunks").groupBy("hash").agg(F.count("*").alias("copies"), F.sum("raw_len").alias("bytes"))


def dedup_counters(spark, d):
    """The counters that the stream's plan took over all batches."""
    listener = metrics.DedupMetrics()
    spark.streams.addListener(listener)
    try:
        _deduplicated(spark, d, 3)
        until = time.monotonic() + 60  # events come a little after the query's end
        while not listener.ended and time.monotonic() < until:
            time.sleep(0.05)
    finally:
        spark.streams.removeListener(listener)
    return listener.rows(spark)


def template_chunks(spark, d):
    """The template-aware chunker: its pieces of each text, put together again."""
    c = dedup.chunks_of(document_values(spark, d), "template")
    joined = F.aggregate(F.sort_array(F.collect_list(F.struct("pos", "data"))), F.lit(b""), lambda a, x: F.concat(a, x["data"]))
    return c.groupBy("seq").agg(joined.alias("b"), F.count("*").alias("n")).select(F.col("seq").alias("doc_id"), F.sha2("b", 256).alias("sha"), (F.col("n") * chunkers.GearConfig().least <= F.octet_length("b") + chunkers.GearConfig().least).alias("bounded"))


def gear_weights(spark, d):
    """How often each byte of the heavy texts begins one, with its weight in the rolling hash."""
    first = document_values(spark, d).select(F.hex(F.substring(F.encode("value", "UTF-8"), 1, 1)).alias("byte")).groupBy("byte").agg(F.count("*").alias("texts"))
    weights = [(f"{i:02X}", f"{int(w):016X}") for i, w in enumerate(chunkers.gear())]
    return first.join(F.broadcast(spark.createDataFrame(weights, "byte string, weight string")), "byte")  # 256 rows


def window_loads(spark, d):
    """Windows by RFC 3339 bounds: spans of three, the last of them in another zone, in the order of a load."""
    a = _archived(spark, d)
    bounds = [("2024-01-03T00:00:00Z", "2024-01-04T00:00:00Z"), ("2024-01-05T00:00:00Z", "2024-01-06T12:30:00Z"), ("2024-01-08T02:00:00+02:00", "2024-01-08T23:59:59.999+00:00")]
    out = None
    for i, (frm, to) in enumerate(bounds):
        got = a.load_range(*archive.parse_window(frm, to)).select(F.lit(i).alias("window"), A.short(F.col("span_id")).alias("span"))
        out = got if out is None else out.unionByName(got)
    return out


def stream_consumers(spark, d):
    """Two consumers of the same lines, each with a checkpoint of its own, the second after another run of the first: both have every span once."""
    base = scratch(spark)
    where, most = _landed(thin.encode(conversation_spans(spark, d)).select("value", "seq"), f"{base}/lines", 2, **LINES)
    stream = lambda: spark.readStream.schema("value string, seq bigint").option("maxFilesPerTrigger", most).parquet(where)
    tables, a = runner.Tables(spark, f"{base}/tables"), archive.Archive(spark, f"{base}/archive")
    with kept(spark, runner.FILE_SETTING):
        for _ in range(2):  # the second run finds nothing new and its last batch whole
            runner.run_stream(stream(), facts.fact_processor, tables, f"{base}/c1").awaitTermination()
        runner.run_archive(stream(), a, f"{base}/c2").awaitTermination()
    name = lambda df, n: df.select(F.lit(n).alias("consumer"), "span_id")
    return name(tables.read("tf_spans"), "facts").unionByName(name(a.spans(), "archive"))


def raw_quarantine(spark, d):
    """For every document also a message that is no request: good ones become thin lines, bad ones are kept whole."""
    n = F.col("doc_id")
    bad = table(spark, d, "documents").select(F.encode(F.concat(F.lit("broken "), n), "UTF-8").alias("value"), n.alias("seq"))
    tables = _deduplicated(spark, d, 2, bad)
    lines = thin.decode(tables.read("thin").select("value", "seq")).select(F.lit("thin").alias("name"), F.col("span_id").alias("item"))
    return lines.unionByName(tables.read("quarantine").select(F.lit("quarantine").alias("name"), F.decode("value", "UTF-8").alias("item")))


def cas_point_read(spark, d):
    """The longest heavy text of each source, out of a store of all chunks: folders, statistics and bloom filters skip the rest."""
    values = document_values(spark, d)
    store = chunk_store.ChunkStore(spark, f"{scratch(spark)}/store")
    store.append(dedup.new_chunks(dedup.chunks_of(values), None), 0)
    heavy = table(spark, d, "documents").filter(F.octet_length("text") >= 1024)
    longest = heavy.groupBy("source").agg(F.max_by(F.sha2("text", 256), F.struct(F.octet_length("text"), F.col("doc_id"))).alias("hash"))
    return store.lookup(longest).select("hash", "raw_len", (F.crc32("data") == F.col("crc")).alias("good"), F.sha2("data", 256).alias("data_sha"))


def segment_index(spark, d):
    """Where each chunk lies in segments of 64 KiB, packed in the order of hashes by their own size."""
    got, _ = chunk_store.segments(_store(spark, d).select("hash", F.col("raw_len").cast("long").alias("len"), "crc"), 64 << 10)
    return got.select("hash", "segment", "offset", "len")


def raw_limit(spark, d):
    """The first fifty raw messages in order."""
    base = scratch(spark)
    otlp.encode(document_spans(spark, d)).write.parquet(f"{base}/raw")
    # The message itself is read and holds the whole span.
    return otlp.decode(raw.raw_batch(spark, "parquet", f"{base}/raw", limit=50)).select(F.expr(f"shiftright(seq, {otlp.SPAN_BITS})").alias("seq"), "span_id", F.sha2(A.string("note"), 256).alias("note_sha"))


def _bundled(spark: SparkSession, d: str) -> str:
    """The folder of bundles of thin lines, one frame for each trace and hour."""
    path = f"{scratch(spark)}/bundles"
    spans = conversation_spans(spark, d)
    lines = archive.bucketed(spans).select("seq", "date", "hour", A.session_id().alias("session_id")).join(thin.encode(spans), "seq")
    bundles.write(bundles.pack(lines), path)
    return path


def bundle_import(spark, d):
    """Bundles read whole as streams of frames, without their index, as foreign ones are."""
    return _brief(thin.decode(bundles.read_lines(spark, _bundled(spark, d))))


def bundle_frames(spark, d):
    """The frames of a week's mornings by their places in the bundles; days and hours leave other bundles out before a task starts."""
    days = [f"2024-01-{n:02d}" for n in range(5, 12)]
    lines = bundles.read(spark, _bundled(spark, d)).filter(F.col("date").isin(days) & F.col("hour").isin(*range(12)))
    return _brief(thin.decode(lines.select("value", "seq")))


def bundle_sessions(spark, d):
    """Of each day the frames of the session that comes first, chosen by a query over the index."""
    path = _bundled(spark, d)
    i = bundles.index(spark, path).filter("session_id != ''")
    first = i.groupBy("date").agg(F.min("session_id").alias("session_id"))
    return _brief(thin.decode(bundles.read_frames(i.join(first, ["date", "session_id"]), path).select("value", "seq")))


def attribute_maps(spark, d):
    s = conversation_spans(spark, d)
    user = F.lit("user.id")
    return s.select(
        "span_id", A.string_bytes(F.filter("attributes", lambda a: a["key"].isin("user.id", "session.id"))).alias("id_bytes"), A.has_template().alias("has_template"),
        A.is_canonical_trace_id(F.col("trace_id")).alias("canonical"), F.coalesce(A.string_or_null("no.such"), F.lit("absent")).alias("missing"),
        F.element_at(A.last_wins(F.filter("attributes", lambda a: a["key"] == user)), user).alias("user"), F.try_element_at(A.first_wins(F.filter("attributes", lambda a: a["key"] == user)), user).alias("user_first"),
    )


def span_json(spark, d):
    """What a response carries, read back from its JSON."""
    j = restore.as_json(conversation_spans(spark, d))
    return j.select("service", "scope", F.get_json_object("span", "$.span_id").alias("span_id"), F.get_json_object("span", "$.name").alias("name"), F.get_json_object("span", "$.start_ns").cast("bigint").alias("start_ns"))


def audit_percentages(spark, d):
    return audit.raw_audit(document_spans(spark, d)).select(F.round("session_pct", 6).alias("session_pct"), F.round("system_dup_pct", 6).alias("system_dup_pct"), F.round("saved_pct", 6).alias("saved_pct"))


def queries() -> dict[str, Query]:
    return {
        "span_fidelity": span_fidelity,
        "restore_range": restore_range,
        "run_batch": run_batch,
        "run_dedup": run_dedup,
        "run_dedup_batches": run_dedup_batches,
        "dedup_counters": dedup_counters,
        "raw_quarantine": raw_quarantine,
        "template_chunks": template_chunks,
        "gear_weights": gear_weights,
        "window_loads": window_loads,
        "stream_consumers": stream_consumers,
        "cas_point_read": cas_point_read,
        "segment_index": segment_index,
        "raw_limit": raw_limit,
        "bundle_import": bundle_import,
        "bundle_frames": bundle_frames,
        "bundle_sessions": bundle_sessions,
        "attribute_maps": attribute_maps,
        "span_json": span_json,
        "audit_percentages": audit_percentages,
        "m1_end_reason_by_version": m1,
        "m2_hold_time_by_version": lambda s, d: marts.hold_time_by_version(_spans(s, d)),
        "m2b_hold_time_by_day": lambda s, d: marts.hold_time_by_day(_spans(s, d)),
        "m3_dialog_funnel": m3,
        "m4_latency_tokens": lambda s, d: marts.latency_tokens(_spans(s, d)),
        "m5_user_contacts_3d": lambda s, d: marts.user_contacts(latest_of(event_user_sessions(s, d), USER_SESSIONS), AS_OF),
        "m6_data_quality": lambda s, d: marts.data_quality(_spans(s, d)),
        "spans_latest": spans_latest,
        "session_rollup": session_rollup,
        "trace_rollup": trace_rollup,
        "root_user_sessions": root_user_sessions,
        "span_getters": span_getters,
        "heavy_candidates": heavy_candidates,
        "wholefield_chunks": wholefield_chunks,
        "wholefield_meter": lambda s, d: dedup.meter(document_values(s, d), "wholefield"),
        "cas_anti_join": cas_anti_join,
        "cas_first_seen": cas_first_seen,
        "dedup_stats": lambda s, d: dedup.dedup_stats(document_spans(s, d)),
        "ref_roundtrip": ref_roundtrip,
        "restore_spans": restore_spans,
        "fastcdc_meter": lambda s, d: dedup.meter(document_values(s, d), "fastcdc"),
        "fastcdc_restore_equal": fastcdc_restore_equal,
        "chunker_report": chunker_report,
        "chunker_report_wholefield": chunker_report_wholefield,
        "dialog_messages": dialog_messages,
        "dialog_turns": dialog_turns,
        "end_reason": end_reason,
        "prompt_text": prompt_text,
        "archive_index": archive_index,
        "archive_range": archive_range,
        "archive_session": archive_session,
        "sample_traces": sample_traces,
        "restore_trace": restore_trace,
        "retention_verify": retention_verify,
        "raw_audit": raw_audit,
        "smoke_asserts": smoke_asserts,
        "cas_inspect": lambda s, d: audit.store_inspect(_store(s, d)),
        "cas_top_segments": lambda s, d: audit.top_segments(_store(s, d)),
        "index_inspect": lambda s, d: audit.index_inspect(_frames(s, d)),
        "table_counts_union": table_counts_union,
        "regroup_export": regroup_export,
        "compacted_spans": compacted_spans,
        "retention_plan": retention_plan,
        "thin_roundtrip": thin_roundtrip,
        "otlp_roundtrip": otlp_roundtrip,
        "late_span_hours": late_span_hours,
        "lazy_facts": lazy_facts,
        "stream_facts_equal_batch": stream_facts_equal_batch,
    }


def oracle_sql() -> dict[str, str]:
    return dict(oracles.SQL)
