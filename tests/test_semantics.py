"""Getters, content conventions, references, chunkers, dialogues, archive and restore, on small fixtures."""

import hashlib
import json
from datetime import datetime, timezone

import pytest
from conftest import kvs, span
from pyspark.sql import functions as F

from spanloom.functions import attrs as A
from spanloom.functions import content as C
from spanloom.functions import refs
from spanloom.operators import archive, chunkers, dedup, dialog, facts, restore
from spanloom.operators.audit import human_bytes
from spanloom.operators.latest import latest
from spanloom.schemas import MESSAGES
from spanloom.plans import tables as ddl
from spanloom.sources import bundles, otlp, raw, synth, thin
from spanloom.streaming import metrics, runner


def one(df, *columns):
    return df.select(*columns).first()


def test_getters(spans_df):
    a = kvs(session__id="sess-1", user__id="user-7", app__version="", gen_ai__prompt__version="v3", gen_ai__usage__input_tokens=320, t=0.5, flag=True, reasons=["stop", "x"]) + kvs(session__id="late")
    df = spans_df([span(attributes=a, status_code="STATUS_CODE_ERROR", parent_span_id="")])
    r = one(
        df, A.session_id(), A.user_id(), A.version(), A.integer("gen_ai.usage.input_tokens"), A.integer("t"), A.double("t"), A.boolean("flag"), A.first_string("reasons"),
        A.string("missing"), A.is_root(), A.status_code(), A.string_or_null("missing"), A.string_or_null("app.version"), A.first_wins()["session.id"], A.last_wins()["session.id"],
    )
    assert tuple(r) == ("sess-1", "user-7", "v3", 320, 0, 0.5, True, "stop", "", True, "ERROR", None, "", "sess-1", "late")
    assert one(spans_df([span()]), A.status_code())[0] == "UNSET"


def test_bytes_not_characters(spans_df):
    assert one(spans_df([span(attributes=kvs(a="при", b=3))]), A.string_bytes())[0] == 6


@pytest.mark.parametrize(
    "raw, want",
    [
        ("not json", [("user", "not json")]),
        ('{"role": "user", "content": "x"}', [("user", '{"role": "user", "content": "x"}')]),
        ("null", []),
        ("[]", []),
        ("[null]", [("", "")]),
        ('[{"role": 1, "content": "x"}]', [("user", '[{"role": 1, "content": "x"}]')]),
        ('[{"role": null, "content": "x"}]', [("", "x")]),
        ('[{"role": "user"}]', [("user", "")]),
        ('[{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]', [("user", "a"), ("assistant", "b")]),
        ("3", [("user", "3")]),
        ('["x"]', [("user", '["x"]')]),
    ],
)
def test_strict_json(spans_df, raw, want):
    got = one(spans_df([span(attributes=kvs(gen_ai__input__messages=raw))]), C.prompt_messages())[0]
    assert [tuple(m) for m in got] == want


def messages(role, text):
    return json.dumps([{"role": role, "content": text}])


def test_conventions(spans_df):
    b = kvs(gen_ai__system_instructions="S", gen_ai__input__messages=messages("user", "U"), gen_ai__output__messages=messages("assistant", "R"))
    a = kvs(**{"gen_ai__prompt__10__content": "ten", "gen_ai__prompt__2__role": "user", "gen_ai__prompt__2__content": "two", "gen_ai__prompt__x__content": "no", "gen_ai__prompt__1__content__more": "no", "gen_ai__completion__0__content": "R"})
    e = [{"name": "gen_ai.content.prompt", "time_ns": 0, "attributes": kvs(n=1, empty="", text="U")}, {"name": "gen_ai.content.completion", "time_ns": 0, "attributes": kvs(text="R")}]
    got = spans_df([span(attributes=b, seq=0), span(attributes=a, seq=1), span(events=e, seq=2), span(seq=3)]).orderBy("seq").select(C.prompt(), C.completion(), C.is_llm()).collect()
    assert [tuple(r) for r in got] == [("S\nU", "R", True), ("two\nten", "R", True), ("U", "R", True), ("", "", False)]


def test_paths(spans_df):
    long = "x" * 2000
    a = kvs(gen_ai__prompt__7__content=long, gen_ai__prompt__7__8__content=long, gen_ai__input__messages="short", other=long, greeting__text=long)
    e = [{"name": "gen_ai.content.prompt", "time_ns": 0, "attributes": kvs(text=long)}, {"name": "else", "time_ns": 0, "attributes": kvs(text=long)}]
    got = dedup.candidates(spans_df([span(attributes=a, events=e)])).select("path").collect()
    assert sorted(r[0] for r in got) == ["event:gen_ai.content.prompt:text", "gen_ai.prompt.7.content", "greeting.text"]
    with pytest.raises(ValueError):
        dedup.ExtractConfig(min_size=0)


def test_refs(spark):
    h = "ab" * 32
    df = spark.createDataFrame([("ref:sha256:" + h,), (f"ref:sha256:{h},{h}",), ("ref:sha256:",), ("ref:sha256:zz",), ("text",), (None,)], "v string")
    got = df.select(refs.is_ref(F.col("v")), refs.parse_ref(F.col("v"))).collect()
    assert [r[0] for r in got] == [True, True, False, False, False, False] and got[1][1] == [h, h] and got[2][1] is None


def chain(seed, n):
    out, h = b"", seed.to_bytes(8, "big")
    while len(out) < n:
        h = hashlib.sha256(h).digest()
        out += h
    return out[:n]


def scalar_cut(data, least=2048, average=4096, most=8192):
    """The rolling hash, byte by byte."""
    table = [int.from_bytes(hashlib.sha256(bytes([i, 0x9E, 0x37, 0x79, 0xB9])).digest()[:8], "big") for i in range(256)]
    ends, start = [], 0
    while start < len(data):
        n, cut = min(len(data) - start, most), None
        h = 0
        for i in range(least, n):
            h = ((h << 1) + table[data[start + i]]) % 2**64
            if h >> (64 - (14 if i < average else 10)) == 0:
                cut = i
                break
        start += n if cut is None else cut
        ends.append(start)
    return ends


@pytest.mark.parametrize("seed, size", [(1, 0), (1, 1), (2, 2048), (2, 2049), (3, 200 * 1024), (4, 8192), (5, 40 * 1024), (6, 5000)])
def test_cut_points(seed, size):
    data = chain(seed, size)
    ends = chunkers.cut_points(data)
    assert ends == scalar_cut(data)
    sizes = [b - a for a, b in zip([0, *ends], ends)]
    assert sum(sizes) == size and all(2048 <= s <= 8192 for s in sizes[:-1])


def test_cuts_survive_a_shift():
    data = chain(7, 64 * 1024)
    cut = lambda d: {hashlib.sha256(d[a:b]).digest() for a, b in zip([0, *chunkers.cut_points(d)], chunkers.cut_points(d))}
    a, b = cut(data), cut(b"some prefix " + data)
    assert len(a & b) >= len(a) / 2


def test_unknown_chunker():
    with pytest.raises(ValueError):
        chunkers.chunker("nope")


@pytest.mark.parametrize("kind", ["wholefield", "fastcdc", "template"])
def test_reversible(spans_df, kind):
    pool = [("текст %d " % i) * 400 for i in range(5)]
    rows = []
    for i in range(1200):
        t = pool[i % 5]
        attrs, events = [], []
        if i % 3 == 0:
            attrs = kvs(gen_ai__system_instructions=t, gen_ai__input__messages=t, n=i) + kvs(gen_ai__system_instructions=t + "2")
        elif i % 3 == 1:
            attrs = kvs(gen_ai__prompt__0__role="user", gen_ai__prompt__0__content=t, x="ref:sha256:not one")
        else:
            events = [{"name": "gen_ai.content.prompt", "time_ns": i, "attributes": kvs(text=t, m=1)}]
        rows.append(span(trace_id=f"{i // 4:032x}", span_id=f"{i:016x}", seq=i, attributes=attrs, events=events))
    df = spans_df(rows)
    lean, chunks = dedup.thin(df, kind)
    assert dedup.candidates(lean).count() == 0 and dedup.ref_places(lean).count() >= 1200
    back = dedup.restore(lean, chunks)
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0


def test_missing_chunk_fails(spans_df):
    lean, chunks = dedup.thin(spans_df([span(attributes=kvs(gen_ai__input__messages="x" * 2000))]))
    with pytest.raises(Exception, match="missing or damaged"):
        dedup.restore(lean, chunks.limit(0)).collect()
    assert dedup.ref_places(dedup.restore(lean, chunks.limit(0), strict=False)).count() == 1
    damaged = chunks.withColumn("data", F.encode(F.lit("y"), "UTF-8"))
    with pytest.raises(Exception, match="missing or damaged"):
        dedup.restore(lean, damaged).collect()


def test_hits_and_misses(spans_df):
    a = kvs(gen_ai__system_instructions="s" * 2400)
    r = dedup.dedup_stats(spans_df([span(attributes=a, seq=0), span(attributes=a, seq=1, span_id="1" * 16)])).first()
    assert (r["spans"], r["misses"], r["hits"], r["stored_bytes"], r["content_bytes"]) == (2, 1, 1, 2400, 4800)


def test_meter_without_content(spans_df):
    r = dedup.meter(dedup.candidates(spans_df([span()])), "wholefield").first()
    assert r["chunks"] == 0 and r["saved_pct"] == 0.0


def llm(t, history, reply, **more):
    a = kvs(session__id=more.pop("session", "s1"), gen_ai__input__messages=json.dumps(history), gen_ai__output__messages=messages("assistant", reply))
    return span(start_ns=t, attributes=a, **more)


def test_cumulative_dialog(spans_df):
    u = lambda x: {"role": "user", "content": x}
    df = spans_df([
        llm(200, [u("u1"), {"role": "assistant", "content": "a1"}, u("u2")], "a2", trace_id="b" * 32, span_id="2" * 16, seq=0),
        llm(100, [u("u1")], "a1", trace_id="a" * 32, span_id="1" * 16, seq=1),
    ])
    got = dialog.dialogs(df).first()
    assert got["session"] == "s1" and [m["content"] for m in got["dialog"]] == ["u1", "a1", "u2", "a2"]


@pytest.mark.parametrize(
    "n, turns, status, finish, user, want",
    [
        (0, 0, "ERROR", "stop", "", "unknown"),
        (2, 5, "ERROR", "length", "до свидания", "connection_lost"),
        (2, 5, "UNSET", "content_filter", "до свидания", "agent_confused"),
        (2, 5, "OK", "length", "", "agent_confused"),
        (2, 9, "OK", "stop", "Ну ДО Свидания!", "spammer_hung_up"),
        (2, 3, "OK", "stop", "x", "spammer_hung_up"),
        (2, 4, "OK", "stop", "x", "dialog_exhausted"),
    ],
)
def test_reasons(spark, n, turns, status, finish, user, want):
    df = spark.range(1).select(
        F.expr(f"CAST(array_repeat(struct('user' AS role, 'x' AS content), {n}) AS {MESSAGES})").alias("d"), F.lit(turns).alias("turns"), F.lit(status).alias("last_status"), F.lit(finish).alias("last_finish"), F.lit(user).alias("last_user")
    )
    signals = {c: F.col(c) for c in ("turns", "last_status", "last_finish", "last_user")}
    assert df.select(dialog.heuristic(F.col("d"), signals)).first()[0] == want


def test_last_model_span_of_dialog_service(spans_df):
    s = kvs(session__id="s1")
    done = lambda r: kvs(gen_ai__output__messages=messages("assistant", "x"), gen_ai__response__finish_reasons=[r])
    df = spans_df([
        span(start_ns=5, attributes=s + done("length"), seq=0, span_id="a" * 16), span(start_ns=5, attributes=s + done("stop"), seq=1, span_id="b" * 16),
        span(start_ns=9, service="extractor", attributes=s + done("stop"), status_code="STATUS_CODE_ERROR", seq=2, span_id="c" * 16),
    ])
    r = dialog.session_signals(df).first()
    assert (r["last_status"], r["last_finish"]) == ("UNSET", "length")


NS = 1_000_000_000
T10 = int(datetime(2024, 5, 1, 10, tzinfo=timezone.utc).timestamp()) * NS


def archived(spark, tmp_path, rows, spans_df, batch=0):
    a = archive.Archive(spark, f"file://{tmp_path}/archive")
    a.append(spans_df(rows), batch)
    return a


def rows_of_two_hours():
    s1, s2 = kvs(session__id="s1"), kvs(session__id="s2")
    return [
        span(trace_id="a" * 32, span_id="1" * 16, start_ns=T10 + 2 * NS, attributes=s1, seq=0), span(trace_id="a" * 32, span_id="2" * 16, start_ns=T10 + NS, attributes=s1, seq=1),
        span(trace_id="b" * 32, span_id="3" * 16, start_ns=T10 + 5 * NS, attributes=s1, seq=2), span(trace_id="c" * 32, span_id="4" * 16, start_ns=T10 + 3601 * NS, attributes=s2, seq=3),
    ]


def test_archive(spark, tmp_path, spans_df):
    a = archived(spark, tmp_path, rows_of_two_hours(), spans_df)
    index = {r["trace_id"][0]: r for r in a.index().collect()}
    assert len(index) == 3 and index["a"]["ts"].second == 1 and index["c"]["hour"] == 11 and index["a"]["hour"] == 10
    at = lambda s: datetime.fromtimestamp((T10 // NS) + s, timezone.utc)
    assert a.load_range(at(1), at(5)).count() == 3, "both ends belong to the window"
    assert a.load_range(at(2), at(5)).count() == 1, "a frame counts by its first span"
    assert a.load_range(at(1), at(5), "s2").count() == 0
    assert a.load_range(at(2), at(5), expand_sessions=True).count() == 3
    assert a.load_session("s2").count() == 1 and [r["trace_id"][0] for r in a.sample_traces(2).collect()] == ["a", "b"]
    archived(spark, tmp_path, rows_of_two_hours(), spans_df)
    assert a.index().count() == 3 and a.spans().count() == 4, "a replayed batch replaces itself"
    late = span(trace_id="a" * 32, span_id="9" * 16, start_ns=T10 + 3 * NS, attributes=kvs(session__id="s1"), seq=9)
    archived(spark, tmp_path, [late], spans_df, batch=1)
    assert a.spans().filter("hour = 10").count() == 4 and a.load_trace("a" * 32).count() == 3
    with pytest.raises(archive.TraceNotFound):
        a.load_trace("f" * 32)


def test_restore_drops_replays(spark, tmp_path, spans_df):
    rows = [span(trace_id="a" * 32, span_id="1" * 16, attributes=kvs(gen_ai__input__messages="y" * 3000), seq=1)]
    lean, chunks = dedup.thin(spans_df(rows))
    a = archive.Archive(spark, f"file://{tmp_path}/archive")
    a.append(lean, 0)
    a.append(lean, 1)
    got = restore.restore_trace(a, chunks, "a" * 32)
    assert got.count() == 1 and got.select(A.string("gen_ai.input.messages")).first()[0] == "y" * 3000
    v = restore.verify(archive.frames(lean), lean, chunks).first()
    assert v["ok"] and v["traces"] == 1 and v["failed"] == 0
    assert not restore.verify(archive.frames(lean), lean, chunks.limit(0)).first()["ok"]


def test_window():
    now = datetime(2024, 5, 2, 13, tzinfo=timezone.utc)
    assert archive.parse_window(now=now) == (datetime(2024, 5, 1, tzinfo=timezone.utc), datetime(2024, 5, 2, tzinfo=timezone.utc))
    for bad in (("yesterday", None), ("2024-05-01T00:00:00Z", "2024-04-01T00:00:00Z"), ("2024-05-01", None)):
        with pytest.raises(ValueError):
            archive.parse_window(*bad, now=now)


def rich():
    return span(
        service="svc", resource={"attributes": kvs(service__name="svc", host="h", n=1)}, scope_full={"name": "s", "version": "1.2", "attributes": kvs(x="y")}, trace_id="ab" * 16, span_id="cd" * 8,
        parent_span_id="ef" * 8, start_ns=5, end_ns=9, status_code="STATUS_CODE_ERROR", status_message="bad", attributes=kvs(a="1", b=2, c=0.5, d=True, e=["x", "y"]) + kvs(a="again"),
        events=[{"name": "ev", "time_ns": 7, "attributes": kvs(k="v")}], links=[{"trace_id": "12" * 16, "span_id": "34" * 8, "attributes": kvs(l="m")}], seq=4,
    )


def test_thin_keeps_everything(spans_df):
    df = spans_df([rich(), span(trace_id="1" * 32, span_id="2" * 16, seq=5)])
    back = thin.decode(thin.encode(df))
    assert back.exceptAll(df).count() == 0 and back.count() == 2


def test_poison_lines(spark, spans_df):
    good = thin.encode(spans_df([rich()])).select("value", "seq")
    lines = good.unionByName(spark.createDataFrame([("not json", 7), ('{"span": {}}', 8), (None, 9)], "value string, seq bigint"))
    assert thin.decode(lines).count() == 1 and thin.poison(lines).count() == 3
    assert thin.narrow(good).first()["trace_id"] == "ab" * 16


def test_protobuf_keeps_everything(spark, spans_df):
    df = spans_df([rich()])
    back = otlp.decode(otlp.encode(df)).withColumn("seq", F.lit(4).cast("long"))
    assert back.exceptAll(df).count() == 0 and back.count() == 1
    junk = spark.createDataFrame([(bytearray(b"\xff\xff\xff"), 0), (None, 1)], "value binary, seq bigint")
    assert otlp.decode(junk).count() == 0


def test_foreign_bundles(spark, tmp_path, spans_df):
    import zstandard

    lines = [r["value"] for r in thin.encode(spans_df([rich(), span(trace_id="1" * 32, span_id="2" * 16, seq=5)])).orderBy("seq").collect()]
    c = zstandard.ZstdCompressor()
    (tmp_path / "date=2024-05-01" / "hour=10").mkdir(parents=True)
    (tmp_path / "date=2024-05-01" / "hour=10" / "part-1.jsonl.zst").write_bytes(b"".join(c.compress((x + "\n").encode()) for x in lines))
    got = bundles.read_lines(spark, f"file://{tmp_path}")
    assert got.count() == 2 and thin.decode(got).count() == 2


def test_latest_before_filter(spark):
    df = spark.createDataFrame([("k", 1, "v4"), ("k", 2, ""), ("j", 1, "v3")], "key string, ver int, version string")
    assert {tuple(r) for r in latest(df, ("key",), ("ver",)).filter("version != ''").collect()} == {("j", 1, "v3")}


def test_unsigned_latency(spans_df):
    r = facts.tf_spans(spans_df([span(start_ns=5_000_000, end_ns=0)])).first()
    assert r["latency_ms"] == 2**32 - 5


def test_numbers_read_no_text(spans_df):
    lean, chunks = dedup.thin(spans_df([span(attributes=kvs(gen_ai__input__messages="y" * 3000), seq=1)]))
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert plan(restore.full_view(spans_df([span()]), chunks).select("start_ns")).count("Join") == 0


def test_stream_of_dedup_archive_and_facts(spark, tmp_path):
    base = f"file://{tmp_path}"
    raw = synth.sessions(spark, 12, long=True)
    raw.write.parquet(f"{base}/raw")
    tables = runner.Tables(spark, f"{base}/tables")
    stream = lambda path, schema: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    from spanloom.schemas import SPAN

    for _ in range(2):  # the second run finds nothing new
        runner.run_dedup(stream(f"{base}/raw", SPAN), tables, f"{base}/c1", kind="fastcdc").awaitTermination()
    chunks = tables.read("chunks")
    assert chunks.count() == chunks.select("hash").distinct().count() > 0
    lines = spark.readStream.schema("trace_id string, value string, seq bigint, batch_id int").parquet(f"{base}/tables/thin").select("value", "seq")
    a = archive.Archive(spark, f"{base}/archive")
    runner.run_archive(lines, a, f"{base}/c2").awaitTermination()
    runner.run_stream(lines, facts.fact_processor, tables, f"{base}/c3").awaitTermination()
    assert tables.read("tf_spans").count() == raw.count() == a.spans().count()
    w = (datetime(2023, 12, 30, tzinfo=timezone.utc), datetime(2024, 1, 2, tzinfo=timezone.utc))
    got = runner.run_batch(a, dialog.end_reason_processor, *w, store=chunks)["session_end_reason"].orderBy("session_id").collect()
    want = dialog.end_reasons(raw).orderBy("session_id").collect()
    assert got == want and len(got) == 12
    tables.reset("tf_spans")
    assert not tables.exists("tf_spans")


def test_seeder(spark):
    assert synth.seed_facts(spark, 150).groupBy("session_id").count().filter("count = 15").count() == 10
    assert synth.seed_end_reasons(spark, 150).count() == 10 and synth.seed_user_sessions(spark, 160).count() == 40


def test_human_bytes():
    assert [human_bytes(n) for n in (0, 1023, 1024, 1536 * 1024)] == ["0 B", "1023 B", "1.0 KiB", "1.5 MiB"]


def test_catalogue(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS loom_test")
    assert ddl.create(spark, "loom_test") == ddl.create(spark, "loom_test") == sorted(ddl.DDL)
    assert set(facts.tf_spans(synth.sessions(spark, 1)).columns) <= set(spark.table("loom_test.tf_spans").columns)
    ddl.truncate(spark, "tf_spans", "loom_test")
    with pytest.raises(ValueError):
        ddl.truncate(spark, "nope")
    spark.sql("DROP DATABASE loom_test CASCADE")


def test_raw_sources_and_metrics(spark, tmp_path, spans_df):
    base = f"file://{tmp_path}"
    messages = otlp.encode(spans_df([rich(), rich() | {"seq": 5, "span_id": "ee" * 8}]))
    messages.write.parquet(f"{base}/raw")
    assert raw.raw_batch(spark, "parquet", f"{base}/raw").count() == 2 and raw.raw_batch(spark, "parquet", f"{base}/raw", limit=1).first()["seq"] == 4
    seen = metrics.BatchMetrics()
    spark.streams.addListener(seen)
    stream = otlp.decode(raw.raw_stream(spark, "parquet", f"{base}/raw", maxFilesPerTrigger="1"))
    tables = runner.Tables(spark, f"{base}/tables")
    runner.run_dedup(stream, tables, f"{base}/c").awaitTermination()
    assert tables.read("thin").count() == 2
    for _ in range(50):
        if sum(b[2] for b in seen.batches) >= 2:
            break
        import time

        time.sleep(0.2)
    spark.streams.removeListener(seen)
    assert seen.rows(spark).agg(F.sum("input_rows")).first()[0] == 2 and seen.failures == 0


def test_per_session(spark):
    import pandas as pd

    got = runner.per_session(synth.sessions(spark, 3), lambda f: pd.DataFrame({"session": [f.session.iloc[0]], "spans": [len(f)], "first": [f["name"].iloc[0]]}), "session string, spans bigint, first string")
    rows = got.orderBy("session").collect()
    assert len(rows) == 3 and all(r["first"] in ("pick_greeting", "chat gpt-4o-mini") for r in rows) and all(r["spans"] >= 5 for r in rows)


def test_template_identity(spans_df):
    assert one(spans_df([span(attributes=kvs(gen_ai__prompt__name="greeting"))]), A.has_template())[0] and not one(spans_df([span()]), A.has_template())[0]


def test_every_kind_of_value_survives(spark):
    request = otlp.request_class()()
    ss = request.resource_spans.add().scope_spans.add()
    s = ss.spans.add(trace_id=b"\x01" * 16, span_id=b"\x02" * 8, name="n", kind=3, trace_state="a=b", start_time_unix_nano=5)
    s.status.code = 7  # a code of a later protocol
    s.MergeFromString(bytes([0x50, 0x05]))  # field 10, a count that no column holds
    v = lambda key: s.attributes.add(key=key).value
    v("text").string_value = "ref"
    v("empty").string_value = ""
    v("int").int_value = -(2**63)
    v("double").double_value = 0.5
    v("bool").bool_value = False
    v("bytes").bytes_value = b"\x00\xff"
    v("strings").array_value.values.add(string_value="x")
    v("nothing").array_value.SetInParent()
    ints = v("ints").array_value.values
    ints.add(int_value=1)
    ints.add(string_value="two")
    inner = v("map").kvlist_value.values.add(key="k").value.array_value.values.add()
    inner.kvlist_value.values.add(key="deep").value.bytes_value = b"z"
    s.attributes.add(key="unset")
    s.links.add(trace_id=b"\x03" * 16, span_id=b"\x04" * 8, trace_state="c=d")
    raw_bytes = request.SerializeToString()
    first = otlp.decode(spark.createDataFrame([(raw_bytes, 1), (b"\xff\xff", 2)], "value binary, seq bigint"))
    second = thin.decode(thin.encode(first))
    row = first.first()
    assert row["kind"] == "SPAN_KIND_CLIENT" and row["trace_state"] == "a=b" and row["status_code"] == "7" and first.count() == 1
    for df in (first, second):
        back = otlp.request_class().FromString(otlp.encode(df).first()["value"])
        assert back.resource_spans[0].scope_spans[0].spans[0] == s
    assert second.select(A.first_string("ints"), A.first_string("strings")).first()[:] == ("", "x")


def test_bad_messages_are_kept_apart(spark):
    df = spark.createDataFrame([(otlp.request_class()().SerializeToString(), 1, "a"), (b"\xff\xff", 2, "b"), (None, 3, "c")], "value binary, seq bigint, topic string")
    assert [tuple(r) for r in otlp.quarantine(df).collect()] == [(b"\xff\xff", 2, "b")]


def test_a_trace_is_read_from_its_folders(spark, spans_df, tmp_path):
    a = archive.Archive(spark, f"file://{tmp_path}/archive")
    hour = 3_600_000_000_000
    a.append(spans_df([span(trace_id=f"{i:032x}", start_ns=i * hour, seq=i) for i in range(30)]), 0)
    a.append(spans_df([span(trace_id=f"{5:032x}", start_ns=29 * hour, seq=99)]), 1)
    got = a.load_trace(f"{5:032x}")
    assert [(r["hour"], r["batch_id"]) for r in got.collect()] == [(5, 0), (5, 1)]
    assert len(got.inputFiles()) >= 2
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "hour" in plan.split("PartitionFilters: [")[1].split("]")[0]
    a.append(spans_df([span(trace_id=f"{5:032x}", start_ns=29 * hour, seq=99)]), 1)  # a replay
    assert a.load_trace(f"{5:032x}").count() == 2
