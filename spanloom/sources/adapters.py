"""The driver's tables as spans, facts and stores, so that each query has an SQL twin over the same input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import ATTRS, EVENTS, LINKS, RESOURCE, SCOPE, SPAN_FIELDS
from ..session import table

#: Days that count as today and as the start of the contact window.
AS_OF = "2024-01-30"


def event_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact rows from ``events``; every tenth row comes again later with another latency, as a replay would bring it."""
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("n"), F.date_trunc("millisecond", "ts").alias("ts"), F.floor("value").cast("bigint").alias("v"))
    pick = lambda values, k: F.element_at(F.array(*map(F.lit, values)), (F.col("n") % k + 1).cast("int"))
    blank = F.col("n") % 37 == 5
    once = e.select(
        F.md5(F.expr("CAST(n div 6 AS STRING)").cast("binary")).alias("trace_id"), F.substring(F.md5(F.col("n").cast("string").cast("binary")), 1, 16).alias("span_id"),
        F.when(blank, "").otherwise(F.concat(F.lit("visit-"), F.expr("n div 18"))).alias("session_id"), "ts",
        pick(["router", "planner", "writer", "critic"], 4).alias("service"),
        pick(["chat small", "lookup", "plan", "chat large", "chat small", "rank", "store"], 7).alias("span_name"),
        F.when(blank, "").when(F.expr("n div 18") % 3 == 1, "2.1").otherwise("2.0").alias("version"),
        F.when(F.col("n") % 13 == 4, "").when(F.col("n") % 7 == 3, "large").otherwise("small").alias("model"),
        (3 * F.col("v") + F.col("n") % 97).alias("latency_ms"), (F.col("n") * 31 % 1009).alias("input_tokens"), (F.col("n") * 17 % 257).alias("output_tokens"),
        F.when(F.col("n") % 9 == 8, "length").otherwise("stop").alias("finish_reason"),
        F.when(F.col("n") % 23 == 11, "ERROR").otherwise("UNSET").alias("status_code"), F.col("n").alias("seq"), F.lit(1).alias("inserted_at"),
    )
    again = once.filter(F.col("seq") % 10 == 0).withColumns({"latency_ms": F.col("latency_ms") + 7, "inserted_at": F.lit(2)})
    return once.unionByName(again)


def event_user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of users by day, every seventh row delivered twice."""
    e = table(spark, sf_dir, "events")
    once = e.select(
        F.col("user_id").cast("string").alias("user_id"), F.expr("concat('visit-', event_id div 18)").alias("session_id"),
        F.md5(F.expr("CAST(event_id div 6 AS STRING)").cast("binary")).alias("trace_id"), F.to_date("ts").alias("date"), F.col("event_id").alias("seq"), F.lit(1).alias("inserted_at"),
    )
    return once.unionByName(once.filter("seq % 7 = 0").withColumn("inserted_at", F.lit(2)))


def _value(kind: str, x) -> F.Column:
    fields = {"s": "string", "i": "bigint", "d": "double", "b": "boolean", "a": "array<string>", "x": "string"}
    return F.struct(*[(x if k == kind else F.lit(None)).cast(t).alias(k) for k, t in fields.items()])


def kv(key, kind: str, x) -> F.Column:
    return F.struct((F.lit(key) if isinstance(key, str) else key).alias("key"), _value(kind, x).alias("value"))


def as_spans(df: DataFrame) -> DataFrame:
    """Columns that are missing become null or empty, in the order of the span schema."""
    empty = {"attributes": f"CAST(array() AS {ATTRS})", "events": f"CAST(array() AS {EVENTS})", "links": f"CAST(array() AS {LINKS})"}
    return df.select(*[(F.col(c) if c in df.columns else F.expr(empty.get(c, "NULL"))).cast(t).alias(c) for c, t in SPAN_FIELDS.items()])


def conversation_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model span for each assistant turn of ``conversations``, its prompt the whole history before it.

    The convention of the content follows the conversation's number: JSON, flat, or events.
    """
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    h = c.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("h"))
    one = h.select("conv_id", "h", F.explode(F.filter("h", lambda m: m["role"] == "assistant")).alias("a"))
    before = F.filter("h", lambda m: m["turn"] < F.col("a.turn"))
    turns = F.transform(before, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
    system = F.filter(turns, lambda m: m["role"] == "system")
    others = F.filter(turns, lambda m: m["role"] != "system")
    users = F.filter(turns, lambda m: m["role"] == "user")
    said = F.struct(F.lit("assistant").alias("role"), F.col("a.content").alias("content"))
    last = F.col("a.turn") == F.array_max(F.transform(F.filter("h", lambda m: m["role"] == "assistant"), lambda m: m["turn"]))
    common = F.array(
        kv("session.id", "s", F.when(F.col("conv_id") % 13 == 5, "").otherwise(F.concat(F.lit("sess-"), F.col("conv_id")))), kv("user.id", "s", F.concat(F.lit("user-"), F.col("conv_id") % 17)),
        kv("app.version", "s", F.when(F.col("conv_id") % 4 == 3, "").otherwise(F.concat(F.lit("v"), F.col("conv_id") % 4))), kv("gen_ai.prompt.version", "s", F.lit("v9")),
        kv("gen_ai.request.model", "s", F.when(F.col("conv_id") % 3 == 2, "qwen-lite").otherwise("gpt-4o-mini")),
        kv("gen_ai.usage.input_tokens", "i", F.aggregate(turns, F.lit(0), lambda n, m: n + F.length(m["content"]))), kv("gen_ai.usage.output_tokens", "i", F.length("a.content")),
        kv("gen_ai.request.temperature", "d", (F.col("conv_id") % 70) / 100.0),
        kv("gen_ai.response.finish_reasons", "a", F.array(F.when(last & (F.col("conv_id") % 7 == 1), "length").when(last & (F.col("conv_id") % 7 == 2), "content_filter").otherwise("stop"))),
    )
    json = F.concat(
        F.when(F.size(system) > 0, F.array(kv("gen_ai.system_instructions", "s", F.get(system, F.lit(0))["content"]))).otherwise(F.expr(f"CAST(array() AS {ATTRS})")),
        F.array(kv("gen_ai.input.messages", "s", F.to_json(others)), kv("gen_ai.output.messages", "s", F.to_json(F.array(said)))),
    )
    pair = lambda prefix, i, m: F.array(kv(F.concat(F.lit(prefix), i, F.lit(".role")), "s", m["role"]), kv(F.concat(F.lit(prefix), i, F.lit(".content")), "s", m["content"]))
    flat = F.concat(F.flatten(F.transform(turns, lambda m, i: pair("gen_ai.prompt.", i, m))), pair("gen_ai.completion.", F.lit(0), said))
    event = lambda name, text: F.struct(F.lit(name).alias("name"), F.lit(0).cast("long").alias("time_ns"), F.array(kv("text", "s", text)).alias("attributes"))
    no_events = F.expr(f"CAST(array() AS {EVENTS})")
    events = F.concat(F.when(F.size(users) > 0, F.array(event("gen_ai.content.prompt", F.get(F.reverse(users), F.lit(0))["content"]))).otherwise(no_events), F.array(event("gen_ai.content.completion", F.col("a.content"))))
    kind = F.col("conv_id") % 3
    start = (F.lit(1_704_067_200_000_000_000) + (F.col("conv_id") * 997 % 720) * 3_600_000_000_000 + F.col("a.turn") * 1_500_000_000).cast("long")
    return as_spans(one.select(
        F.lit("dialog-agent").alias("service"), F.lit("dialog").alias("scope"),
        F.struct(F.array(kv("service.name", "s", F.lit("dialog-agent")), kv("host", "s", F.lit("h1"))).alias("attributes")).cast(RESOURCE).alias("resource"),
        F.struct(F.lit("dialog").alias("name"), F.lit("1.0").alias("version"), F.expr(f"CAST(array() AS {ATTRS})").alias("attributes")).cast(SCOPE).alias("scope_full"),
        F.md5(F.concat(F.lit("t"), F.col("conv_id"), F.lit("-"), F.expr("a.turn div 4")).cast("binary")).alias("trace_id"),
        F.substring(F.md5(F.concat(F.lit("s"), F.col("conv_id"), F.lit("-"), F.col("a.turn")).cast("binary")), 1, 16).alias("span_id"),
        F.lit("").alias("parent_span_id"), F.lit("chat").alias("name"), start.alias("start_ns"), (start + (50 + F.col("a.turn")) * 1_000_000).alias("end_ns"),
        F.when(last & (F.col("conv_id") % 5 == 0), "STATUS_CODE_ERROR").otherwise("STATUS_CODE_UNSET").alias("status_code"), F.lit("").alias("status_message"),
        F.concat(common, F.when(kind == 0, json).when(kind == 1, flat).otherwise(F.expr(f"CAST(array() AS {ATTRS})"))).alias("attributes"),
        F.when(kind == 2, events).otherwise(no_events).alias("events"), (F.col("conv_id") * 1000 + F.col("a.turn")).alias("seq"),
    ))


def document_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One span for each document, with its text as system prompt; short ones stay below the threshold of heavy values."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "source")
    start = (F.lit(1_704_067_200_000_000_000) + F.col("doc_id") * 60_000_000_000).cast("long")
    return as_spans(d.select(
        F.concat(F.lit("svc-"), F.col("source")).alias("service"), F.lit("docs").alias("scope"), F.md5(F.concat(F.lit("d"), F.col("doc_id")).cast("binary")).alias("trace_id"),
        F.substring(F.md5(F.concat(F.lit("e"), F.col("doc_id")).cast("binary")), 1, 16).alias("span_id"), F.lit("").alias("parent_span_id"), F.lit("ingest").alias("name"),
        start.alias("start_ns"), (start + 1_000_000).alias("end_ns"), F.lit("STATUS_CODE_OK").alias("status_code"),
        F.array(kv("session.id", "s", F.concat(F.lit("sess-"), F.expr("doc_id div 10"))), kv("gen_ai.system_instructions", "s", F.col("text")), kv("note", "s", F.col("text"))).alias("attributes"),
        F.col("doc_id").alias("seq"),
    ))


def document_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``trace_id, span_id, seq, event_index, attr_index, path, value`` of the heavy texts among ``documents``."""
    d = table(spark, sf_dir, "documents").filter(F.octet_length("text") >= 1024)
    return d.select(
        F.lit("").alias("trace_id"), F.col("doc_id").cast("string").alias("span_id"), F.col("doc_id").alias("seq"), F.lit(-1).alias("event_index"), F.lit(0).alias("attr_index"),
        F.lit("documents.text").alias("path"), F.col("text").alias("value"),
    )


