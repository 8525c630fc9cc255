"""Deterministic traffic: fact rows by modular arithmetic for timing, and sessions of spans with growing dialogues for fixtures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .adapters import as_spans, kv

#: The labels that seeded rows go through in turn.
SERVICES = ("greeter", "dialog-agent", "extractor")
SPAN_NAMES = ("pick_greeting", "agent_turn", "classify_intent", "chat gpt-4o-mini", "chat qwen-lite")
FINISH = ("stop", "stop", "stop", "length", "content_filter")
INTENTS = ("greeting", "sales_pitch", "phishing", "request_personal_data", "threat", "smalltalk", "goodbye", "unknown")
SCAMS = ("fake_bank", "prize_fraud", "safe_account", "gov_services", "delivery_fee", "relative_in_trouble", "investment")
REASONS = ("dialog_exhausted", "dialog_exhausted", "spammer_hung_up", "agent_confused", "connection_lost")
SPAN_SECONDS = 259_200
#: How a generated session ends, and how many sessions in a hundred do.
ENDINGS = (("dialog_exhausted", 40), ("spammer_hung_up", 30), ("agent_confused", 15), ("connection_lost", 15))


def _pick(values: tuple[str, ...], n: F.Column) -> F.Column:
    return F.element_at(F.array(*map(F.lit, values)), (n % len(values) + 1).cast("int"))


def _hash(n: F.Column) -> F.Column:
    return F.lower(F.lpad(F.hex(F.xxhash64(n)), 16, "0"))


def seed_facts(spark: SparkSession, rows: int, now: str = "2024-01-30 00:00:00") -> DataFrame:
    """``tf_spans`` rows of which fifteen make a session, spread over three days before ``now``."""
    n = F.col("id")
    qwen = n % 3 == 2
    return spark.range(rows).select(
        _hash(n).alias("trace_id"), _hash(n + 1).alias("span_id"), F.concat(F.lit("sess-"), F.expr("id div 15")).alias("session_id"),
        F.timestamp_seconds(F.unix_timestamp(F.lit(now)) - n % SPAN_SECONDS).alias("ts"), _pick(SERVICES, n).alias("service"), _pick(SPAN_NAMES, n).alias("span_name"),
        F.when(n % 2 == 0, "v3").otherwise("v4").alias("version"), F.when(qwen, "qwen-lite").otherwise("gpt-4o-mini").alias("model"), F.when(qwen, "alibaba").otherwise("openai").alias("provider"),
        (20 + n % 400).alias("latency_ms"), (200 + n % 600).alias("input_tokens"), (50 + n % 200).alias("output_tokens"), (0.2 + (n % 70) / 100.0).cast("float").alias("temperature"),
        _pick(FINISH, n).alias("finish_reason"), F.when(n % 40 == 0, "ERROR").otherwise("UNSET").alias("status_code"), _pick(INTENTS, n).alias("intent"), _pick(SCAMS, n).alias("scam_type"),
        F.concat(F.lit("greet-"), F.lpad((n % 20).cast("string"), 2, "0")).alias("greeting_template"), n.alias("seq"), F.lit(1).alias("inserted_at"),
    )


def seed_end_reasons(spark: SparkSession, rows: int, now: str = "2024-01-30 00:00:00") -> DataFrame:
    n = F.col("id")
    return spark.range(rows // 15).select(
        F.concat(F.lit("sess-"), n).alias("session_id"), _pick(REASONS, n).alias("end_reason"), (2 + n % 14).alias("turns"), F.to_date(F.timestamp_seconds(F.unix_timestamp(F.lit(now)) - n % SPAN_SECONDS)).alias("date"), n.alias("seq")
    )


def seed_user_sessions(spark: SparkSession, rows: int, now: str = "2024-01-30 00:00:00") -> DataFrame:
    n = F.col("id")
    return spark.range(rows // 4).select(
        F.concat(F.lit("+7900"), F.lpad((1_000_000 + n % 40).cast("string"), 7, "0")).alias("user_id"), F.concat(F.lit("sess-"), F.expr("id div 4")).alias("session_id"), _hash(n).alias("trace_id"),
        F.to_date(F.timestamp_seconds(F.unix_timestamp(F.lit(now)) - n % SPAN_SECONDS)).alias("date"), n.alias("seq"),
    )


def sessions(spark: SparkSession, count: int, long: bool = False, turn_bytes: int = 2500, seed: int = 0) -> DataFrame:
    """Spans of ``count`` sessions: a greeting trace, then one trace for each turn with an agent span and an extractor span.

    Every turn's prompt repeats the history, so chunks of earlier turns come again shifted. The content convention is JSON or
    flat by session; endings follow ``ENDINGS``. ``long`` pads turns to ``turn_bytes``.
    """
    bounds, at = [], 0
    for name, share in ENDINGS:
        at += share
        bounds.append((name, at))
    draw = lambda *x: F.pmod(F.xxhash64(F.lit(seed), *x), F.lit(1_000_003))
    s = spark.range(count).withColumn("d", draw(F.col("id"), F.lit("end")) % 100)
    ending = F.lit(ENDINGS[-1][0])
    for name, upto in reversed(bounds[:-1]):
        ending = F.when(F.col("d") < upto, name).otherwise(ending)
    s = s.withColumn("ending", ending).withColumn("turns", F.when(F.col("ending") == "dialog_exhausted", 6 + draw(F.col("id")) % 8).otherwise(2 + draw(F.col("id")) % 4).cast("int"))
    pad = lambda x: F.when(F.octet_length(x) < turn_bytes, F.substring(F.repeat(F.concat(x, F.lit(" ")), turn_bytes), 1, turn_bytes)).otherwise(x) if long else x
    line = lambda who, k: pad(F.concat(F.lit(f"{who} says "), F.md5(F.concat_ws("-", F.lit(who), F.col("id"), k.cast("string")).cast("binary"))))
    bye = F.lit("Спасибо, не надо, до свидания")
    t = s.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)))
    user = lambda k: F.when((F.col("ending") == "spammer_hung_up") & (k == F.col("turns") - 1), bye).otherwise(line("caller", k))
    history = F.flatten(F.transform(F.sequence(F.lit(0), F.col("k")), lambda k: F.array(F.struct(F.lit("user").alias("role"), user(k).alias("content")), F.struct(F.lit("assistant").alias("role"), line("agent", k).alias("content")))))
    prompt = F.slice(history, 1, 2 * F.col("k") + 1)
    reply = F.element_at(history, -1)["content"]
    last = F.col("k") == F.col("turns") - 1
    system = F.concat(F.lit("You keep callers busy. "), F.repeat(F.lit("Stay polite and never give real data. "), 40), (F.col("id") % 4).cast("string"))
    common = F.array(kv("session.id", "s", F.concat(F.lit("sess-"), F.col("id"))), kv("user.id", "s", F.concat(F.lit("+7900"), F.lpad((F.col("id") % 40).cast("string"), 7, "0"))), kv("app.version", "s", F.concat(F.lit("v"), F.col("id") % 4 + 1)))
    json = F.array(kv("gen_ai.system_instructions", "s", system), kv("gen_ai.input.messages", "s", F.to_json(prompt)), kv("gen_ai.output.messages", "s", F.to_json(F.array(F.struct(F.lit("assistant").alias("role"), reply.alias("content"))))))
    flat = F.concat(
        F.array(kv("gen_ai.prompt.0.role", "s", F.lit("system")), kv("gen_ai.prompt.0.content", "s", system)),
        F.flatten(F.transform(prompt, lambda m, i: F.array(kv(F.concat(F.lit("gen_ai.prompt."), i + 1, F.lit(".role")), "s", m["role"]), kv(F.concat(F.lit("gen_ai.prompt."), i + 1, F.lit(".content")), "s", m["content"])))),
        F.array(kv("gen_ai.completion.0.role", "s", F.lit("assistant")), kv("gen_ai.completion.0.content", "s", reply)),
    )
    finish = F.when(last & (F.col("ending") == "agent_confused"), "content_filter").otherwise("stop")
    model = F.array(kv("gen_ai.request.model", "s", F.lit("gpt-4o-mini")), kv("gen_ai.provider.name", "s", F.lit("openai")), kv("gen_ai.usage.input_tokens", "i", F.octet_length(F.to_json(prompt)) / 4), kv("gen_ai.usage.output_tokens", "i", F.octet_length(reply) / 4), kv("gen_ai.response.finish_reasons", "a", F.array(finish)))
    start = (F.lit(1_704_067_200_000_000_000) + F.col("id") * 60_000_000_000 + F.col("k") * 4_000_000_000).cast("long")
    trace = F.md5(F.concat_ws("-", F.lit("trace"), F.col("id"), F.col("k")).cast("binary"))
    span = lambda who: F.substring(F.md5(F.concat_ws("-", F.lit(who), F.col("id"), F.col("k")).cast("binary")), 1, 16)
    agent = as_spans(t.select(
        F.lit("dialog-agent").alias("service"), F.lit("agent").alias("scope"), trace.alias("trace_id"), span("agent").alias("span_id"), F.lit("").alias("parent_span_id"), F.lit("chat gpt-4o-mini").alias("name"),
        start.alias("start_ns"), (start + 300_000_000).alias("end_ns"), F.when(last & (F.col("ending") == "connection_lost"), "STATUS_CODE_ERROR").otherwise("STATUS_CODE_UNSET").alias("status_code"),
        F.concat(common, model, F.when(F.col("id") % 2 == 0, json).otherwise(flat)).alias("attributes"), (F.col("id") * 100_000 + F.col("k") * 10 + 1).alias("seq"),
    ))
    extractor = as_spans(t.select(
        F.lit("extractor").alias("service"), F.lit("extract").alias("scope"), trace.alias("trace_id"), span("extractor").alias("span_id"), span("agent").alias("parent_span_id"), F.lit("classify_intent").alias("name"),
        (start + 310_000_000).alias("start_ns"), (start + 350_000_000).alias("end_ns"),
        F.concat(common, F.array(kv("intent.label", "s", _pick(INTENTS, F.col("id") + F.col("k"))), kv("scam.type", "s", _pick(SCAMS, F.col("id"))))).alias("attributes"), (F.col("id") * 100_000 + F.col("k") * 10 + 2).alias("seq"),
    ))
    greeter = as_spans(s.withColumn("k", F.lit(-1)).select(
        F.lit("greeter").alias("service"), F.lit("greet").alias("scope"), F.md5(F.concat_ws("-", F.lit("greet"), F.col("id")).cast("binary")).alias("trace_id"), span("greet").alias("span_id"), F.lit("").alias("parent_span_id"),
        F.lit("pick_greeting").alias("name"), (start).alias("start_ns"), (start + 20_000_000).alias("end_ns"),
        F.concat(common, F.array(kv("greeting.template_id", "s", F.concat(F.lit("greet-"), F.lpad((F.col("id") % 20).cast("string"), 2, "0"))), kv("greeting.text", "s", F.repeat(F.lit("Good day. "), 120)))).alias("attributes"),
        (F.col("id") * 100_000).alias("seq"),
    ))
    return agent.unionByName(extractor).unionByName(greeter)
