"""Spans to fact rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import attrs as A


def tf_spans(spans: DataFrame) -> DataFrame:
    """One narrow projection; no content is read."""
    return spans.select(
        "trace_id", "span_id", A.session_id().alias("session_id"), F.date_trunc("millisecond", A.start_time()).alias("ts"),
        F.coalesce("service", F.lit("")).alias("service"), F.coalesce("name", F.lit("")).alias("span_name"), A.version().alias("version"),
        A.string("gen_ai.request.model").alias("model"), A.string("gen_ai.provider.name").alias("provider"),
        A.unsigned32(F.expr("(end_ns - start_ns) div 1000000")).alias("latency_ms"),
        A.unsigned32(A.integer("gen_ai.usage.input_tokens")).alias("input_tokens"),
        A.unsigned32(A.integer("gen_ai.usage.output_tokens")).alias("output_tokens"),
        A.double("gen_ai.request.temperature").cast("float").alias("temperature"),
        A.first_string("gen_ai.response.finish_reasons").alias("finish_reason"), A.status_code().alias("status_code"),
        A.string("intent.label").alias("intent"), A.string("scam.type").alias("scam_type"), A.string("greeting.template_id").alias("greeting_template"),
        "seq",
    )


def user_sessions(spans: DataFrame) -> DataFrame:
    """One row for each root span of a known user in a known session."""
    return spans.filter(A.is_root() & (A.user_id() != "") & (A.session_id() != "")).select(
        A.user_id().alias("user_id"), A.session_id().alias("session_id"), "trace_id", F.to_date(A.start_time()).alias("date"), "seq"
    )


def fact_processor(spans: DataFrame) -> dict[str, DataFrame]:
    """The facts of a batch or of a micro-batch, by table."""
    return {"tf_spans": tf_spans(spans).withColumn("date", F.to_date("ts")), "user_sessions": user_sessions(spans)}
