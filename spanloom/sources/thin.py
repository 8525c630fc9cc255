"""Thin spans as JSON lines, for interchange."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import RESOURCE, SCOPE, SPAN_FIELDS

#: Field names of the envelope and of a span in protobuf's JSON form.
_JSON_VALUE = "struct<stringValue:string,intValue:string,doubleValue:double,boolValue:boolean,arrayValue:variant,kvlistValue:variant,bytesValue:string>"
_JSON_ATTRS = f"array<struct<key:string,value:{_JSON_VALUE}>>"
_JSON_SPAN = (
    "struct<traceId:string,spanId:string,parentSpanId:string,name:string,startTimeUnixNano:string,endTimeUnixNano:string,"
    f"attributes:{_JSON_ATTRS},events:array<struct<name:string,timeUnixNano:string,attributes:{_JSON_ATTRS}>>,"
    f"links:array<struct<traceId:string,spanId:string,attributes:{_JSON_ATTRS},traceState:string>>,status:struct<code:string,message:string>,kind:string,traceState:string,rest:string>"
)
ENVELOPE = f"struct<service:string,scope:string,resource:struct<attributes:{_JSON_ATTRS}>,scope_full:struct<name:string,version:string,attributes:{_JSON_ATTRS}>,span:{_JSON_SPAN}>"


def _attrs_out(attrs: Column) -> Column:
    v = lambda a: a["value"]
    return F.transform(
        attrs,
        lambda a: F.struct(
            a["key"].alias("key"),
            F.struct(
                v(a)["s"].alias("stringValue"), v(a)["i"].cast("string").alias("intValue"), v(a)["d"].alias("doubleValue"), v(a)["b"].alias("boolValue"),
                F.coalesce(
                    _whole(v(a), "$.arrayValue"),
                    F.when(v(a)["a"].isNotNull(), F.parse_json(F.to_json(F.struct(F.transform(v(a)["a"], lambda s: F.struct(s.alias("stringValue"))).alias("values"))))),
                ).alias("arrayValue"),
                _whole(v(a), "$.kvlistValue").alias("kvlistValue"), F.try_variant_get(F.parse_json(v(a)["x"]), "$.bytesValue", "string").alias("bytesValue"),
            ).alias("value"),
        ),
    )


def _whole(value: Column, path: str) -> Column:
    return F.try_variant_get(F.parse_json(value["x"]), path, "variant")


def _attrs_in(attrs: Column) -> Column:
    v = lambda a: a["value"]
    items = lambda a: F.try_variant_get(v(a)["arrayValue"], "$.values", "array<variant>")
    text = lambda e: F.try_variant_get(e, "$.stringValue", "string")
    odd = lambda a: v(a)["kvlistValue"].isNotNull() | v(a)["bytesValue"].isNotNull() | F.coalesce(F.exists(items(a), lambda e: text(e).isNull()), F.lit(False))
    return F.transform(
        attrs,
        lambda a: F.struct(
            a["key"].alias("key"),
            F.struct(
                v(a)["stringValue"].alias("s"), v(a)["intValue"].cast("bigint").alias("i"), v(a)["doubleValue"].alias("d"), v(a)["boolValue"].alias("b"),
                F.when(v(a)["arrayValue"].isNotNull(), F.coalesce(F.transform(items(a), lambda e: F.coalesce(text(e), F.lit(""))), F.array().cast("array<string>"))).alias("a"),
                F.when(odd(a), F.to_json(F.struct(v(a)["arrayValue"].alias("arrayValue"), v(a)["bytesValue"].alias("bytesValue"), v(a)["kvlistValue"].alias("kvlistValue")))).alias("x"),
            ).alias("value"),
        ),
    )


def _id_out(hex_id: Column) -> Column:
    return F.base64(F.unhex(hex_id))


def _id_in(text: Column, size: int) -> Column:
    """Ids come in base64, as protobuf's JSON form has them, or in hex, as the trace protocol's own JSON form has them."""
    return F.when(F.length(text) == 2 * size, F.lower(text)).otherwise(F.lower(F.hex(F.unbase64(text))))


def encode(spans: DataFrame) -> DataFrame:
    """``trace_id, value``: one JSON line for each span, keyed for transport."""
    span = F.struct(
        _id_out(F.col("trace_id")).alias("traceId"), _id_out(F.col("span_id")).alias("spanId"), _id_out(F.nullif("parent_span_id", F.lit(""))).alias("parentSpanId"), "name",
        F.col("start_ns").cast("string").alias("startTimeUnixNano"), F.col("end_ns").cast("string").alias("endTimeUnixNano"), _attrs_out(F.col("attributes")).alias("attributes"),
        F.transform("events", lambda e: F.struct(e["name"].alias("name"), e["time_ns"].cast("string").alias("timeUnixNano"), _attrs_out(e["attributes"]).alias("attributes"))).alias("events"),
        F.transform("links", lambda x: F.struct(_id_out(x["trace_id"]).alias("traceId"), _id_out(x["span_id"]).alias("spanId"), _attrs_out(x["attributes"]).alias("attributes"), x["trace_state"].alias("traceState"))).alias("links"),
        F.struct(F.col("status_code").alias("code"), F.col("status_message").alias("message")).alias("status"), "kind", F.col("trace_state").alias("traceState"), F.base64("rest").alias("rest"),
    )
    resource = F.when(F.col("resource").isNotNull(), F.struct(_attrs_out(F.col("resource.attributes")).alias("attributes")))
    scope = F.when(F.col("scope_full").isNotNull(), F.struct(F.col("scope_full.name").alias("name"), F.col("scope_full.version").alias("version"), _attrs_out(F.col("scope_full.attributes")).alias("attributes")))
    return spans.select("trace_id", F.to_json(F.struct("service", "scope", resource.alias("resource"), scope.alias("scope_full"), span.alias("span"))).alias("value"), "seq")


def decode(lines: DataFrame, value: str = "value") -> DataFrame:
    """Spans of JSON lines (``value``, ``seq``). A line that is no span is left out; ``poison`` returns those."""
    e = _parsed(lines, value).filter(_is_span())
    s = "e.span"
    zero = lambda c: F.coalesce(F.col(c), F.lit(""))
    return e.select(
        zero("e.service").alias("service"), zero("e.scope").alias("scope"),
        F.when(F.col("e.resource").isNotNull(), F.struct(_attrs_in(F.col("e.resource.attributes")).alias("attributes"))).cast(RESOURCE).alias("resource"),
        F.when(F.col("e.scope_full").isNotNull(), F.struct("e.scope_full.name", "e.scope_full.version", _attrs_in(F.col("e.scope_full.attributes")).alias("attributes"))).cast(SCOPE).alias("scope_full"),
        _id_in(F.col(f"{s}.traceId"), 16).alias("trace_id"), _id_in(F.col(f"{s}.spanId"), 8).alias("span_id"), F.coalesce(_id_in(F.col(f"{s}.parentSpanId"), 8), F.lit("")).alias("parent_span_id"),
        zero(f"{s}.name").alias("name"), F.col(f"{s}.startTimeUnixNano").cast("bigint").alias("start_ns"), F.col(f"{s}.endTimeUnixNano").cast("bigint").alias("end_ns"),
        F.col(f"{s}.status.code").alias("status_code"), zero(f"{s}.status.message").alias("status_message"),
        F.coalesce(_attrs_in(F.col(f"{s}.attributes")), F.array()).cast(SPAN_FIELDS["attributes"]).alias("attributes"),
        F.coalesce(F.transform(f"{s}.events", lambda x: F.struct(x["name"].alias("name"), x["timeUnixNano"].cast("bigint").alias("time_ns"), F.coalesce(_attrs_in(x["attributes"]), F.array()).cast(SPAN_FIELDS["attributes"]).alias("attributes"))), F.array()).cast(SPAN_FIELDS["events"]).alias("events"),
        F.coalesce(F.transform(f"{s}.links", lambda x: F.struct(_id_in(x["traceId"], 16).alias("trace_id"), _id_in(x["spanId"], 8).alias("span_id"), F.coalesce(_attrs_in(x["attributes"]), F.array()).cast(SPAN_FIELDS["attributes"]).alias("attributes"), x["traceState"].alias("trace_state"))), F.array()).cast(SPAN_FIELDS["links"]).alias("links"),
        F.col(f"{s}.kind").alias("kind"), F.col(f"{s}.traceState").alias("trace_state"), F.unbase64(F.col(f"{s}.rest")).alias("rest"),
        "seq",
    )


def poison(lines: DataFrame, value: str = "value") -> DataFrame:
    """Lines that hold no span, for quarantine."""
    return _parsed(lines, value).filter(~_is_span()).select(lines.columns)


def _parsed(lines: DataFrame, value: str) -> DataFrame:
    return lines.withColumn("e", F.from_json(F.col(value), ENVELOPE))


def _is_span() -> Column:
    return F.coalesce(F.col("e.span.traceId").isNotNull() & (F.col("e.span.traceId") != "") & F.col("e.span.startTimeUnixNano").try_cast("bigint").isNotNull(), F.lit(False))


def narrow(lines: DataFrame, value: str = "value") -> DataFrame:
    """Only trace, start and session of each line, as an archiver needs them."""
    shape = f"struct<span:struct<traceId:string,startTimeUnixNano:string,attributes:{_JSON_ATTRS}>>"
    e = lines.withColumn("e", F.from_json(F.col(value), shape))
    first = F.get(F.filter("e.span.attributes", lambda a: a["key"] == "session.id"), F.lit(0))["value"]["stringValue"]
    return e.select(_id_in(F.col("e.span.traceId"), 16).alias("trace_id"), F.col("e.span.startTimeUnixNano").cast("bigint").alias("start_ns"), F.coalesce(first, F.lit("")).alias("session_id"), *[c for c in lines.columns if c == value or c not in ("trace_id", "start_ns", "session_id")])

