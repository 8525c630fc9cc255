"""Getters over attribute lists and span columns. A missing or differently typed value reads as the type's zero, never null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def attr(key: str, attrs: str | Column = "attributes") -> Column:
    """The value of the first attribute with that key, or null."""
    return F.get(F.filter(attrs, lambda a: a["key"] == key), F.lit(0))["value"]


def has_attr(key: str, attrs: str | Column = "attributes") -> Column:
    return F.coalesce(F.exists(attrs, lambda a: a["key"] == key), F.lit(False))


def has_attr_prefix(prefix: str, attrs: str | Column = "attributes") -> Column:
    return F.coalesce(F.exists(attrs, lambda a: F.startswith(a["key"], F.lit(prefix))), F.lit(False))


def has_event(name: str, events: str | Column = "events") -> Column:
    return F.coalesce(F.exists(events, lambda e: e["name"] == name), F.lit(False))


def string(key: str, attrs: str | Column = "attributes") -> Column:
    return F.coalesce(attr(key, attrs)["s"], F.lit(""))


def string_or_null(key: str, attrs: str | Column = "attributes") -> Column:
    """Null tells a missing key from an empty value."""
    return F.when(has_attr(key, attrs), string(key, attrs))


def integer(key: str, attrs: str | Column = "attributes") -> Column:
    return F.coalesce(attr(key, attrs)["i"], F.lit(0).cast("long"))


def double(key: str, attrs: str | Column = "attributes") -> Column:
    return F.coalesce(attr(key, attrs)["d"], F.lit(0.0))


def boolean(key: str, attrs: str | Column = "attributes") -> Column:
    return F.coalesce(attr(key, attrs)["b"], F.lit(False))


def first_string(key: str, attrs: str | Column = "attributes") -> Column:
    """Element 0 of a list attribute."""
    return F.coalesce(F.get(attr(key, attrs)["a"], F.lit(0)), F.lit(""))


def first_of(*values: Column) -> Column:
    """The first value that isn't empty."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values], F.lit(""))


def session_id() -> Column:
    return string("session.id")


def user_id() -> Column:
    return string("user.id")


def version() -> Column:
    return first_of(string("app.version"), string("gen_ai.prompt.version"))


def is_root() -> Column:
    return F.coalesce(F.col("parent_span_id"), F.lit("")) == ""


def start_time() -> Column:
    return F.timestamp_micros(F.expr("start_ns div 1000"))


def duration_ns() -> Column:
    return F.col("end_ns") - F.col("start_ns")


def status_code() -> Column:
    return first_of(F.regexp_replace(F.coalesce("status_code", F.lit("")), "^STATUS_CODE_", ""), F.lit("UNSET"))


def unsigned32(x: Column) -> Column:
    """A cast to an unsigned 32-bit integer, which wraps."""
    return x.bitwiseAND(F.lit(4294967295))


def string_bytes(attrs: str | Column = "attributes") -> Column:
    return F.coalesce(F.aggregate(attrs, F.lit(0).cast("long"), lambda n, a: n + F.coalesce(F.octet_length(a["value"]["s"]), F.lit(0))), F.lit(0))


def first_wins(attrs: str | Column = "attributes") -> Column:
    """A map of the string attributes; of equal keys the first counts."""
    return _as_map(attrs, lambda i, j: j < i)


def last_wins(attrs: str | Column = "attributes") -> Column:
    """A map of the non-empty string attributes; of equal keys the last counts."""
    return _as_map(F.filter(attrs, lambda a: F.coalesce(a["value"]["s"], F.lit("")) != ""), lambda i, j: j > i)


def _as_map(attrs: str | Column, shadows) -> Column:
    col = F.col(attrs) if isinstance(attrs, str) else attrs
    numbered = F.transform(col, lambda a, i: F.struct(i.alias("i"), a["key"].alias("key"), a["value"]["s"].alias("s")))
    kept = F.filter(numbered, lambda a: ~F.exists(numbered, lambda b: (b["key"] == a["key"]) & shadows(a["i"], b["i"])))
    return F.map_from_entries(F.transform(kept, lambda a: F.struct(a["key"], a["s"])))


def has_template(attrs: str | Column = "attributes") -> Column:
    """Whether a span says which template its prompt came from."""
    return has_attr("gen_ai.prompt.name", attrs)


def lower_hex(id_bytes: Column) -> Column:
    return F.lower(F.hex(id_bytes))


def is_canonical_trace_id(x: Column) -> Column:
    return x.rlike("^[0-9a-f]{32}$")


def short(x: Column, n: int = 8) -> Column:
    """The first letters of an id, for reports."""
    return F.left(x, F.lit(n))
