"""Shapes of spans and of the tables that are derived from them."""

from __future__ import annotations

from dataclasses import dataclass

#: A tagged value: exactly one of the first five is set, or none. Lists with more than strings, lists of keys and values, and bytes are
#: kept whole in ``x``, in protobuf's JSON form; a list then has its strings in ``a`` as well, empty ones for others.
VALUE = "struct<s:string,i:bigint,d:double,b:boolean,a:array<string>,x:string>"
#: Attributes are an ordered list; keys may repeat, and the first one counts.
ATTRS = f"array<struct<key:string,value:{VALUE}>>"
EVENTS = f"array<struct<name:string,time_ns:bigint,attributes:{ATTRS}>>"
LINKS = f"array<struct<trace_id:string,span_id:string,attributes:{ATTRS},trace_state:string>>"
RESOURCE = f"struct<attributes:{ATTRS}>"
SCOPE = f"struct<name:string,version:string,attributes:{ATTRS}>"

#: One row for each span, resource and scope copied down. ``seq`` is the order of arrival; ``rest`` the encoded fields of a span
#: that have no column.
SPAN_FIELDS = {
    "service": "string", "scope": "string", "resource": RESOURCE, "scope_full": SCOPE,
    "trace_id": "string", "span_id": "string", "parent_span_id": "string", "name": "string",
    "start_ns": "bigint", "end_ns": "bigint", "status_code": "string", "status_message": "string",
    "attributes": ATTRS, "events": EVENTS, "links": LINKS, "kind": "string", "trace_state": "string", "rest": "binary", "seq": "bigint",
}
SPAN = ", ".join(f"{k} {v}" for k, v in SPAN_FIELDS.items())
MESSAGES = "array<struct<role:string,content:string>>"


@dataclass(frozen=True)
class Table:
    """A table of which the latest row of each key counts."""

    name: str
    key: tuple[str, ...]
    version: tuple[str, ...]
    partition: str | None = None


TF_SPANS = Table("tf_spans", ("session_id", "ts", "span_id"), ("inserted_at", "seq"), "date")
USER_SESSIONS = Table("user_sessions", ("user_id", "date", "session_id", "trace_id"), ("inserted_at", "seq"), "date")
SESSION_END_REASON = Table("session_end_reason", ("session_id",), ("classified_at", "seq"), "date")
ARCHIVE_INDEX = Table("archive_index", ("trace_id", "ts", "bundle_key"), ("inserted_at", "seq"), "date")
