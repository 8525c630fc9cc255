"""Dialogue turns from the three attribute conventions, as arrays of ``role, content``.

A (flat): ``gen_ai.prompt.N.role|content``; B (JSON): one attribute with a JSON list; C (events): the first non-empty string
attribute of a named event. Prompts: B before A before C; completions alike.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import MESSAGES
from . import attrs as A

#: Names of the attributes and events that carry content.
SYSTEM, INPUT, OUTPUT = "gen_ai.system_instructions", "gen_ai.input.messages", "gen_ai.output.messages"
PROMPT_PREFIX, COMPLETION_PREFIX = "gen_ai.prompt.", "gen_ai.completion."
PROMPT_EVENT, COMPLETION_EVENT = "gen_ai.content.prompt", "gen_ai.content.completion"


def none() -> Column:
    return F.expr(f"CAST(array() AS {MESSAGES})")


def message(role: Column, content: Column) -> Column:
    return F.struct(role.alias("role"), content.alias("content"))


def parse_json(raw: Column) -> Column:
    """A JSON list of objects with string or null ``role`` and ``content``; null gives no turns, anything else one user turn.

    The variant type tells these apart where ``from_json`` would coerce: numbers to strings, an object to a list.
    """
    v = F.try_parse_json(raw)
    items = F.try_variant_get(v, "$", "array<variant>")
    kind = lambda x, path: F.coalesce(F.schema_of_variant(F.try_variant_get(x, path, "variant")), F.lit("VOID"))
    text = lambda x, path: F.coalesce(F.try_variant_get(x, path, "string"), F.lit(""))
    plain = F.forall(
        items,
        lambda x: x.isNull()
        | (F.schema_of_variant(x) == "VOID")
        | (F.startswith(F.schema_of_variant(x), F.lit("OBJECT")) & kind(x, "$.role").isin("STRING", "VOID") & kind(x, "$.content").isin("STRING", "VOID")),
    )
    whole = F.array(message(F.lit("user"), raw))
    return (
        F.when(raw == "", none())
        .when(v.isNull(), whole)
        .when(F.schema_of_variant(v) == "VOID", none())
        .when(items.isNotNull() & F.coalesce(plain, F.lit(True)), F.transform(items, lambda x: message(text(x, "$.role"), text(x, "$.content"))))
        .otherwise(whole)
    )


def flat(prefix: str) -> Column:
    """Schema A: by number, ascending. The rest of the key after the number must be exactly role or content."""
    pattern = "^" + prefix.replace(".", r"\.") + r"([0-9]+)\.(role|content)$"
    parts = F.transform(
        F.filter("attributes", lambda a: a["key"].rlike(pattern)),
        lambda a: F.struct(
            F.regexp_extract(a["key"], pattern, 1).cast("decimal(38,0)").alias("n"), F.regexp_extract(a["key"], pattern, 2).alias("what"),
            F.coalesce(a["value"]["s"], F.lit("")).alias("s"),
        ),
    )
    last = lambda n, what: F.coalesce(F.get(F.reverse(F.filter(parts, lambda p: (p["n"] == n) & (p["what"] == what))), F.lit(0))["s"], F.lit(""))
    return F.transform(F.array_sort(F.array_distinct(F.transform(parts, lambda p: p["n"]))), lambda n: message(last(n, "role"), last(n, "content")))


def event(name: str, role: str) -> Column:
    """Schema C: one turn, or none."""
    texts = F.filter(
        F.flatten(F.transform(F.filter("events", lambda e: e["name"] == name), lambda e: F.transform(e["attributes"], lambda a: a["value"]["s"]))),
        lambda s: s.isNotNull() & (s != ""),
    )
    return F.transform(F.slice(texts, 1, 1), lambda s: message(F.lit(role), s))


def _some(x: Column) -> Column:
    return F.coalesce(F.size(x) > 0, F.lit(False))


def prompt_messages() -> Column:
    system = A.string(SYSTEM)
    b = F.concat(F.when(system != "", F.array(message(F.lit("system"), system))).otherwise(none()), parse_json(A.string(INPUT)))
    a = flat(PROMPT_PREFIX)
    return F.when((system != "") | (A.string(INPUT) != ""), b).when(_some(a), a).otherwise(F.coalesce(event(PROMPT_EVENT, "user"), none()))


def completion_messages() -> Column:
    a = flat(COMPLETION_PREFIX)
    return F.when(A.string(OUTPUT) != "", parse_json(A.string(OUTPUT))).when(_some(a), a).otherwise(F.coalesce(event(COMPLETION_EVENT, "assistant"), none()))


def joined(messages: Column) -> Column:
    return F.array_join(F.transform(messages, lambda m: m["content"]), "\n")


def prompt() -> Column:
    return joined(prompt_messages())


def completion() -> Column:
    return joined(completion_messages())


def last_user(messages: Column) -> Column:
    users = F.filter(messages, lambda m: m["role"] == "user")
    return F.coalesce(F.get(F.reverse(users), F.lit(0))["content"], F.lit(""))


def is_llm() -> Column:
    return (A.string(OUTPUT) != "") | A.has_attr_prefix(COMPLETION_PREFIX) | A.has_event(COMPLETION_EVENT)


def system_prompt() -> Column:
    """What audits count as the system prompt: the JSON convention's field, else the flat convention's first turn."""
    return A.first_of(A.string(SYSTEM), A.string("gen_ai.prompt.0.content"))
