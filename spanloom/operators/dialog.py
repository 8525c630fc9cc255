"""Traces, sessions, dialogues, and why a dialogue ended."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import attrs as A
from ..functions import content as C

#: The reasons, and what a caller says when about to hang up (lower case).
CONNECTION_LOST, HUNG_UP, EXHAUSTED, CONFUSED, UNKNOWN = "connection_lost", "spammer_hung_up", "dialog_exhausted", "agent_confused", "unknown"
BYE_MARKERS = ("до свидания", "всего доброго", "перезвон", "не интересно", "спасибо, не надо", "кладу трубку", "отключаюсь", "хорошего дня")
#: The service whose model spans carry the signals of a dialogue's end.
DIALOG_SERVICE = "dialog-agent"


def _first_session(value: Column, seq: Column) -> Column:
    return F.coalesce(F.min_by(F.nullif(value, F.lit("")), F.when(value != "", seq)), F.lit(""))


def traces(spans: DataFrame) -> DataFrame:
    """``trace_id, session_id, first_seq, spans, start_ns, end_ns``: a trace's session is the first that isn't empty."""
    s = A.session_id()
    return spans.withColumn("_s", s).groupBy("trace_id").agg(
        _first_session(F.col("_s"), F.col("seq")).alias("session_id"), F.min("seq").alias("first_seq"), F.count("*").alias("spans"),
        F.min("start_ns").alias("start_ns"), F.max("end_ns").alias("end_ns"),
    )


def with_session(spans: DataFrame, columns: dict[str, Column], only: Column | None = None) -> DataFrame:
    """``columns`` of spans with the session of their trace in ``session`` and the trace's place in ``trace_seq``.

    The columns are computed before the join, so that no attribute list is shuffled. Spans without a session form the group
    of the empty session.
    """
    narrow = (spans if only is None else spans.filter(only)).select("trace_id", *[c.alias(n) for n, c in columns.items()])
    return narrow.join(traces(spans).select("trace_id", F.col("session_id").alias("session"), F.col("first_seq").alias("trace_seq")), "trace_id")


def turns(spans: DataFrame) -> DataFrame:
    """``session, start_ns, trace_seq, seq, messages``: of each model span the last user turn and all completions as assistant's.

    Works for histories that repeat all earlier turns as well as for those that hold the new turn only.
    """
    user = C.last_user(C.prompt_messages())
    reply = F.transform(C.completion_messages(), lambda m: C.message(F.lit("assistant"), m["content"]))
    said = F.concat(F.when(user != "", F.array(C.message(F.lit("user"), user))).otherwise(C.none()), reply)
    return with_session(spans, {"start_ns": F.col("start_ns"), "seq": F.col("seq"), "messages": said}, C.is_llm())


def dialogs(spans: DataFrame) -> DataFrame:
    """``session, dialog`` in order of start, then of arrival of trace and span."""
    ordered = F.sort_array(F.collect_list(F.struct("start_ns", "trace_seq", "seq", "messages")))
    return turns(spans).groupBy("session").agg(F.flatten(F.transform(ordered, lambda t: t["messages"])).alias("dialog"))


def count_turns(dialog: Column) -> Column:
    return F.size(F.filter(dialog, lambda m: m["role"] == "user")).cast("long")


def distinct_turns(dialog: Column) -> Column:
    """User turns that differ; a side span that repeats the turn doesn't count again."""
    return F.size(F.array_distinct(F.transform(F.filter(dialog, lambda m: m["role"] == "user"), lambda m: m["content"]))).cast("long")


def session_signals(spans: DataFrame) -> DataFrame:
    """``session, min_start_ns, last_status, last_finish``: the latest model span of the dialogue service; of equal starts the first counts."""
    main = F.coalesce(F.col("service") == DIALOG_SERVICE, F.lit(False)) & C.is_llm()
    of_main = F.when(main, F.struct(A.status_code().alias("status"), A.first_string("gen_ai.response.finish_reasons").alias("finish")))
    narrow = with_session(spans, {"start_ns": F.col("start_ns"), "seq": F.col("seq"), "main": of_main})
    order = F.when(F.col("main").isNotNull(), F.struct(F.col("start_ns").alias("start_ns"), (-F.col("trace_seq")).alias("trace_seq"), (-F.col("seq")).alias("seq")))
    return narrow.groupBy("session").agg(F.min("start_ns").alias("min_start_ns"), F.max_by("main", order).alias("m")).select(
        "session", "min_start_ns", F.coalesce("m.status", F.lit("")).alias("last_status"), F.coalesce("m.finish", F.lit("")).alias("last_finish")
    )


Classifier = Callable[[Column, dict[str, Column]], Column]


def heuristic(dialog: Column, signals: dict[str, Column]) -> Column:
    """Rules over the last turns, first match wins. Any function of the same shape may stand in its place."""
    low = F.lower(signals["last_user"])
    bye = F.lit(False)
    for m in BYE_MARKERS:
        bye = bye | F.contains(low, F.lit(m))
    return (
        F.when(F.size(dialog) == 0, UNKNOWN)
        .when(signals["last_status"] == "ERROR", CONNECTION_LOST)
        .when(signals["last_finish"].isin("content_filter", "length"), CONFUSED)
        .when(bye, HUNG_UP)
        .when(signals["turns"] <= 3, HUNG_UP)
        .otherwise(EXHAUSTED)
    )


def end_reasons(spans: DataFrame, classify: Classifier = heuristic) -> DataFrame:
    """``session_id, end_reason, turns, date`` of every session that has an id."""
    s = session_signals(spans).join(dialogs(spans), "session", "left").filter("session != ''").withColumn("dialog", F.coalesce("dialog", C.none()))
    signals = {"turns": count_turns(F.col("dialog")), "last_status": F.col("last_status"), "last_finish": F.col("last_finish"), "last_user": C.last_user(F.col("dialog"))}
    return s.select(
        F.col("session").alias("session_id"), classify(F.col("dialog"), signals).alias("end_reason"), signals["turns"].alias("turns"),
        F.to_date(F.timestamp_micros(F.expr("min_start_ns div 1000"))).alias("date"),
    )


def end_reason_processor(spans: DataFrame) -> dict[str, DataFrame]:
    return {"session_end_reason": end_reasons(spans)}
