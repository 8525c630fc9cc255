"""Full traces from the archive and the store, the check that says whether raw data may go, and the nested form for export."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import attrs as A
from .archive import Archive
from .dedup import ref_places, resolved, restore, with_texts
from .latest import latest
from .running import running

KEY = ("trace_id", "span_id")


def restore_trace(archive: Archive, store: DataFrame, trace_id: str) -> DataFrame:
    """All spans of a trace in order; a span that was delivered twice comes once. Raises TraceNotFound."""
    spans = latest(archive.load_trace(trace_id), KEY, ("seq",))
    return restore(spans, store).orderBy("start_ns", "seq")


def restore_range(archive: Archive, store: DataFrame, frm: datetime, to: datetime, session_id: str | None = None) -> DataFrame:
    """All traces whose frames start in the closed window. Each chunk is fetched by one join, however many spans share it."""
    return restore(latest(archive.load_range(frm, to, session_id), KEY, ("seq",)), store)


def full_view(spans: DataFrame, store: DataFrame) -> DataFrame:
    """Spans with all text resolved, lazily: a query that reads no content reads no chunk."""
    r = resolved(spans, store)
    return with_texts(spans, r.filter("missing = 0").select("trace_id", "span_id", "seq", "event_index", "attr_index", "text"))


def verify(frames: DataFrame, spans: DataFrame, store: DataFrame, sample: int = 20) -> DataFrame:
    """One row: traces, frames and bytes of a window, how many of the first ``sample`` traces restore, and ``ok``."""
    first = frames.groupBy("trace_id").agg(F.min(F.struct("date", "hour", "trace_id")).alias("at")).orderBy("at").limit(sample).select("trace_id")
    broken = resolved(spans.join(F.broadcast(first), "trace_id", "left_semi"), store).filter("missing > 0 OR damaged > 0").select("trace_id").distinct()
    totals = frames.agg(F.count_distinct("trace_id").alias("traces"), F.count_distinct("date", "hour").alias("bundles"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))
    n, bad = first.agg(F.count("*").alias("sampled")), broken.agg(F.count("*").alias("failed"))
    # Three rows of one value each.
    return totals.crossJoin(F.broadcast(n)).crossJoin(F.broadcast(bad)).select(
        "traces", "bundles", "bytes", "sampled", (F.col("sampled") - F.col("failed")).alias("restored"), "failed", ((F.col("failed") == 0) & (F.col("traces") > 0)).alias("ok")
    )


#: Spans of a request at most, as collectors batch them. A fixed value.
REQUEST_SPANS = 512


def regrouped(spans: DataFrame, most: int = REQUEST_SPANS) -> DataFrame:
    """``service, scope, part, resource, scope_full, spans``: requests of at most ``most`` spans of one service and scope, in order of arrival.

    Spans are numbered by a running count over ranges, so a service that sends a third of them all is cut like any other, and no task gathers it.
    """
    if most < 1:
        raise ValueError("a request holds one span at least")
    numbered, _ = running(spans, ["service", "scope"], ["seq", "trace_id", "span_id"], {"_nth": F.lit(1)})
    span = F.struct("seq", *[c for c in spans.columns if c not in ("service", "scope", "resource", "scope_full", "seq")])
    part = F.floor(F.col("_nth") / most).cast("long").alias("part")
    return numbered.groupBy("service", "scope", part).agg(F.first("resource").alias("resource"), F.first("scope_full").alias("scope_full"), F.sort_array(F.collect_list(span)).alias("spans"))


def deletion_plan(verified: DataFrame, project: str, frm: datetime, to: datetime) -> DataFrame:
    """verified: of ``verify``. What may be deleted at the source: one row for a window that has passed, none for another."""
    iso = lambda t: F.lit(t.isoformat())
    return verified.filter("ok").select(F.lit(project).alias("project"), iso(frm).alias("from"), iso(to).alias("to"), "traces", "bundles", "bytes")


def as_json(spans: DataFrame) -> DataFrame:
    """``service, scope, span``: each span as JSON."""
    body = [c for c in spans.columns if c not in ("service", "scope")]
    return spans.select("service", "scope", F.to_json(F.struct(*body)).alias("span"))


def unresolved(spans: DataFrame) -> DataFrame:
    """References that a restore left behind."""
    return ref_places(spans)


def session_spans(spans: DataFrame) -> DataFrame:
    """Running number of each span in its session, for replays in order."""
    return spans.withColumn("nth", F.row_number().over(Window.partitionBy(A.session_id()).orderBy("start_ns", "seq")))
