"""The permanent archive: spans by event hour, an index of (hour, trace) frames, and loads by trace, session and window."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import attrs as A
from ..schemas import SPAN


def bucketed(spans: DataFrame) -> DataFrame:
    """Spans with the event hour that they belong to; a late span goes to its own hour."""
    return spans.withColumns({"date": F.to_date(A.start_time()), "hour": F.hour(A.start_time())})


def frames(spans: DataFrame) -> DataFrame:
    """``trace_id, date, hour, session_id, ts, spans, bytes``: one row for each trace and hour; the first session that isn't empty counts."""
    s = bucketed(spans).withColumn("_s", A.session_id())
    return s.groupBy("trace_id", "date", "hour").agg(
        F.coalesce(F.min_by(F.nullif("_s", F.lit("")), F.when(F.col("_s") != "", F.col("seq"))), F.lit("")).alias("session_id"),
        F.min(F.date_trunc("millisecond", A.start_time())).alias("ts"), F.count("*").alias("spans"), F.sum(A.string_bytes()).alias("bytes"),
    )


def window_days(frm: datetime, to: datetime) -> tuple[str, str]:
    return frm.astimezone(timezone.utc).date().isoformat(), to.astimezone(timezone.utc).date().isoformat()


def parse_window(frm: str | None = None, to: str | None = None, now: datetime | None = None) -> tuple[datetime, datetime]:
    """RFC 3339 bounds; without them the last whole day."""
    today = (now or datetime.now(timezone.utc)).astimezone(timezone.utc).replace(hour=0, minute=0, second=0, microsecond=0)
    a = _rfc3339(frm, "from") if frm else today - timedelta(days=1)
    b = _rfc3339(to, "to") if to else today
    if b < a:
        raise ValueError("the window ends before it starts")
    return a, b


def _rfc3339(text: str, what: str) -> datetime:
    try:
        t = datetime.fromisoformat(text)
    except ValueError as e:
        raise ValueError(f"{what}: {text!r} is no RFC 3339 time") from e
    if t.tzinfo is None or "T" not in text.upper():
        raise ValueError(f"{what}: {text!r} is no RFC 3339 time")
    return t


class TraceNotFound(LookupError):
    pass


class Archive:
    """Parquet under ``path``: ``spans`` by half day and batch, sorted by hour and trace for row-group pruning, and ``index`` by date.

    A folder costs the driver and the file system the same however little it holds, so a folder for each hour would be most of the work on a
    long archive of quiet hours.
    """

    #: Hour by hour, and there as spans began. A query that doesn't need it loses the sort to the optimiser when it aggregates.
    ORDER = ("date", "hour", "start_ns", "seq")
    #: Hours of a folder.
    FOLDER_HOURS = 12
    #: Frames of a trace that are named in a filter; of more, the list is joined.
    FOLDERS = 200

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def append(self, spans: DataFrame, batch_id: int) -> None:
        """A batch overwrites its own folders only, so a replay replaces itself.

        Folders are rebalanced by their measured size: a busy one is written by several tasks, quiet ones share one. The index is made
        from what was written, so that spans are decoded once.
        """
        batch = F.lit(batch_id).cast("long").alias("batch_id")
        rows = bucketed(spans).select("*", self._from_hour().alias("from_hour"), batch)
        self._write(rows.hint("rebalance", "date", "from_hour").sortWithinPartitions("date", "from_hour", "hour", "trace_id", "start_ns", "seq"), "spans", "date", "from_hour", "batch_id")
        stored = self._files().filter(F.col("batch_id") == batch_id).drop("date", "hour", "from_hour", "batch_id")
        # Frames come from their shuffle by trace; a date's lie together again before they are written, or each task would have files in all folders.
        self._write(frames(stored).select("*", batch).hint("rebalance", "date").sortWithinPartitions("date", "trace_id", "hour"), "index", "date", "batch_id")

    def _write(self, rows: DataFrame, name: str, *folders: str) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(f"{self.path}/{name}")

    def _from_hour(self) -> Column:
        return F.expr(f"hour div {self.FOLDER_HOURS} * {self.FOLDER_HOURS}").cast("int")

    def _files(self) -> DataFrame:
        return self.spark.read.schema(SPAN + ", hour int, date date, from_hour int, batch_id bigint").parquet(f"{self.path}/spans")

    def spans(self) -> DataFrame:
        return self._files().drop("from_hour")

    def index(self) -> DataFrame:
        return self.spark.read.schema("trace_id string, hour int, session_id string, ts timestamp, spans bigint, bytes bigint, batch_id bigint, date date").parquet(f"{self.path}/index")

    def load_trace(self, trace_id: str) -> DataFrame:
        """The index names the folders that hold the trace (a few, however large the archive), and only those are read."""
        index = self.index().filter(F.col("trace_id") == trace_id)
        at = index.select("date", "hour", "batch_id").distinct().limit(self.FOLDERS + 1).collect()
        if not at:
            raise TraceNotFound(trace_id)
        if len(at) > self.FOLDERS:
            return self._of(index).filter(F.col("trace_id") == trace_id).orderBy(*self.ORDER)
        here = F.lit(False)
        for r in at:
            folder = r["hour"] // self.FOLDER_HOURS * self.FOLDER_HOURS
            here = here | ((F.col("date") == F.lit(r["date"])) & (F.col("from_hour") == folder) & (F.col("hour") == r["hour"]) & (F.col("batch_id") == r["batch_id"]))
        return self._files().filter(here & (F.col("trace_id") == trace_id)).drop("from_hour").orderBy(*self.ORDER)

    def load_session(self, session_id: str) -> DataFrame:
        return self._of(self.index().filter(F.col("session_id") == session_id))

    def load_range(self, frm: datetime, to: datetime, session_id: str | None = None, expand_sessions: bool = False) -> DataFrame:
        """Frames whose first span lies in the closed window, in the order of their hours. ``expand_sessions``: all frames of the sessions that it touches."""
        i = self.index()
        hit = i.filter(F.col("date").between(*[F.lit(d).cast("date") for d in window_days(frm, to)]) & F.col("ts").between(F.lit(frm), F.lit(to)))
        if session_id:
            hit = hit.filter(F.col("session_id") == session_id)
        if expand_sessions:
            hit = hit.unionByName(i.join(hit.filter("session_id != ''").select("session_id").distinct(), "session_id", "left_semi").select(i.columns)).distinct()
            return self._of(hit).orderBy(*self.ORDER)
        return self._of(hit).filter(F.col("date").between(*[F.lit(d).cast("date") for d in window_days(frm, to)])).orderBy(*self.ORDER)

    def _of(self, index: DataFrame) -> DataFrame:
        keys = ["trace_id", "date", "hour", "batch_id"]
        return self.spans().join(index.select(keys).distinct(), keys, "left_semi")

    def sample_traces(self, n: int) -> DataFrame:
        return self.index().select("trace_id").distinct().orderBy("trace_id").limit(n)


def trace_ids(spans: DataFrame) -> Iterator[str]:
    """For small results only: the ids of the traces in order of arrival."""
    return (r["trace_id"] for r in spans.groupBy("trace_id").agg(F.min("seq").alias("s")).orderBy("s").toLocalIterator())
