"""Thin lines to bundles, flushed by size or by time, whichever comes first."""

from __future__ import annotations

import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..sources import bundles, thin
from .runner import ROCKSDB, STATE_STORE

#: Bytes of lines of a key from which on they are flushed, and seconds after which they are in any case. Fixed values of the usual set-up.
FLUSH_BYTES, FLUSH_SECONDS = 32 << 20, 10
#: Keys of an hour: a busy one is buffered by so many.
PARTS = 16
LINE = "date string, hour int, trace_id string, session_id string, value string, seq bigint"


class Buffer(StatefulProcessor):
    """Lines of one key wait in state; a timer that starts with the first of them, or their size, lets them go."""

    def __init__(self, most: int, seconds: float) -> None:
        self.most, self.millis = most, int(seconds * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.lines = handle.getListState("lines", "trace_id string, session_id string, value string, seq bigint")
        self.size = handle.getValueState("size", "bytes bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self.size.get()[0] if self.size.exists() else None
        for frame in rows:
            if held is None:
                held = 0
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.millis)
            self.lines.appendList(list(frame[["trace_id", "session_id", "value", "seq"]].itertuples(index=False, name=None)))
            held += int(frame["value"].str.len().sum())
            self.size.update((held,))
            if held >= self.most:
                yield from self._flush(key)
                held = None

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.size.exists():
            yield from self._flush(key)

    def _flush(self, key) -> Iterator[pd.DataFrame]:
        rows = list(self.lines.get())
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.lines.clear()
        self.size.clear()
        out = pd.DataFrame(rows, columns=["trace_id", "session_id", "value", "seq"])
        out.insert(0, "date", key[0])
        out.insert(1, "hour", key[1])
        yield out

    def close(self) -> None: ...


def run_bundles(lines: DataFrame, path: str, checkpoint: str, most: int = FLUSH_BYTES, seconds: float = FLUSH_SECONDS, every: str = "1 second") -> StreamingQuery:
    """lines: a stream of ``value, seq`` of thin spans. Each goes to a frame of its trace and event hour, as soon as its key has ``most`` bytes or its first line has waited ``seconds``.

    Only trace, time and session of a line are parsed. What waits is state, in the checkpoint: a query that is started again goes on from there, and a batch that is repeated replaces its
    bundles. A key is a part of an hour, so a busy hour waits in several tasks, and none holds more than ``most`` bytes and one batch of a key.
    """
    spark = lines.sparkSession
    at = F.timestamp_millis(F.expr("start_ns div 1000000"))
    own = thin.narrow(lines).select(F.to_date(at).cast("string").alias("date"), F.hour(at).alias("hour"), "trace_id", "session_id", "value", "seq").filter("trace_id IS NOT NULL AND date IS NOT NULL")
    keyed = own.withColumn("part", F.pmod(F.xxhash64("trace_id"), F.lit(PARTS)))
    flushed = keyed.groupBy("date", "hour", "part").transformWithStateInPandas(Buffer(most, seconds), LINE, "Append", "ProcessingTime")

    def each(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if not batch.isEmpty():  # most batches let nothing go
                bundles.write(bundles.pack(batch), path, most, f"b{batch_id}")
        finally:
            batch.unpersist()

    bundles.register(spark)
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        return flushed.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(processingTime=every).start()
    finally:
        spark.conf.set(STATE_STORE, before)


def caught_up(query: StreamingQuery) -> None:
    """Wait until a batch finds nothing new. (Queries with timers run batches without end, so ``processAllAvailable`` doesn't return.)"""
    first = query.lastProgress.batchId if query.lastProgress else -1
    while query.isActive and not ((p := query.lastProgress) and p.batchId > first and p.numInputRows == 0):
        time.sleep(0.1)


def finish(query: StreamingQuery, seconds: float = FLUSH_SECONDS) -> None:
    """The last flush: take what has come, let all timers run out, and stop."""
    caught_up(query)
    time.sleep(seconds)
    for _ in range(2):  # the batch that is running may have begun before the timers ran out, the next one not
        caught_up(query)
    query.stop()
