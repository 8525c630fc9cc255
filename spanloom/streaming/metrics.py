"""Counters of running queries, for dashboards or logs."""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from ..functions import refs

SCHEMA = "query string, batch_id bigint, input_rows bigint, rows_per_second double, duration_ms bigint"


class BatchMetrics(StreamingQueryListener):
    """Keeps the progress of the last batches of all queries; ``totals`` has batches and rows of each query since the start, and ``failures`` how often one ended by an error."""

    def __init__(self, keep: int = 1000) -> None:
        self.batches: deque[tuple] = deque(maxlen=keep)
        self.totals: dict[str, tuple[int, int]] = {}
        self.failures = 0

    def onQueryStarted(self, event) -> None: ...

    def onQueryIdle(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        p = event.progress
        name = p.name or str(p.id)
        n, rows = self.totals.get(name, (0, 0))
        self.totals[name] = n + 1, rows + p.numInputRows
        self.batches.append((p.name or str(p.id), p.batchId, p.numInputRows, float(p.processedRowsPerSecond or 0), int(p.batchDuration)))

    def onQueryTerminated(self, event) -> None:
        self.failures += event.exception is not None

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.batches), SCHEMA)


class DedupMetrics(StreamingQueryListener):
    """Running totals of deduplicating streams, as the plan itself counts them while a batch goes through: no second pass.

    A query that is started again on its checkpoint counts on from 0, as a process that is started again does. ``ended`` has the run ids of queries whose events have all arrived.
    """

    NAMES = ("spans", "candidates", "chunks", "misses", "hits", "content_bytes", "stored_bytes", "ref_bytes", "bad")

    def __init__(self) -> None:
        self.totals = dict.fromkeys(self.NAMES, 0)
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None: ...

    def onQueryIdle(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        for row in event.progress.observedMetrics.values():
            for name, value in row.asDict().items():
                if name in self.totals:
                    self.totals[name] += value or 0
        t = self.totals
        t["hits"] = t["chunks"] - t["misses"]
        t["ref_bytes"] = len(refs.PREFIX) * t["candidates"] + 65 * t["chunks"] - t["candidates"]  # a prefix, 64 letters for each hash, commas between

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([tuple(self.totals[n] for n in self.NAMES)], ", ".join(f"{n} bigint" for n in self.NAMES))
