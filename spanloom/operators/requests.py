"""Restoring as a service would: requests are checked, results go to a folder, and every outcome is named and counted."""

from __future__ import annotations

import time
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .archive import Archive, TraceNotFound, parse_window
from .restore import as_json, restore_range, restore_trace

#: Upper bounds of the latency histogram in seconds; a last bucket takes the rest. Fixed values of the usual metrics clients.
BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)


@dataclass(frozen=True)
class Answer:
    """``status``: ``ok``, ``not_found``, ``bad_request``, ``unresolved`` (a chunk is missing or damaged) or ``error``; ``spans`` that were written, and what went wrong."""

    status: str
    spans: int = 0
    error: str | None = None


class RestoreMetrics:
    """Requests by mode and status, spans and latencies by mode, and failures to resolve a reference."""

    def __init__(self) -> None:
        self.requests: Counter[tuple[str, str]] = Counter()
        self.spans: Counter[str] = Counter()
        self.latency: dict[str, list[int]] = {}
        self.ref_errors = 0

    def observe(self, mode: str, answer: Answer, seconds: float) -> None:
        self.requests[mode, answer.status] += 1
        self.spans[mode] += answer.spans
        self.latency.setdefault(mode, [0] * (len(BUCKETS) + 1))[bisect_left(BUCKETS, seconds)] += 1
        self.ref_errors += answer.status == "unresolved"

    def rows(self, spark: SparkSession) -> DataFrame:
        """``name, mode, label, value`` of all counters."""
        out = [("requests", m, s, n) for (m, s), n in self.requests.items()] + [("spans", m, "", n) for m, n in self.spans.items()]
        out += [("latency", m, str(b), n) for m, counts in self.latency.items() for b, n in zip((*BUCKETS, "inf"), counts)]
        return spark.createDataFrame([*out, ("ref_errors", "", "", self.ref_errors)], "name string, mode string, label string, value bigint")


class RestoreService:
    """Restores out of an archive and a store into folders of JSON lines (``service, scope, span``). A range may be of any size, so nothing of it comes back but its count."""

    def __init__(self, archive: Archive, store: DataFrame, metrics: RestoreMetrics | None = None) -> None:
        self.archive, self.store, self.metrics = archive, store, metrics or RestoreMetrics()

    def trace(self, trace_id: str, out: str) -> Answer:
        return self._answer("single", lambda: restore_trace(self.archive, self.store, trace_id), out)

    def range(self, frm: str, to: str, out: str, session_id: str | None = None) -> Answer:
        """``frm`` and ``to``: RFC 3339, both needed."""

        def spans() -> DataFrame:
            if not frm or not to:
                raise ValueError("both ends of the window are needed")
            return restore_range(self.archive, self.store, *parse_window(frm, to), session_id)

        return self._answer("range", spans, out)

    def _answer(self, mode: str, spans, out: str) -> Answer:
        began = time.monotonic()
        try:
            seen = Observation()
            as_json(spans().observe(seen, F.count("*").alias("n"))).write.mode("overwrite").json(out)
            answer = Answer("ok", seen.get["n"])
        except TraceNotFound as e:
            answer = Answer("not_found", error=f"no trace {e}")
        except ValueError as e:
            answer = Answer("bad_request", error=str(e))
        except Exception as e:  # whatever a source or a store may raise is an answer, too
            answer = Answer("unresolved" if "chunks missing or damaged" in str(e) else "error", error=str(e).split("\n", 1)[0])
        self.metrics.observe(mode, answer, time.monotonic() - began)
        return answer
