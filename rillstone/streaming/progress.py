"""Sums over all reports of streaming queries, taken as they come."""

from __future__ import annotations

import threading
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

#: Seconds to wait for the reports of a query that has ended; they come in order on a bus of their own.
LAST_REPORTS = 30


@dataclass
class Totals:
    """What one run of a query has reported so far."""

    batches: set[int] = field(default_factory=set)
    rows_in: int = 0
    late_rows_dropped: int = 0
    watermark: str | None = None
    observed: dict[str, dict[str, int]] = field(default_factory=dict)
    ended: threading.Event = field(default_factory=threading.Event)

    def add(self, report: Any) -> None:
        self.batches.add(report.batchId)
        self.rows_in += report.numInputRows
        self.late_rows_dropped += sum(o.numRowsDroppedByWatermark for o in report.stateOperators)
        self.watermark = report.eventTime.get("watermark") or self.watermark
        for name, row in report.observedMetrics.items():
            sums = self.observed.setdefault(name, {})
            for metric, value in row.asDict().items():
                sums[metric] = sums.get(metric, 0) + (value or 0)


class ProgressTotals(StreamingQueryListener):
    """Totals of every run in a session. Spark itself keeps only the newest reports of each query, so a
    listener is what sees all of them, whether anyone asks in time or not."""

    def __init__(self) -> None:
        self._runs: dict[str, Totals] = {}
        self._lock = threading.Lock()

    def _of(self, run: Any) -> Totals:
        with self._lock:
            return self._runs.setdefault(str(run), Totals())

    def onQueryStarted(self, event: Any) -> None:
        self._of(event.runId)

    def onQueryProgress(self, event: Any) -> None:
        self._of(event.progress.runId).add(event.progress)

    def onQueryIdle(self, event: Any) -> None:
        pass

    def onQueryTerminated(self, event: Any) -> None:
        self._of(event.runId).ended.set()

    def totals(self, query: StreamingQuery) -> Totals:
        """Of one run; complete if the query has ended, since its end is reported last."""
        found = self._of(query.runId)
        if not query.isActive:
            found.ended.wait(LAST_REPORTS)
        return found


_listeners: dict[str, ProgressTotals] = {}


def listen(spark: SparkSession) -> ProgressTotals:
    """The session's listener; registered when first asked for."""
    session = f"{spark.sparkContext.applicationId}/{spark._jsparkSession.hashCode()}"
    if session not in _listeners:
        _listeners[session] = ProgressTotals()
        spark.streams.addListener(_listeners[session])
    return _listeners[session]
