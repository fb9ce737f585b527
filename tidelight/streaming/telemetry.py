"""One row of figures per non-empty micro-batch."""

from __future__ import annotations

import threading
import time
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener, StreamingQueryProgress

from tidelight import schemas


def metrics_row(progress: StreamingQueryProgress, at: datetime | None = None) -> tuple:
    return (
        at or datetime.now(timezone.utc),
        progress.batchId,
        progress.numInputRows,
        round(progress.inputRowsPerSecond, 2),
        round(progress.processedRowsPerSecond, 2),
        progress.durationMs.get("triggerExecution", 0),
    )


class MetricsListener(StreamingQueryListener):
    """Appends metric rows as CSV with a header, at most every ``flush_seconds`` and when a query ends.

    Only queries with the given name are followed when ``query_name`` is set.
    """

    def __init__(self, spark: SparkSession, path: str, flush_seconds: float = 10.0, query_name: str | None = None):
        self._spark = spark
        self._path = path
        self._flush_seconds = flush_seconds
        self._query_name = query_name
        self._rows: list[tuple] = []
        self._flushed = time.monotonic()
        self._lock = threading.Lock()
        self._ended = threading.Event()
        self._followed: set[str] = set()

    def onQueryStarted(self, event) -> None:
        if not self._query_name or event.name == self._query_name:
            self._followed.add(str(event.runId))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.numInputRows <= 0 or (self._query_name and progress.name != self._query_name):
            return
        row = metrics_row(progress)
        print(f"micro-batch {row[1]}: {row[2]} file(s), {row[4]:.1f} per second, {row[5]} ms")
        with self._lock:
            self._rows.append(row)
            due = time.monotonic() - self._flushed >= self._flush_seconds
        if due:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()
        if not self._query_name or str(event.runId) in self._followed:
            self._ended.set()

    def wait(self, seconds: float = 60.0) -> bool:
        """Wait until a query that is followed has ended and its rows are written; false if that takes longer."""
        return self._ended.wait(seconds)

    def flush(self) -> None:
        with self._lock:
            rows, self._rows = self._rows, []
            self._flushed = time.monotonic()
        if rows:
            try:
                table = self._spark.createDataFrame(rows, schemas.METRICS)
                table.coalesce(1).write.mode("append").option("header", "true").csv(self._path)
            except Exception:
                with self._lock:
                    self._rows = rows + self._rows
                raise


def watch(spark: SparkSession, path: str, **options) -> MetricsListener:
    """Register a :class:`MetricsListener`; remove it with ``spark.streams.removeListener``."""
    listener = MetricsListener(spark, path, **options)
    spark.streams.addListener(listener)
    return listener
