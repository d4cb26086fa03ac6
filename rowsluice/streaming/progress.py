"""Progress of streaming loads, from the query's own state."""

from __future__ import annotations

from dataclasses import dataclass
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery


@dataclass(frozen=True)
class LoadProgress:
    """Micro-batches that Spark still remembers, the number of the last one, and their mean seconds.

    Rows are not counted here: a batch that is read more than once inside
    foreachBatch counts its input each time. Count the target instead.
    """

    batches: int
    last_batch: int | None
    mean_seconds: float


def progress_of(query: StreamingQuery) -> LoadProgress:
    """How far a running or finished query is."""
    recent = query.recentProgress
    times = [p["durationMs"].get("triggerExecution", 0) / 1000 for p in recent]
    return LoadProgress(len(recent), recent[-1]["batchId"] if recent else None, sum(times) / len(times) if times else 0.0)


def finished(query: StreamingQuery, seconds: float) -> LoadProgress:
    """Wait for the end of a query; its failure is raised, as is the end of patience."""
    if not query.awaitTermination(int(seconds)):
        raise TimeoutError(f"still running after {seconds} s: {query.status['message']}")
    return progress_of(query)


class LoadListener(StreamingQueryListener):
    """Rows of running loads, from the metrics that ``StagedLoad`` observes in the pass that stages them.

    Register it with ``spark.streams.addListener``. It holds two numbers a table, whatever the length of a
    stream; a batch that is replayed after a restart counts once, by its number.
    """

    def __init__(self, requested: dict[str, int] | None = None):
        self.requested = requested or {}
        self._lock, self._read, self._sound, self._last, self._state, self._names = Lock(), {}, {}, {}, {}, {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self._lock:
            for name, row in progress.observedMetrics.items():
                if not name.startswith(OBSERVED):
                    continue
                table = name[len(OBSERVED) :]
                self._names[str(progress.runId)] = table
                self._state[table] = "loading"
                if progress.batchId > self._last.get(table, -1) and row["read"] is not None:
                    self._last[table] = progress.batchId
                    self._read[table] = self._read.get(table, 0) + row["read"]
                    self._sound[table] = self._sound.get(table, 0) + row["sound"]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            table = self._names.get(str(event.runId))
            if table:
                self._state[table] = "failed" if event.exception else "ready"

    def rows(self, spark: SparkSession) -> DataFrame:
        """table_name, requested, generated (rows read), sound (those that break no rule by themselves) and
        status, as ``progress_totals`` and ``progress_percent`` take them."""
        with self._lock:
            found = [(t, self.requested.get(t, n), n, self._sound[t], self._state[t]) for t, n in self._read.items()]
        return spark.createDataFrame(found, "table_name string, requested long, generated long, sound long, status string")


OBSERVED = "rowsluice load of "
