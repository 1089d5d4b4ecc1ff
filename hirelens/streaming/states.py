"""What became of each query of a session: started, ran so many batches, failed or stopped."""

from __future__ import annotations

import threading
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from hirelens import schemas

RUNNING, FAILED, STOPPED, FINISHED = "running", "failed", "stopped", "finished"


@dataclass
class _Run:
    name: str
    state: str = RUNNING
    batches: int = 0
    rows: int = 0
    error: str | None = None


class QueryStates(StreamingQueryListener):
    """Follows the queries of a session; its memory grows with their number only.

    A query that ends without an error has finished if it was to take what is there, and was stopped
    otherwise; ``stopping`` says which queries somebody asked to stop.
    """

    def __init__(self) -> None:
        self._runs: dict[str, _Run] = {}
        self._stopping: set[str] = set()
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self._runs[str(event.runId)] = _Run(event.name or str(event.id))
            self._ended.setdefault(str(event.runId), threading.Event())

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self._lock:
            run = self._runs.get(str(progress.runId))
            if run is not None and progress.numInputRows:
                run.batches, run.rows = run.batches + 1, run.rows + progress.numInputRows

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            run = self._runs.setdefault(str(event.runId), _Run(str(event.id)))
            stopped = str(event.runId) in self._stopping
            run.state = FAILED if event.exception else STOPPED if stopped else FINISHED
            run.error = event.exception
            self._ended.setdefault(str(event.runId), threading.Event()).set()

    def stop(self, query: StreamingQuery) -> None:
        with self._lock:
            self._stopping.add(str(query.runId))
        query.stop()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Return once the end of a query has been reported."""
        with self._lock:
            ended = self._ended.setdefault(str(query.runId), threading.Event())
        if not ended.wait(seconds):
            raise TimeoutError(f"no end of query {query.name} was reported")

    def table(self, spark: SparkSession) -> DataFrame:
        """One row per query: name, state, batches and rows read, error."""
        with self._lock:
            rows = [(r.name, r.state, r.batches, r.rows, r.error) for r in self._runs.values()]
        return spark.createDataFrame(rows, schemas.QUERY_STATE)


def watch(spark: SparkSession) -> QueryStates:
    states = QueryStates()
    spark.streams.addListener(states)
    return states


def supervise(spark: SparkSession, states: QueryStates, queries: list[StreamingQuery]) -> DataFrame:
    """Wait until one of the queries ends, stop the others, and return what became of each.

    Unlike ``bronze.supervise`` it raises nothing: the error is in the table.
    """
    while all(query.isActive for query in queries):
        for query in queries:
            try:
                query.awaitTermination(1)
            except Exception:  # its message is reported to the listener
                break
    for query in queries:
        if query.isActive:
            states.stop(query)
    for query in queries:
        states.wait(query)
    return states.table(spark)
