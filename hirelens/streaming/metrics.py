"""Health metrics of a streaming query: every progress report, recorded once, and series over them."""

from __future__ import annotations

import threading
from collections import defaultdict
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from hirelens import schemas
from hirelens.plans import dashboards
from hirelens.streaming.bronze import LANDED, QUALITY

LATE_ROWS = "late_rows"


def _lag(progress) -> float:
    """Messages the source holds that the query has not read; zero where a source tells nothing."""
    lag = 0.0
    for source in progress.sources:
        reported = (source.metrics or {}).get("maxOffsetsBehindLatest")
        lag = max(lag, float(reported or 0))
    return lag


def report(progress) -> tuple:
    """One progress report in the layout of ``schemas.REPORT``."""
    quality = progress.observedMetrics.get(QUALITY)
    landed = progress.observedMetrics.get(LANDED)
    return (
        str(progress.id),
        str(progress.runId),
        progress.batchId,
        datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00")),
        quality.received if quality is not None else 0,
        quality.rejected if quality is not None else 0,
        landed.rows if landed is not None else 0,
        sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators),
        float(progress.inputRowsPerSecond or 0.0),
        _lag(progress),
        float(progress.durationMs.get("triggerExecution", 0)),
    )


class Recorder(StreamingQueryListener):
    """Adds every report of the session's queries of one name to a table, as it comes.

    Spark keeps only the last reports of a query in memory; a listener sees all of them.
    """

    def __init__(self, spark: SparkSession, path: str, query_name: str):
        self._spark, self._path, self._name = spark, path, query_name
        self._ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if event.progress.name == self._name:
            rows = self._spark.createDataFrame([report(event.progress)], schemas.REPORT)
            rows.coalesce(1).write.mode("append").parquet(self._path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended[str(event.runId)].set()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Return once all reports of an ended query are in the table."""
        if not self._ended[str(query.runId)].wait(seconds):
            raise TimeoutError(f"no end of query {query.name} was reported")


def record(spark: SparkSession, path: str, query_name: str = "bronze_ingestion") -> Recorder:
    """Start recording; the table exists from the start, so readers need not wait for a report."""
    spark.createDataFrame([], schemas.REPORT).write.mode("append").parquet(path)
    recorder = Recorder(spark, path, query_name)
    spark.streams.addListener(recorder)
    return recorder


def batches(reports: DataFrame) -> DataFrame:
    """One row per query and batch. A batch that ran again, or was reported idle before, counts once."""
    keys = ("query_id", "batch_id")
    rest = [name for name in reports.columns if name not in keys]
    best = F.max(F.struct("received", "landed", "recorded_at", F.struct(*rest).alias("all")))
    return reports.groupBy(*keys).agg(best.alias("best")).select(*keys, "best.all.*")


def series(reports: DataFrame) -> DataFrame:
    """Six metrics per micro-batch; totals run over all batches of a query, across restarts.

    The Bronze total counts rows that passed de-duplication, so repeats and late rows are not in
    it; late rows have a total of their own.
    """
    so_far = Window.partitionBy("query_id").orderBy("batch_id")

    def total(name: str):
        return F.sum(name).over(so_far).cast("double")

    metrics = {
        dashboards.INGEST_RATE: F.col("input_rate"),
        dashboards.LAG: F.col("lag"),
        dashboards.BRONZE_ROWS: total("landed"),
        dashboards.BATCH_DURATION: F.col("duration_ms"),
        dashboards.FAILED: total("rejected"),
        LATE_ROWS: total("late"),
    }
    wide = batches(reports).select("recorded_at", *[v.alias(k) for k, v in metrics.items()])
    pairs = [F.struct(F.lit(k).alias("metric_name"), F.col(k).alias("value")) for k in metrics]
    return wide.select(F.explode(F.array(*pairs)).alias("metric"), "recorded_at").select(
        "metric.metric_name", "metric.value", "recorded_at"
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    return series(spark.read.schema(schemas.REPORT).parquet(path))


def backlog(reports: DataFrame, landed: DataFrame) -> DataFrame:
    """The lag of a source that reports none: rows that have landed and no query has read yet."""
    read_rows = reports.transform(batches).agg(F.coalesce(F.sum("received"), F.lit(0)).alias("read"), F.max("recorded_at").alias("recorded_at"))
    waiting = landed.agg(F.count("*").alias("landed"))
    return waiting.join(F.broadcast(read_rows)).select(
        F.lit(dashboards.LAG).alias("metric_name"),
        F.greatest(F.col("landed") - F.col("read"), F.lit(0)).cast("double").alias("value"),
        "recorded_at",
    )
