"""Reports of a streaming query in a versioned table that stays small.

Every report is stored as it comes, as a part of its own, so none is lost with the driver. Parts are
merged by tiers (``FAN`` of a tier become one of the next), so readers list few files however long
the query runs. Days past their retention are folded into one row per query that carries their sums:
totals are the same before and after, only the old days' single batches are gone.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens import schemas
from hirelens.sources.versions import Store
from hirelens.streaming import metrics

TABLE = "reports"
FAN = 16
#: The number of the next part.
NEXT = "next_part"


class MetricStore:
    """The reports below one root; one writer at a time."""

    def __init__(self, spark: SparkSession, root: str, fan: int = FAN):
        self.spark, self.store, self._fan = spark, Store(spark, root), fan
        self._lock = threading.Lock()

    def read(self, parts: list[str] | None = None) -> DataFrame:
        return self.store.read(self.store.current(), TABLE, schemas.REPORT, parts)

    def add(self, rows: DataFrame) -> None:
        with self._lock:
            self._replace([], rows, 0)
            while (full := self._full()) is not None:
                tier, parts = full
                self._replace(parts, self.read(parts), tier + 1)

    def _full(self) -> tuple[int, list[str]] | None:
        tiers: dict[int, list[str]] = {}
        for part in sorted(self.store.current().tables.get(TABLE, {})):
            tiers.setdefault(int(part.split("-")[0]), []).append(part)
        return next(((t, parts[: self._fan]) for t, parts in sorted(tiers.items()) if len(parts) >= self._fan), None)

    def _replace(self, parts: list[str], rows: DataFrame, tier: int) -> None:
        draft = self.store.draft()
        number = draft.notes.get(NEXT, 0)
        draft.notes[NEXT] = number + 1
        part = f"{tier}-{number:012d}"
        folder = f"{draft.folder(TABLE)}/{part}"
        rows.coalesce(1).write.parquet(f"{self.store.root}/{folder}")
        draft.part(TABLE, part, folder)
        for old in parts:
            draft.part(TABLE, old, None)
        draft.publish()

    def fold_before(self, day: str) -> None:
        """Keep of the batches before a day (``yyyy-MM-dd``) their sums only; one row per query."""
        with self._lock:
            parts = sorted(self.store.current().tables.get(TABLE, {}))
            rows = self.read(parts)
            old = F.col("recorded_at") < F.lit(day).cast("timestamp")
            # a batch that ran again counts once, as it does in the series
            batches = metrics.batches(rows.filter(old))
            sums = ("received", "rejected", "landed", "late")
            folded = batches.groupBy("query_id").agg(
                F.max_by("run_id", "batch_id").alias("run_id"), F.max("batch_id").alias("batch_id"), F.max("recorded_at").alias("recorded_at"),
                *(F.sum(name).alias(name) for name in sums), F.max_by("input_rate", "batch_id").alias("input_rate"), F.max_by("lag", "batch_id").alias("lag"),
                F.max_by("duration_ms", "batch_id").alias("duration_ms"),
            )
            kept = rows.filter(~old | old.isNull()).unionByName(folded)
            tier = max((int(p.split("-")[0]) for p in parts), default=0)
            self._replace(parts, kept, tier)


class StoredRecorder(metrics.Recorder):
    """Puts every report of the session's queries of one name into a store."""

    def __init__(self, spark: SparkSession, root: str, query_name: str, fan: int = FAN):
        super().__init__(spark, root, query_name)
        self.stored = MetricStore(spark, root, fan)

    def onQueryProgress(self, event) -> None:
        if event.progress.name == self._name:
            self.stored.add(self._spark.createDataFrame([metrics.report(event.progress)], schemas.REPORT))


def record(spark: SparkSession, root: str, query_name: str = "bronze_ingestion", fan: int = FAN) -> StoredRecorder:
    """Start recording into the store below a root, which may hold reports of earlier runs."""
    recorder = StoredRecorder(spark, root, query_name, fan)
    spark.streams.addListener(recorder)
    return recorder


def series(spark: SparkSession, root: str) -> DataFrame:
    return metrics.series(MetricStore(spark, root).read())
