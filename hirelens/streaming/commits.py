"""Bronze as batches that are committed once: a ``foreachBatch`` sink with preview and compaction.

Every batch is a part of its own in a versioned table (``sources.versions``). A batch that runs
again, because the query died between the write and its checkpoint, replaces its own part or, if it
has been compacted since, adds nothing; readers see a batch whole or not at all. A batch is computed
once, into its part; what the sink shows (the preview) is read from there and published in the same
version.

Compaction is tiered: FAN parts of a tier become one part of the next, so the number of parts grows
with the logarithm of the batches, not with the batches. Tiers that fill up at once are merged in one
step, so a part is rewritten once per compaction and once per tier at most.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hirelens import schemas
from hirelens.sources.versions import Draft, Store, Version
from hirelens.streaming import bronze

TABLE, PREVIEW = "bronze", "preview"
#: Parts of one tier that become one of the next.
FAN = 8
LAST = "last_batch"


def _part(tier: int, first: int, last: int) -> str:
    return f"{tier}-{first:012d}-{last:012d}"


def _range(part: str) -> tuple[int, int, int]:
    tier, first, last = part.split("-")
    return int(tier), int(first), int(last)


class CommittedSink:
    """Hand it to ``foreachBatch``. One sink writes a table at a time."""

    def __init__(self, spark: SparkSession, root: str, preview_rows: int | None = bronze.PREVIEW_ROWS, fan: int = FAN):
        """``preview_rows`` of each batch go to the preview, all with None, none with 0."""
        self.store, self._preview_rows, self._fan = Store(spark, root), preview_rows, fan

    def __call__(self, batch: DataFrame, number: int) -> None:
        base = self.store.current()
        if any(tier and first <= number <= last for tier, first, last in map(_range, base.tables.get(TABLE, {}))):
            return  # committed and compacted since
        draft, part = self.store.draft(base), _part(0, number, number)
        folder = self._write(draft, TABLE, part, batch)
        rows = read(self.store, draft.preview(), [part])
        if rows.isEmpty():  # a batch that only moves the watermark
            self.store.discard(folder)
            return
        if self._preview_rows != 0:
            shown = bronze.preview(rows)
            self._write(draft, PREVIEW, part, shown if self._preview_rows is None else shown.limit(self._preview_rows))
        draft.notes[LAST] = max(number, draft.notes.get(LAST, -1))
        draft.publish()

    def _write(self, draft: Draft, table: str, part: str, rows: DataFrame) -> str:
        folder = f"{table}/_commit={part}-{draft.run}"
        writer = rows.write.partitionBy(*bronze.PARTITIONS) if table == TABLE else rows.write
        writer.parquet(f"{self.store.root}/{folder}")
        draft.part(table, part, folder)
        return folder

    def compact(self) -> Version:
        """Merge tiers that are full, lowest first, until none is; the version there is if none is.

        A merged part that would be merged again at once is not written on the way.
        """
        for merged, parts in _merges(self.store.current().tables.get(TABLE, {}), self._fan).items():
            draft = self.store.draft()
            rows = read(self.store, draft.base, parts)
            # one file a day, or more where a day outgrows a file; small days share a task
            self._write(draft, TABLE, merged, rows.hint("rebalance", *(F.col(c) for c in bronze.PARTITIONS)))
            for part in parts:
                draft.part(TABLE, part, None)
            draft.publish()
        return self.store.current()


def _merges(there: Iterable[str], fan: int) -> dict[str, list[str]]:
    """The parts that a compaction ends with and has to write, each with the parts there that it is made of."""
    made = {part: [part] for part in there}
    while True:
        tiers: dict[int, list[str]] = {}
        for part in sorted(made, key=_range):
            tiers.setdefault(_range(part)[0], []).append(part)
        full = next((t for t in sorted(tiers) if len(tiers[t]) >= fan), None)
        if full is None:
            return {part: parts for part, parts in made.items() if parts != [part]}
        some = tiers[full][:fan]
        bounds = [_range(p)[1:] for p in some]
        merged = _part(full + 1, min(b[0] for b in bounds), max(b[1] for b in bounds))
        made[merged] = [origin for part in some for origin in made.pop(part)]


def read(store: Store, version: Version | None = None, parts: list[str] | None = None) -> DataFrame:
    """The committed Bronze table, or some parts of it; day folders below each part are pruned."""
    folders = store.folders(version or store.current(), TABLE, parts)
    if not folders:
        return store.spark.createDataFrame([], schemas.BRONZE)
    reader = store.spark.read.schema(schemas.BRONZE).option("basePath", f"{store.root}/{TABLE}")
    return reader.parquet(*folders).select(*schemas.BRONZE.fieldNames())


def read_preview(store: Store, version: Version | None = None) -> DataFrame:
    schema = T.StructType([schemas.BRONZE[name] for name in bronze.PREVIEW_COLUMNS])
    return store.read(version or store.current(), PREVIEW, schema)


def start(
    processed: DataFrame,
    sink: CommittedSink,
    checkpoint: str,
    trigger: str | None = bronze.TRIGGER,
    name: str = "bronze_ingestion",
) -> StreamingQuery:
    """Commit every batch of the stream. Without a trigger: all that is there, then stop."""
    pace = {"availableNow": True} if trigger is None else {"processingTime": trigger}
    return (
        bronze.gathered(processed)
        .writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(**pace)
        .queryName(name)
        .start()
    )
