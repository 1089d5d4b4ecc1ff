"""Insert-only writes: rows whose key is already present are left as they are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.operators.dedup import keep_one


# A source of at most this many rows sends its keys to the target instead of meeting it in a shuffle.
BROADCAST_ROWS = 500_000


def new_rows(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """One row per source key that the target does not hold yet.

    For the usual small increment the target is only scanned for the source's keys, a counted set
    that fits a broadcast. A large source is joined to the target's keys by a shuffle.
    """
    present = target.select(*keys)
    if source.count() <= broadcast_rows:
        present = present.join(F.broadcast(source.select(*keys)), list(keys), "left_semi")
    fresh = source.join(present, list(keys), "left_anti")
    return keep_one(fresh.select(*source.columns), keys)


def insert_only(source: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Append the new rows to the parquet table at ``path``, creating it if it is missing.

    Pass an increment, not the whole source: a small one is looked up by a scan for its keys. Two
    runs at a time could both find a key missing, so a table has one writer.
    """
    spark = source.sparkSession
    target = existing(spark, path, source)
    new_rows(source, target, keys).write.mode("append").parquet(path)


def insert_only_jdbc(
    source: DataFrame, url: str, table: str, keys: Sequence[str], properties: dict[str, str]
) -> None:
    """The same against a database table; needs the driver jar on the class path."""
    target = source.sparkSession.read.jdbc(url, table, properties=properties)
    rows = new_rows(source, target, keys)
    rows.write.option("batchsize", 10_000).jdbc(url, table, mode="append", properties=properties)


def existing(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The table at ``path``, or an empty one with the columns of ``like``."""
    try:
        return spark.read.schema(like.schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], like.schema)
