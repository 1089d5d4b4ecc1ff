"""Dense surrogate keys without gathering the table in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens.session import fresh_folder

# monotonically_increasing_id() puts the partition in the bits above the row number.
_ROW_BITS = 33


def ranked(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """Number rows in one task. Only for tables whose size has a fixed bound."""
    return df.withColumn(key, F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def staged_in_order(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The rows as written in range partitions, with their partition and position in it.

    Rows are partitioned by the whole order, so a value that holds a third of the table is split by
    the columns after it, and sorted within their partitions. They are written down because range
    bounds come from a sample: a second evaluation need not repeat the first.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, "keys")
    (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
        .write.parquet(path)
    )
    layout = T.StructType([*df.schema.fields, T.StructField("_at", T.LongType())])
    staged = spark.read.schema(layout).parquet(path)
    position = F.col("_at").bitwiseAND((1 << _ROW_BITS) - 1)
    return staged.withColumn("_part", F.shiftright("_at", _ROW_BITS)).withColumn("_at", position)


def dense_key(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """``row_number() over (order by ...)`` for a table of any size.

    The row counts of the partitions, one row per task, give the offset to add to the position
    inside a partition. ``order`` must be unique per row.
    """
    staged = staged_in_order(df, order)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        staged.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    return (
        staged.join(F.broadcast(offsets), "_part")
        .withColumn(key, F.col("_before") + F.col("_at") + 1)
        .drop("_part", "_at", "_before")
    )
