"""One row per key, always the same row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """The first row of each key under ``order``; ties fall to the remaining columns.

    Spark turns ``row_number() = 1`` into a group limit that runs before the shuffle as well, so
    each map task sends one row per key: a key that holds a third of the table arrives as a handful
    of rows. Since every column takes part in the order, equal candidates are equal rows.
    """
    rest = [F.col(name).asc_nulls_first() for name in df.columns if name not in keys]
    window = Window.partitionBy(*keys).orderBy(*order, *rest)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")
