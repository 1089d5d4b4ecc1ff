"""Largest groups and newest rows, with ties resolved by a unique column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def top(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """Sort and limit; Spark keeps k rows per task and merges those."""
    return df.orderBy(*order).limit(k)
