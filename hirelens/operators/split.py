"""Training split that depends on the row key alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _bucket_below(key: str, share: float) -> Column:
    # The first four hex digits of a hash are a number below 65536, written so that text order is
    # number order. The same rows fall on the same side in any partitioning and any engine.
    bound = round(share * 65536)
    if not 0 < bound < 65536:
        raise ValueError(f"share must lie between 0 and 1, not {share}")
    return F.substring(F.md5(F.col(key)), 1, 4) < f"{bound:04x}"


def hash_split(df: DataFrame, key: str, share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    inside = F.coalesce(_bucket_below(key, share), F.lit(True))
    return df.filter(inside), df.filter(~inside)
