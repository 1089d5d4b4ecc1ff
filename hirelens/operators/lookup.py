"""Left join to a dimension that may or may not be small, under keys that may be hot."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A dimension of at most this many rows is sent to every executor.
BROADCAST_ROWS = 500_000
# A key is hot when it holds more than one row in HOT_SHARE of the dimension's total weight, so
# there are fewer than HOT_SHARE hot keys whatever the data looks like.
HOT_SHARE = 2_000
# Number of tasks over which the rows of the hot keys are spread in the shuffled join.
SPREAD = 4_096


def attach(
    rows: DataFrame,
    dimension: DataFrame,
    on: Sequence[str],
    weight: str,
    spread_by: str,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_share: int = HOT_SHARE,
) -> DataFrame:
    """``rows`` with the other columns of ``dimension``, left join on ``on``.

    ``dimension`` has unique, non-null keys and a ``weight`` column that says how many rows refer
    to each key; the weight is not part of the result. A counted small dimension is broadcast.
    Beyond that only the hot keys, whose number is bounded by ``hot_share``, are broadcast; their
    rows enter the shuffled join under a null key and a salt from ``spread_by``, which spreads them
    evenly, while all other rows meet their key in the shuffle.
    """
    names = [name for name in dimension.columns if name not in (*on, weight)]
    if dimension.count() <= broadcast_rows:
        return rows.join(F.broadcast(dimension.drop(weight)), list(on), "left")

    total = dimension.agg(F.sum(weight)).first()[0]
    hot = dimension.filter(F.col(weight) > total / hot_share).select(
        *on, *[F.col(name).alias(f"_hot_{name}") for name in names], F.lit(True).alias("_hot")
    )
    marked = rows.join(F.broadcast(hot), list(on), "left")
    cold = reduce(and_, [F.col(name).isNotNull() for name in on], F.col("_hot").isNull())
    marked = marked.withColumns(
        {
            "_salt": F.when(cold, 0).otherwise(F.pmod(F.xxhash64(spread_by), F.lit(SPREAD)) + 1),
            **{f"_cold_{name}": F.when(cold, F.col(name)) for name in on},
        }
    )
    wide = dimension.select(
        *[F.col(name).alias(f"_cold_{name}") for name in on],
        F.lit(0).cast("bigint").alias("_salt"),
        *[F.col(name).alias(f"_dim_{name}") for name in names],
    )
    joined = marked.join(wide, [*[f"_cold_{name}" for name in on], "_salt"], "left")
    return joined.select(
        *rows.columns,
        *[F.coalesce(f"_hot_{name}", f"_dim_{name}").alias(name) for name in names],
    )
