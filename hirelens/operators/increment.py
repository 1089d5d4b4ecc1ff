"""Aggregates that are kept up by what changed: signed rows, mergeable states, append-only keys.

A change is a row with a sign: -1 for a version that no longer holds, 1 for one that does. All sums
are integers or decimals, so a state that took back a row equals one that never saw it. Extremes cannot
be taken back; a group that loses its own is looked up in the rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.functions.aggregates import CENTS
from hirelens.operators.keys import dense_key

SIGN = "_sign"
#: Rows of a group; a group without rows leaves the state.
ROWS = "_n"
MONEY = "decimal(28,2)"


def buckets_of(columns: Sequence[str], count: int) -> Column:
    """The bucket of a key, the same in every build."""
    return F.pmod(F.xxhash64(*columns), F.lit(count))


def counted(condition: Column | None = None) -> Column:
    sign = F.col(SIGN).cast("bigint")
    return F.coalesce(F.sum(sign if condition is None else F.when(condition, sign)), F.lit(0)).cast("bigint")


def summed(amount: str) -> Column:
    """Exact sum of an amount with two decimals; zero without any."""
    return F.coalesce(F.sum(F.col(SIGN) * F.col(amount).cast(CENTS)), F.lit(0)).cast(MONEY)


def summed_int(number: str) -> Column:
    return F.coalesce(F.sum(F.col(SIGN) * F.col(number).cast("bigint")), F.lit(0)).cast("bigint")


@dataclass(frozen=True)
class End:
    """The lowest or highest value of a group; rows without a value do not count."""

    value: Column
    highest: bool = False

    def of(self, column: Column) -> Column:
        return (F.max if self.highest else F.min)(column)

    def best(self, *columns: Column) -> Column:
        return (F.greatest if self.highest else F.least)(*columns)

    def reaches(self, one: Column, other: Column) -> Column:
        """Whether a value is at least as far out; false if either is missing."""
        return F.coalesce(one >= other if self.highest else one <= other, F.lit(False))


#: Marks a group whose extreme was taken back.
OPEN = "_open"


def lost(end: str) -> str:
    """The column of a delta with the extreme of what was taken back."""
    return f"_lost_{end}"


def delta(
    changes: DataFrame, keys: Sequence[str], sums: Mapping[str, Column], ends: Mapping[str, End] | None = None
) -> DataFrame:
    """What the signed rows add to the state of each group; groups that come out even are left out.

    An extreme comes in two columns, of the rows that are added and of those that are taken back. If
    both are the same and no sum moves, the group's extreme is what it was.
    """
    ends, added = ends or {}, F.col(SIGN) > 0
    totals = changes.groupBy(*keys).agg(
        counted().alias(ROWS), *(c.alias(n) for n, c in sums.items()),
        *(end.of(F.when(added, end.value)).alias(n) for n, end in ends.items()),
        *(end.of(F.when(~added, end.value)).alias(lost(n)) for n, end in ends.items()),
    )
    moved = F.lit(False)
    for name in (ROWS, *sums):
        moved = moved | (F.col(name) != 0)
    for name in ends:
        moved = moved | ~F.col(name).eqNullSafe(F.col(lost(name)))
    return totals.filter(moved)


def merged(
    state: DataFrame, more: DataFrame, keys: Sequence[str], ends: Mapping[str, End] | None = None
) -> DataFrame:
    """The state after the delta. Without ends only sums are kept, so deltas may be merged in any order.

    With ends, ``OPEN`` marks the groups whose extreme was taken back and not outdone by a new row:
    their extremes are not known from the state, see ``settled``.
    """
    ends = ends or {}
    sums = [name for name in more.columns if name not in keys and name not in ends and name not in map(lost, ends)]
    kinds = dict(more.dtypes)
    was = state.withColumnsRenamed({name: f"_was_{name}" for name in ends})
    both = was.unionByName(more, allowMissingColumns=bool(ends))
    totals = both.groupBy(*keys).agg(
        *(F.sum(name).cast(kinds[name]).alias(name) for name in sums),
        *(end.of(F.col(f"{kind}{name}")).alias(f"{kind}{name}") for name, end in ends.items() for kind in ("", "_was_", "_lost_")),
    ).filter(F.col(ROWS) > 0)
    if not ends:
        return totals
    unsure = F.lit(False)
    for name, end in ends.items():
        now, old, gone = F.col(name), F.col(f"_was_{name}"), F.col(lost(name))
        unsure = unsure | (end.reaches(gone, old) & ~end.reaches(now, old))
    best = (end.best(F.col(name), F.col(f"_was_{name}")).alias(name) for name, end in ends.items())
    return totals.select(*keys, *sums, *best, unsure.alias(OPEN))


def settled(state: DataFrame, rows: DataFrame, keys: Sequence[str], ends: Mapping[str, End]) -> DataFrame:
    """A merged state with the extremes of its open groups taken from all rows there are now."""
    unsure = state.filter(OPEN).select(*(F.col(c).alias(f"_of_{c}") for c in keys))
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in keys]
    found = rows.join(unsure, same, "left_semi").groupBy(*keys).agg(*(end.of(end.value).alias(f"_new_{n}") for n, end in ends.items()))
    found = found.withColumnsRenamed({c: f"_of_{c}" for c in keys})
    joined = state.join(found, same, "left")
    best = {n: F.when(F.col(OPEN), F.col(f"_new_{n}")).otherwise(F.col(n)) for n in ends}
    return joined.withColumns(best).select(*state.columns)


def signed(old: DataFrame, new: DataFrame) -> DataFrame:
    """The old rows taken back and the new ones added."""
    return old.withColumn(SIGN, F.lit(-1)).unionByName(new.withColumn(SIGN, F.lit(1)))


def new_keys(names: DataFrame, known: DataFrame, key: str, last: int) -> DataFrame:
    """Keys for the names that ``known`` does not hold, numbered in their order behind ``last``.

    Names that have a key keep it for good. All columns of ``names`` make a name; the anti join
    treats nulls as equal.
    """
    columns = names.columns
    same = [names[c].eqNullSafe(known[c]) for c in columns]
    fresh = names.distinct().join(known, same, "left_anti")
    numbered = dense_key(fresh, key, [F.col(c).asc_nulls_first() for c in columns])
    return numbered.withColumn(key, F.col(key) + last).select(key, *columns)


#: Whether an id that arrives is one of those there are.
KNOWN = "_known"


def not_alone(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """The keys of ``rows`` that come more than once or are in ``known``, and which of the two: one pass over keys."""
    here = rows.select(key, F.lit(1).cast("bigint").alias("_times"), F.lit(False).alias(KNOWN))
    there = known.select(key, F.lit(0).cast("bigint").alias("_times"), F.lit(True).alias(KNOWN))
    met = here.unionByName(there).groupBy(key).agg(F.sum("_times").alias("_times"), F.max(KNOWN).alias(KNOWN))
    return met.filter((F.col("_times") > 1) | ((F.col("_times") > 0) & F.col(KNOWN))).select(key, KNOWN)


def touched(rows: DataFrame, part: Column) -> list[str]:
    """The parts that rows lie in; at most as many as the table has."""
    return sorted(str(r[0]) for r in rows.select(part).distinct().collect())


def differing(old: DataFrame, new: DataFrame, key: str, columns: Iterable[str]) -> DataFrame:
    """Rows of ``new`` that ``old`` lacks or holds with other values."""
    same = [old[key] == new[key], *(old[c].eqNullSafe(new[c]) for c in columns)]
    return new.join(old, same, "left_anti")
