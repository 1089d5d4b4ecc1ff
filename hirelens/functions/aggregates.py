"""Rounded aggregates whose results do not depend on the order of the input.

Sums of doubles change with the order of partial results, so a retried task could move a rounded
average by a cent. Money is therefore summed as DECIMAL and counts as integers; both are exact and
merge in any order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CENTS = "decimal(18,2)"


def total(amount: str | Column) -> Column:
    """Exact sum of an amount with two decimals."""
    column = F.col(amount) if isinstance(amount, str) else amount
    return F.sum(column.cast(CENTS))


def total_int(number: str | Column) -> Column:
    column = F.col(number) if isinstance(number, str) else number
    return F.sum(column.cast("bigint")).cast("decimal(20,0)")


def ratio(numerator: Column, count: Column, digits: int) -> Column:
    """numerator / count, rounded half up; null for a count of zero."""
    return F.round(F.try_divide(numerator, count), digits).cast("double")


def mean(amount: str | Column, digits: int = 2) -> Column:
    return ratio(total(amount), F.count(amount), digits)


def mean_int(number: str | Column, digits: int) -> Column:
    return ratio(total_int(number), F.count(number), digits)


def lowest(amount: str | Column) -> Column:
    return F.round(F.min(amount), 2)


def highest(amount: str | Column) -> Column:
    return F.round(F.max(amount), 2)


def percent(hits: Column, count: Column, digits: int = 2) -> Column:
    """100 * hits / count from two integer columns, rounded half up; null for no rows."""
    return ratio(hits.cast("decimal(20,0)") * 100, count, digits)


def percent_if(condition: Column, digits: int = 2) -> Column:
    """Share of the rows of a group that satisfy the condition."""
    return percent(F.count_if(condition), F.count("*"), digits)


def spread(amount: str) -> Column:
    return F.round(F.max(amount) - F.min(amount), 2)


def deviation(amount: str, kind: str = "population") -> Column:
    """Population deviation by default: zero for one row, where the sample form gives null."""
    stddev = {"population": F.stddev_pop, "sample": F.stddev_samp}[kind]
    return F.round(stddev(amount), 2)
