"""Dates and times that arrive as text. Text that does not parse gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the key of facts without a date. No row of the date dimension carries it.
NO_DATE_KEY = 19700101


def parsed_time(column: str) -> Column:
    return F.col(column).try_cast("timestamp")


def parsed_date(column: Column) -> Column:
    return column.try_cast("date")


def date_key(day: Column) -> Column:
    """yyyymmdd as a number."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")
