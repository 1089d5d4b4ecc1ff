"""Compare a Spark result with a DuckDB result as bags of rows."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, (list, tuple)):
        return tuple(plain(item) for item in value)
    return value


def bag(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    counted = Counter(tuple(plain(row[i]) for i in order) for row in rows)
    return [columns[i] for i in order], counted


def spark_bag(df: DataFrame):
    return bag(df.columns, df.collect())


def duck_bag(connection, sql: str):
    result = connection.execute(sql)
    return bag([column[0] for column in result.description], result.fetchall())


def difference(spark_result, duck_result) -> str | None:
    """None when equal, else a short description."""
    if spark_result[0] != duck_result[0]:
        return f"columns {spark_result[0]} != {duck_result[0]}"
    extra = spark_result[1] - duck_result[1]
    missing = duck_result[1] - spark_result[1]
    if not extra and not missing:
        return None
    return (
        f"{sum(spark_result[1].values())} rows against {sum(duck_result[1].values())}; "
        f"{sum(extra.values())} extra, e.g. {list(extra)[:2]}; "
        f"{sum(missing.values())} missing, e.g. {list(missing)[:2]}"
    )
