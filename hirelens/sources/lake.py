"""Bronze and Silver readers and the catalog."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens import schemas
from hirelens.sources import postings_csv


def read_bronze(
    spark: SparkSession, path: str, first_day: str | None = None, last_day: str | None = None
) -> DataFrame:
    """The Bronze table, optionally between two ingest days given as ``yyyy-MM-dd``.

    The partition columns keep their declared text type (``01`` stays ``01``). A day range becomes
    a condition on partition columns alone, so other days are not listed for reading.
    """
    bronze = spark.read.schema(schemas.BRONZE).parquet(path)
    day = F.concat_ws("-", "ingest_year", "ingest_month", "ingest_day")
    if first_day is not None:
        bronze = bronze.filter((F.col("ingest_year") >= first_day[:4]) & (day >= first_day))
    if last_day is not None:
        bronze = bronze.filter((F.col("ingest_year") <= last_day[:4]) & (day <= last_day))
    return bronze


def read_bronze_or_csv(spark: SparkSession, bronze_path: str, csv_path: str) -> DataFrame:
    """Bronze unless it is unreadable or empty; ``isEmpty`` stops at the first row."""
    try:
        bronze = read_bronze(spark, bronze_path)
        if not bronze.isEmpty():
            return bronze
    except AnalysisException:
        pass
    return postings_csv.bronze_stand_in(spark, csv_path)


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.SILVER).parquet(path)


def overwrite(df: DataFrame, path: str) -> DataFrame:
    """Write a table and return it as read back, so that later steps start from the files."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def register_views(tables: dict[str, DataFrame]) -> None:
    for name, table in tables.items():
        table.createOrReplaceTempView(name)


def register_external(
    spark: SparkSession, database: str, root: str, homes: dict[str, str] | None = None
) -> list[str]:
    """Declare every Gold table, and the prediction table, over the files below ``root``.

    ``homes`` gives the folders of tables that lie elsewhere, as those of a published version do.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}/_database'")
    layouts = {**schemas.GOLD, "prediction_results": schemas.PREDICTION}
    for name, layout in layouts.items():
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in layout.fields)
        home = (homes or {}).get(name, f"{root}/{name}")
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        spark.sql(f"CREATE TABLE {database}.{name} ({columns}) USING parquet LOCATION '{home}'")
    return list(layouts)
