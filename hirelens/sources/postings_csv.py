"""Postings from CSV files: explicit schema, then one column expression per field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens import schemas
from hirelens.functions.text import blank_to_null, trimmed

# How the files spell "no number" and "true", and the default contract type.
NO_NUMBER = ("", "null", "none", "nan")
TRUE_WORDS = ("true", "1", "t", "yes")
DEFAULT_EMPLOYMENT = "full_time"
SKILL_SEPARATOR = r"\|"


#: How batch and stream read the files. Quoted fields may hold line breaks, so a file is read by one
#: task; large exports are best landed as several files.
OPTIONS = {"header": True, "multiLine": True, "escape": '"'}


def read_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """All fields as text, without a pass over the files to infer types.

    Files known to hold no line break inside quotes can be split among tasks with
    ``multi_line=False``; a quoted line break is then read as the end of its row.
    """
    return spark.read.schema(schemas.CSV).options(**OPTIONS | {"multiLine": multi_line}).csv(path)


def number(column: str) -> Column:
    return F.when(~F.lower(trimmed(column)).isin(*NO_NUMBER), trimmed(column).try_cast("double"))


def flag(column: str) -> Column:
    return F.coalesce(F.lower(trimmed(column)).isin(*TRUE_WORDS), F.lit(False))


def skill_list(column: str) -> Column:
    parts = F.transform(F.split(column, SKILL_SEPARATOR), lambda part: F.trim(part))
    return F.coalesce(F.filter(parts, lambda part: part != ""), F.array().cast("array<string>"))


def normalize(raw: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Typed event columns from text columns. Blank text is null, so later defaults apply."""
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    special = {
        "is_remote": flag("is_remote"),
        "salary_from_text": flag("salary_from_text"),
        "salary_min": number("salary_min"),
        "salary_max": number("salary_max"),
        "skills": skill_list("skills"),
        "employment_type": F.coalesce(
            blank_to_null("employment_type"), F.lit(DEFAULT_EMPLOYMENT)
        ),
    }
    fields = [
        special.get(name, blank_to_null(name)).alias(name) for name in schemas.RAW_FIELDS
    ]
    iso = F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return raw.select(*fields, iso.alias("ingestion_timestamp"))


def bronze_stand_in(spark: SparkSession, path: str) -> DataFrame:
    """CSV files in the place of a Bronze table that is missing or empty.

    The scrape time stands in for the ingestion time, as nothing was ingested.
    """
    typed = normalize(read_csv(spark, path))
    return typed.withColumn("ingestion_timestamp", F.col("scraped_at"))
