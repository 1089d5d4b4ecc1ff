"""The flat serving table behind the dashboards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What an empty field shows on a dashboard.
SHOWN_WHEN_EMPTY = {
    "company_name": "Unknown Company",
    "title": "Tech Role",
    "role_category": "Software Engineering",
    "experience_level": "Mid-Level",
    "city": "San Francisco",
    "country": "United States",
    "employment_type": "full_time",
    "primary_skill": "Python",
}


def _shown(source: Column, name: str) -> Column:
    fallback = F.lit(SHOWN_WHEN_EMPTY[name])
    return F.coalesce(F.nullif(source, F.lit("")), fallback).alias(name)


def project(silver: DataFrame) -> DataFrame:
    """One mart row per Silver row; a projection, so it runs inside the scan's tasks."""
    return silver.select(
        F.coalesce("job_id", F.lit("")).alias("job_id"),
        _shown(F.col("company_name"), "company_name"),
        _shown(F.col("title"), "title"),
        _shown(F.col("role_category"), "role_category"),
        _shown(F.col("experience_level"), "experience_level"),
        _shown(F.col("city_normalized"), "city"),
        _shown(F.col("country_normalized"), "country"),
        F.coalesce("is_remote", F.lit(False)).alias("is_remote"),
        _shown(F.col("employment_type"), "employment_type"),
        "annual_salary_usd",
        F.coalesce(F.nullif("skills_count", F.lit(0)), F.lit(1)).alias("skills_count"),
        F.coalesce(F.array_join("skills", ", "), F.lit("")).alias("skills_list"),
        _shown(F.get("skills", 0), "primary_skill"),
        "posted_date",
        F.current_timestamp().alias("created_at"),
    )
