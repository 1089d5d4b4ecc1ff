"""Salary estimate from fixed factors, for profiles without a model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.functions.text import size_or_zero

# Base pay, factors, skill bonus and confidence.
BASE_PAY = {
    "Data Science & AI": 154000,
    "Data Engineering": 148500,
    "DevOps & Cloud": 142800,
    "Software Engineering": 139400,
    "Product Management": 136200,
    "Cybersecurity": 132100,
    "Data Analytics & BI": 118000,
    "Frontend & Web": 121500,
    "Other Tech Roles": 110000,
}
LEVEL_FACTOR = {
    "Entry / Junior": "0.72",
    "Mid-Level": "1.00",
    "Senior": "1.28",
    "Lead / Principal": "1.55",
}
CITY_FACTOR = {
    "San Francisco": "1.25",
    "New York": "1.18",
    "Seattle": "1.15",
    "Austin": "1.02",
    "Boston": "1.08",
    "Chicago": "0.98",
    "London": "0.92",
    "Berlin": "0.88",
    "Toronto": "0.90",
    "Remote": "1.05",
}
UNKNOWN_ROLE_PAY = 130000
REMOTE_FACTOR = "1.04"
PER_SKILL = 3500
CONFIDENCE_START, CONFIDENCE_PER_SKILL, CONFIDENCE_LIMIT = "86.0", "1.8", "96.5"


def _factor(value: int | str, kind: str) -> Column:
    return F.lit(str(value)).cast(kind)


def _choose(column: Column, table: dict, default: int | str, kind: str) -> Column:
    chain = _factor(default, kind)
    for name, value in table.items():
        chain = F.when(column == name, _factor(value, kind)).otherwise(chain)
    return chain


def _pay_without_level(profile: dict[str, Column]) -> Column:
    base = _choose(profile["role"], BASE_PAY, UNKNOWN_ROLE_PAY, "decimal(6,0)")
    city = _choose(profile["city"], CITY_FACTOR, "1.00", "decimal(3,2)")
    remote = F.when(profile["remote"], _factor(REMOTE_FACTOR, "decimal(3,2)")).otherwise(
        _factor("1.00", "decimal(3,2)")
    )
    return base * city * remote


def _profile(df: DataFrame) -> dict[str, Column]:
    return {
        "role": F.col("role_category"),
        "level": F.col("experience_level"),
        "city": F.col("city"),
        "remote": F.coalesce("is_remote", F.lit(False)),
        "skills": size_or_zero("skills"),
    }


def estimate(profiles: DataFrame) -> DataFrame:
    """Add the estimate and its confidence. Needs role, level, city, remote flag and skills."""
    p = _profile(profiles)
    level = _choose(p["level"], LEVEL_FACTOR, "1.00", "decimal(3,2)")
    bonus = (p["skills"] * PER_SKILL).cast("decimal(12,0)")
    confidence = F.least(
        _factor(CONFIDENCE_START, "decimal(10,1)")
        + p["skills"].cast("decimal(8,0)") * _factor(CONFIDENCE_PER_SKILL, "decimal(2,1)"),
        _factor(CONFIDENCE_LIMIT, "decimal(10,1)"),
    )
    pay = F.round(_pay_without_level(p) * level + bonus, 2).cast("double")
    return profiles.withColumns(
        {"estimated_salary": pay, "confidence": confidence.cast("double")}
    )


def seniority_curve(profiles: DataFrame, key: str) -> DataFrame:
    """Each profile at the four levels, rounded to whole dollars."""
    p = _profile(profiles)
    bonus = (p["skills"] * PER_SKILL).cast("decimal(12,0)")
    parts = profiles.select(key, _pay_without_level(p).alias("_base"), bonus.alias("_bonus"))

    def point(level: str, factor: str) -> Column:
        pay = F.col("_base") * _factor(factor, "decimal(3,2)") + F.col("_bonus")
        return F.struct(
            F.lit(level).alias("experience_level"),
            F.round(pay, 0).cast("double").alias("estimated_salary"),
        )

    points = F.array(*[point(level, factor) for level, factor in LEVEL_FACTOR.items()])
    return parts.select(key, F.inline(points))
