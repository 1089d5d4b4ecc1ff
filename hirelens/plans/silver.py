"""Silver: one cleaned row per posting."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.functions import dates, location, rules, salary, text
from hirelens.operators.dedup import keep_one

# What a missing field becomes.
DEFAULTS = {
    "company_name": "Confidential / Unknown",
    "company_industry": "Technology",
    "country": "Global",
    "employment_type": "full_time",
    "salary_currency": "USD",
    "salary_period": "year",
}

# The fields of a posting.
USED_FIELDS = [
    "job_id", "company_name", "company_domain", "company_industry", "ats", "title",
    "department", "location_raw", "country", "city", "is_remote", "employment_type",
    "salary_min", "salary_max", "salary_currency", "salary_period", "skills", "posted_at",
    "url", "ingestion_timestamp",
]


@dataclass(frozen=True)
class Rules:
    roles: rules.RuleSet = rules.ROLES
    levels: rules.RuleSet = rules.LEVELS


def _or_default(column: Column, field: str) -> Column:
    return F.coalesce(column, F.lit(DEFAULTS[field]))


def identified(raw: DataFrame) -> DataFrame:
    """Rows with a usable id, the id trimmed, and no columns beyond those Silver reads."""
    kept = raw.filter(text.not_blank("job_id")).select(*USED_FIELDS)
    return kept.withColumn("job_id", text.trimmed("job_id"))


def deduplicated(rows: DataFrame) -> DataFrame:
    """The most recently ingested version of each posting."""
    newest = dates.parsed_time("ingestion_timestamp").desc_nulls_last()
    return keep_one(rows, ["job_id"], [newest])


def cleaned(rows: DataFrame) -> DataFrame:
    """The Silver columns that come straight from one field each, and two helpers.

    The helpers, lower-cased title and pay period, are never null. Tests on a column that may be
    null generate about twice the code, and a generated method of more than 8000 bytes is not
    compiled by the JVM but interpreted, at a fraction of the speed.
    """
    remote = F.col("is_remote").try_cast("boolean")
    posted_raw = F.coalesce("posted_at", "ingestion_timestamp").cast("string")
    return rows.select(
        "job_id",
        text.trimmed(_or_default(F.col("company_name"), "company_name")).alias("company_name"),
        text.trimmed("company_domain").alias("company_domain"),
        text.trimmed(_or_default(F.col("company_industry"), "company_industry")).alias(
            "company_industry"
        ),
        text.trimmed("ats").alias("ats"),
        text.trimmed("title").alias("title"),
        F.coalesce(F.lower("title"), F.lit("")).alias("_lower_title"),
        text.trimmed("department").alias("department"),
        location.city_or_remote(remote, "location_raw", "city", "country").alias(
            "city_normalized"
        ),
        _or_default(F.initcap(text.trimmed("country")), "country").alias("country_normalized"),
        F.coalesce(remote, F.lit(False)).alias("is_remote"),
        _or_default(F.lower(text.trimmed("employment_type")), "employment_type").alias(
            "employment_type"
        ),
        F.col("salary_min").try_cast("double").alias("salary_min"),
        F.col("salary_max").try_cast("double").alias("salary_max"),
        _or_default(F.upper(text.trimmed("salary_currency")), "salary_currency").alias(
            "salary_currency"
        ),
        _or_default(F.lower(text.trimmed("salary_period")), "salary_period").alias(
            "salary_period"
        ),
        F.coalesce(F.lower("salary_period"), F.lit("")).alias("_unit"),
        "skills",
        text.size_or_zero("skills").alias("skills_count"),
        dates.parsed_date(posted_raw).alias("posted_date"),
        posted_raw.alias("posted_at_raw"),
        "url",
    )


def derived(rows: DataFrame, using: Rules) -> DataFrame:
    """Add role, level and annual pay, and put the columns in their final order."""
    lower_title = F.col("_lower_title")
    pay = salary.annualized("salary_min", "salary_max", F.col("_unit"))
    return (
        rows.withColumns(
            {
                "role_category": rules.role_category(lower_title, using.roles),
                "experience_level": rules.experience_level(lower_title, using.levels),
                "_pay": pay,
            }
        )
        .withColumn("annual_salary_usd", salary.within_band(F.col("_pay")))
        .select(
            *"job_id company_name company_domain company_industry ats title".split(),
            *"role_category experience_level department".split(),
            *"city_normalized country_normalized is_remote employment_type".split(),
            *"salary_min salary_max salary_currency salary_period annual_salary_usd".split(),
            *"skills skills_count posted_date posted_at_raw url".split(),
        )
    )


def build(raw: DataFrame, using: Rules = Rules()) -> DataFrame:
    """Bronze (or typed CSV) rows to Silver.

    Duplicates go first, while rows are still raw: everything after the one shuffle is a projection
    over surviving rows.
    """
    return derived(cleaned(deduplicated(identified(raw))), using)


def refreshed(
    silver: DataFrame, raw: DataFrame, arrived: DataFrame, using: Rules = Rules()
) -> DataFrame:
    """Silver after some raw rows arrived: their postings are built anew, all others stay.

    ``raw`` is everything ingested so far. Of it only the rows of the arrived ids are compared, so
    an older version that arrives late does not replace a newer one, and the result equals a build
    from all rows.
    """
    ids = identified(arrived).select("job_id").distinct()
    versions = identified(raw).join(ids, "job_id", "left_semi")
    renewed = derived(cleaned(deduplicated(versions)), using)
    return silver.join(ids, "job_id", "left_anti").unionByName(renewed)
