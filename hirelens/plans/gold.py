"""Gold: star schema and aggregates over Silver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.functions import aggregates as A
from hirelens.functions import dates, text
from hirelens.operators.keys import dense_key, ranked
from hirelens.operators.lookup import attach

# How many Silver rows (or skill mentions) refer to a dimension row; kept in the staged dimension
# so that joins know their hot keys, and left out of the published table.
WEIGHT = "_refs"


def skill_mentions(silver: DataFrame, *columns: str) -> DataFrame:
    """One row per countable skill of a posting; repeats within a posting stay."""
    return silver.select(*columns, F.explode(text.skill_tags("skills")).alias("skill_name"))


# --- dimensions -------------------------------------------------------------------------------


def company_rows(silver: DataFrame) -> DataFrame:
    """Domain and industry come from the posting with the lowest id, the same on every run."""
    return silver.groupBy("company_name").agg(
        F.min_by("company_domain", "job_id").alias("company_domain"),
        F.min_by("company_industry", "job_id").alias("company_industry"),
        F.count("*").alias("total_jobs_posted"),
    )


def dim_company(silver: DataFrame) -> DataFrame:
    keyed = dense_key(company_rows(silver), "company_key", [F.col("company_name")])
    return keyed.withColumn(WEIGHT, F.col("total_jobs_posted"))


def dim_job_role(silver: DataFrame) -> DataFrame:
    """At most one row per pair of labels, so one task may number them."""
    pairs = silver.select("role_category", "experience_level").distinct()
    return ranked(pairs, "role_key", [F.col("role_category"), F.col("experience_level")])


def dim_location(silver: DataFrame) -> DataFrame:
    places = silver.groupBy(
        F.col("city_normalized").alias("city"),
        F.col("country_normalized").alias("country"),
        "is_remote",
    ).agg(F.count("*").alias(WEIGHT))
    order = [F.col(name) for name in ("city", "country", "is_remote")]
    return dense_key(places, "location_key", order)


def dim_date(silver: DataFrame) -> DataFrame:
    days = silver.select(F.col("posted_date").alias("full_date")).filter("full_date IS NOT NULL")
    day = F.col("full_date")
    return days.distinct().select(
        dates.date_key(day).alias("date_key"),
        "full_date",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.quarter(day).alias("quarter"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "MMMM").alias("month_name"),
    )


def dim_skill(silver: DataFrame) -> DataFrame:
    tags = skill_mentions(silver).groupBy("skill_name").agg(F.count("*").alias(WEIGHT))
    return dense_key(tags, "skill_key", [F.col("skill_name")])


# --- fact and bridge --------------------------------------------------------------------------


#: What the fact takes from Silver as it is.
FACT_COLUMNS = [
    "title", "annual_salary_usd", "salary_min", "salary_max", "salary_currency",
    "employment_type", "is_remote", "skills_count", "url",
]
NAMES = [
    "role_category", "experience_level", "company_name", "city_normalized", "country_normalized",
    "is_remote",
]


def foreign_keys(
    silver: DataFrame, companies: DataFrame, roles: DataFrame, locations: DataFrame
) -> DataFrame:
    """The keys of each posting. ``companies`` and ``locations`` carry the weight column.

    Only names and the id go through the lookups, which may shuffle by name and salt. The date key
    needs no join: the date dimension holds exactly the non-null dates of Silver.
    """
    names = silver.select("job_id", "posted_date", *NAMES)
    keyed = names.join(F.broadcast(roles), ["role_category", "experience_level"], "left")
    keyed = attach(
        keyed, companies.select("company_name", "company_key", WEIGHT),
        ["company_name"], WEIGHT, spread_by="job_id",
    )
    places = locations.withColumnsRenamed(
        {"city": "city_normalized", "country": "country_normalized"}
    )
    keyed = attach(
        keyed, places, ["city_normalized", "country_normalized", "is_remote"], WEIGHT,
        spread_by="job_id",
    )
    day = F.coalesce(dates.date_key(F.col("posted_date")), F.lit(dates.NO_DATE_KEY))
    return keyed.select("job_id", "company_key", "role_key", "location_key", day.alias("date_key"))


def fact_keys(silver: DataFrame) -> DataFrame:
    """Dense fact key per posting, by date and id. A busy date, or none at all, is split by id.

    Only these two columns go through the range sort; the wide rows meet their key afterwards, in
    the hash partitions in which they are written.
    """
    order = [F.col("posted_date").asc_nulls_first(), F.col("job_id")]
    return dense_key(silver.select("posted_date", "job_id"), "fact_key", order).drop("posted_date")


def fact(silver: DataFrame, foreign: DataFrame, own: DataFrame, partitions: int) -> DataFrame:
    """The wide rows cross one shuffle, into the partitions of the stored table, and meet their
    foreign keys and their own key there.
    """
    rows = silver.select("job_id", *FACT_COLUMNS).repartition(partitions, "job_id")
    for keys in (foreign, own):
        rows = rows.join(keys.repartition(partitions, "job_id"), "job_id")
    return rows.select("fact_key", *foreign.columns, *FACT_COLUMNS)


def bridge(silver: DataFrame, skills: DataFrame) -> DataFrame:
    """Posting-skill pairs. Every tag of Silver is in ``skills``, so no pair is lost."""
    mentions = skill_mentions(silver, "job_id")
    keyed = attach(mentions, skills, ["skill_name"], WEIGHT, spread_by="job_id")
    return keyed.filter("skill_key IS NOT NULL").select("job_id", "skill_key")


# --- aggregates -------------------------------------------------------------------------------


def top_skills(silver: DataFrame) -> DataFrame:
    mentions = skill_mentions(silver, "job_id", "annual_salary_usd", "is_remote")
    return mentions.groupBy("skill_name").agg(
        F.count("*").alias("posting_count"),
        A.mean("annual_salary_usd").alias("avg_salary_usd"),
        A.percent_if(F.col("is_remote")).alias("remote_percentage"),
    )


def salary_by_role_city(silver: DataFrame) -> DataFrame:
    paid = silver.filter("annual_salary_usd IS NOT NULL")
    city = F.col("city_normalized").alias("city")
    return paid.groupBy("role_category", city, "experience_level").agg(
        F.count("*").alias("total_postings"),
        A.mean("annual_salary_usd").alias("avg_annual_salary"),
        A.lowest("annual_salary_usd").alias("min_annual_salary"),
        A.highest("annual_salary_usd").alias("max_annual_salary"),
    )


def remote_trends(silver: DataFrame) -> DataFrame:
    return silver.groupBy("role_category", "is_remote").agg(
        F.count("*").alias("total_jobs"),
        A.mean("annual_salary_usd").alias("avg_salary"),
        A.mean_int("skills_count", 2).alias("avg_skills_required"),
    )


def company_hiring(silver: DataFrame) -> DataFrame:
    return silver.groupBy("company_name", "company_industry").agg(
        F.count("*").alias("open_positions"),
        A.mean("annual_salary_usd").alias("avg_offered_salary"),
        A.percent_if(F.col("is_remote")).alias("pct_remote"),
    )


# Report order of each aggregate. Tables are stored unsorted, since a sort before a parquet write
# costs a range shuffle and a reader has to sort anyway.
REPORT_ORDER = {
    "gold_top_skills": ["-posting_count", "skill_name"],
    "gold_salary_by_role_city": ["-total_postings", "role_category", "city", "experience_level"],
    "gold_remote_trends": ["role_category", "is_remote"],
    "gold_company_hiring": ["-open_positions", "company_name", "company_industry"],
}


def in_report_order(name: str, table: DataFrame) -> DataFrame:
    order = [
        F.col(key[1:]).desc() if key.startswith("-") else F.col(key) for key in REPORT_ORDER[name]
    ]
    return table.orderBy(*order)
