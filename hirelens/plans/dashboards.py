"""Dashboard panels over the mart, the metric series and the prediction table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.functions import aggregates as A
from hirelens.operators.topk import top
from hirelens.operators.wildcard import where_selected

# Metric names, defaults and labels of the panels.
INGEST_RATE = "kafka_ingestion_rate"
LAG = "consumer_lag"
BRONZE_ROWS = "total_bronze_rows"
BATCH_DURATION = "microbatch_duration_ms"
FAILED = "failed_records"
SALARY_WITHOUT_DATA = 168_450.0

PAY = "annual_salary_usd"
Choices = Mapping[str, str]


def _or(value: Column, default: float) -> Column:
    return F.coalesce(value, F.lit(default))


def _without(choices: Choices, *names: str) -> dict[str, str]:
    return {name: choice for name, choice in choices.items() if name not in names}


# --- stream health ----------------------------------------------------------------------------


def latest_metric(metrics: DataFrame, name: str) -> DataFrame:
    """Newest value of one metric; one row per partition reaches the final merge."""
    newest = F.struct("recorded_at", "value")
    return (
        metrics.filter(F.col("metric_name") == name)
        .groupBy("metric_name")
        .agg(F.max(newest).alias("newest"))
        .select("metric_name", "newest.recorded_at", "newest.value")
    )


def d01_ingest_rate(metrics: DataFrame) -> DataFrame:
    return latest_metric(metrics, INGEST_RATE)


def d02_lag(metrics: DataFrame) -> DataFrame:
    return latest_metric(metrics, LAG)


def d03_bronze_rows(metrics: DataFrame) -> DataFrame:
    return latest_metric(metrics, BRONZE_ROWS)


def d04_batch_duration(metrics: DataFrame) -> DataFrame:
    """The measured duration of each micro-batch, oldest first."""
    series = metrics.filter(F.col("metric_name") == BATCH_DURATION)
    return series.select("recorded_at", F.col("value").alias("batch_duration_ms")).orderBy(
        "recorded_at", "batch_duration_ms"
    )


def d05_failed(metrics: DataFrame) -> DataFrame:
    return latest_metric(metrics, FAILED)


# --- labour market ----------------------------------------------------------------------------


def d11_total(mart: DataFrame, choices: Choices = {}) -> DataFrame:
    return where_selected(mart, choices).agg(F.count("*").cast("double").alias("value"))


def d12_avg_salary(mart: DataFrame, choices: Choices = {}) -> DataFrame:
    return where_selected(mart, choices).agg(_or(A.mean(PAY, 0), 0.0).alias("value"))


def d13_remote_rate(mart: DataFrame, choices: Choices = {}) -> DataFrame:
    share = A.percent_if(F.col("is_remote"), 1)
    return where_selected(mart, choices).agg(_or(share, 0.0).alias("value"))


def d14_companies(mart: DataFrame, choices: Choices = {}, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    distinct = count("company_name").cast("double")
    return where_selected(mart, choices).agg(distinct.alias("value"))


def d15_top_primary_skills(mart: DataFrame, choices: Choices = {}) -> DataFrame:
    skill = F.col("primary_skill").alias("skill")
    counted = where_selected(mart, choices).groupBy(skill).agg(F.count("*").alias("postings"))
    return top(counted, 10, [F.col("postings").desc(), F.col("skill")])


def d16_role_salary(mart: DataFrame, choices: Choices = {}) -> DataFrame:
    """Compares roles, so a choice of role does not apply."""
    paid = where_selected(mart, _without(choices, "role_category")).filter(F.col(PAY).isNotNull())
    by_role = paid.groupBy("role_category").agg(A.mean(PAY, 0).alias("avg_salary"))
    return by_role.orderBy(F.col("avg_salary").desc(), "role_category")


def workplace_label(is_remote: Column) -> Column:
    return F.when(is_remote, "Remote").otherwise("Onsite / Hybrid")


def d17_workplace_split(mart: DataFrame, choices: Choices = {}) -> DataFrame:
    """Compares workplaces, so a choice of workplace does not apply."""
    split = where_selected(mart, _without(choices, "is_remote")).groupBy("is_remote")
    return split.agg(F.count("*").alias("total_jobs")).select(
        workplace_label(F.col("is_remote")).alias("workplace_type"), "total_jobs"
    )


def d18_hiring_velocity(mart: DataFrame, choices: Choices = {}) -> DataFrame:
    """Dated postings per calendar month."""
    dated = where_selected(mart, choices).filter(F.col("posted_date").isNotNull())
    month = F.trunc("posted_date", "month").alias("month")
    return dated.groupBy(month).agg(F.count("*").alias("total_postings")).orderBy("month")


def d31_filtered_salary(mart: DataFrame, choices: Choices = {}) -> DataFrame:
    chosen = where_selected(mart, _without(choices, "is_remote"))
    return chosen.agg(_or(A.mean(PAY, 0), SALARY_WITHOUT_DATA).alias("value"))


def d33_recent_predictions(predictions: DataFrame) -> DataFrame:
    newest = top(predictions, 20, [F.col("prediction_timestamp").desc(), F.col("prediction_id")])
    return newest.select(
        *"role_category experience_level city is_remote skills_count primary_skill".split(),
        *"predicted_annual_salary confidence_score prediction_timestamp".split(),
    )


# The words of the prediction history's two filters.
ANY_ROLE = "All Roles"
WORKPLACES = {"All Types": "All", "Remote Only": "true", "On-site Only": "false"}


def filter_predictions(
    predictions: DataFrame, role: str = ANY_ROLE, workplace: str = "All Types"
) -> DataFrame:
    choices = {
        "role_category": "All" if role == ANY_ROLE else role,
        "is_remote": WORKPLACES[workplace],
    }
    return where_selected(predictions, choices)
