"""Declared layouts of every table in the pipeline, written as ``name type, name type``."""

from __future__ import annotations

from pyspark.sql import types as T

# The fields of a posting.
RAW_FIELDS = [
    "job_id", "company_name", "company_domain", "company_industry", "ats", "ats_token", "title",
    "department", "location_raw", "country", "city", "is_remote", "employment_type",
    "salary_min", "salary_max", "salary_currency", "salary_period", "salary_from_text",
    "skills", "posted_at", "scraped_at", "url",
]

_EVENT_TYPES = {
    "is_remote": "boolean",
    "salary_from_text": "boolean",
    "salary_min": "double",
    "salary_max": "double",
    "skills": "array<string>",
}


_TYPES = {
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def _struct(fields: str) -> T.StructType:
    """Built without a session, which ``StructType.fromDDL`` would need at import time."""
    pairs = [field.split() for field in fields.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


CSV = _struct(", ".join(f"{name} string" for name in RAW_FIELDS))

EVENT = _struct(
    ", ".join(f"{name} {_EVENT_TYPES.get(name, 'string')}" for name in RAW_FIELDS)
    + ", ingestion_timestamp string"
)

ENVELOPE = _struct("value string, timestamp timestamp")

BRONZE = T.StructType(
    EVENT.fields
    + _struct(
        "kafka_timestamp timestamp, posted_time timestamp, ingestion_time timestamp, "
        "processing_time timestamp, skills_count int, has_salary_info boolean, "
        "ingest_year string, ingest_month string, ingest_day string"
    ).fields
)

SILVER = _struct(
    "job_id string, company_name string, company_domain string, company_industry string, "
    "ats string, title string, role_category string, experience_level string, department string, "
    "city_normalized string, country_normalized string, is_remote boolean, "
    "employment_type string, salary_min double, salary_max double, salary_currency string, "
    "salary_period string, annual_salary_usd double, skills array<string>, skills_count int, "
    "posted_date date, posted_at_raw string, url string"
)

GOLD = {
    "dim_company": _struct(
        "company_key bigint, company_name string, company_domain string, "
        "company_industry string, total_jobs_posted bigint"
    ),
    "dim_job_role": _struct("role_key bigint, role_category string, experience_level string"),
    "dim_location": _struct("location_key bigint, city string, country string, is_remote boolean"),
    "dim_date": _struct(
        "date_key int, full_date date, year int, month int, day int, quarter int, "
        "day_name string, month_name string"
    ),
    "dim_skill": _struct("skill_key bigint, skill_name string"),
    "bridge_job_skills": _struct("job_id string, skill_key bigint"),
    "fact_job_postings": _struct(
        "fact_key bigint, job_id string, company_key bigint, role_key bigint, "
        "location_key bigint, date_key int, title string, annual_salary_usd double, "
        "salary_min double, salary_max double, salary_currency string, employment_type string, "
        "is_remote boolean, skills_count int, url string"
    ),
    "gold_top_skills": _struct(
        "skill_name string, posting_count bigint, avg_salary_usd double, remote_percentage double"
    ),
    "gold_salary_by_role_city": _struct(
        "role_category string, city string, experience_level string, total_postings bigint, "
        "avg_annual_salary double, min_annual_salary double, max_annual_salary double"
    ),
    "gold_remote_trends": _struct(
        "role_category string, is_remote boolean, total_jobs bigint, avg_salary double, "
        "avg_skills_required double"
    ),
    "gold_company_hiring": _struct(
        "company_name string, company_industry string, open_positions bigint, "
        "avg_offered_salary double, pct_remote double"
    ),
}

PREDICTION = _struct(
    "prediction_id string, role_category string, experience_level string, city string, "
    "is_remote boolean, skills_count int, primary_skill string, "
    "predicted_annual_salary double, confidence_score double, prediction_timestamp timestamp"
)

REQUEST = _struct(
    "request_id string, role_category string, experience_level string, city string, "
    "is_remote boolean, skills array<string>"
)

MART = _struct(
    "job_id string, company_name string, title string, role_category string, "
    "experience_level string, city string, country string, is_remote boolean, "
    "employment_type string, annual_salary_usd double, skills_count int, skills_list string, "
    "primary_skill string, posted_date date, created_at timestamp"
)

METRIC = _struct("metric_name string, value double, recorded_at timestamp")
REPORT = _struct(
    "query_id string, run_id string, batch_id bigint, recorded_at timestamp, received bigint, "
    "rejected bigint, landed bigint, late bigint, input_rate double, lag double, duration_ms double"
)
QUERY_STATE = _struct("name string, state string, batches bigint, rows bigint, error string")
