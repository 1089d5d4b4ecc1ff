"""Cleaning rules on hand-written rows."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from hirelens import schemas
from hirelens.functions import rules, salary
from hirelens.plans import silver
from hirelens.sources import postings_csv


def labels(spark, titles, rule_set):
    df = spark.createDataFrame([(t,) for t in titles], "title string")
    label = rules.classify(F.lower("title"), rule_set).alias("label")
    return [row.label for row in df.select(label).collect()]


def test_roles_match_literal_fragments_inside_words(spark):
    titles = ["Senior Data Engineer", "Recruiter", "Agile Coach", "C++ Dev", "Accountant", None]
    assert labels(spark, titles, rules.ROLES) == [
        "Data Engineering",
        "Frontend & Web",
        "Product Management",
        "Software Engineering",
        "Other Tech Roles",
        "Other Tech Roles",
    ]


def test_compat_rules_match_any_c(spark):
    titles = ["Accountant", "Security Engineer", "Recruiter"]
    assert labels(spark, titles, rules.ROLES_COMPAT) == ["Software Engineering"] * 3


def test_levels(spark):
    titles = ["Senior Staff Eng", "Internal Auditor", "Israel Rep", "Dev"]
    assert labels(spark, titles, rules.LEVELS) == [
        "Lead / Principal",
        "Entry / Junior",
        "Senior",
        "Mid-Level",
    ]


def test_first_rule_wins_and_patterns_work(spark):
    custom = rules.RuleSet(
        (rules.Rule("digits", pattern="[0-9]+"), rules.Rule("a", ("a",))), "none"
    )
    assert labels(spark, ["a1", "a", "b"], custom) == ["digits", "a", "none"]
    assert custom.labels == ("digits", "a", "none")


@pytest.mark.parametrize(
    ("low", "high", "period", "expected"),
    [
        (50.0, 70.0, "hour", 124800.0),
        (50.0, None, "HOUR", 104000.0),
        (1000.0, None, "week", 1000.0),
        (100.0, 200.0, "day", 39000.0),
        (None, 5000.0, "month", 60000.0),
        (90000.0, 110000.0, None, 100000.0),
        (12.345, None, "hour", 25677.6),
        (None, None, "year", None),
        (1e20, 100.0, "year", None),
        (float("nan"), None, "year", None),
    ],
)
def test_annualized(spark, low, high, period, expected):
    df = spark.createDataFrame([(low, high, period)], "lo double, hi double, p string")
    assert df.select(salary.annualized("lo", "hi", F.lower("p"))).first()[0] == expected


def test_band_keeps_its_ends(spark):
    values = [9999.99, 10000.0, 1500000.0, 1500000.01, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    kept = [row[0] for row in df.select(salary.within_band(F.col("v"))).collect()]
    assert kept == [None, 10000.0, 1500000.0, None, None]


def test_location(spark, events):
    rows = silver.build(
        events(
            {"job_id": "1", "is_remote": True, "city": "Oslo"},
            {"job_id": "2", "location_raw": "Remote - EU", "city": "Oslo"},
            {"job_id": "3", "city": " new york "},
            {"job_id": "4", "city": "  ", "country": "south africa"},
            {"job_id": "5"},
        )
    )
    cities = {row.job_id: row.city_normalized for row in rows.collect()}
    assert cities == {
        "1": "Remote",
        "2": "Remote",
        "3": "New York",
        "4": "South Africa",
        "5": "Remote",
    }


def test_defaults_and_trims(events):
    row = silver.build(events({"job_id": " 7 ", "title": " Dev "})).first()
    assert (row.job_id, row.title, row.company_name) == ("7", "Dev", "Confidential / Unknown")
    assert (row.company_industry, row.country_normalized) == ("Technology", "Global")
    assert (row.employment_type, row.salary_currency, row.salary_period) == (
        "full_time",
        "USD",
        "year",
    )
    assert (row.is_remote, row.skills_count, row.annual_salary_usd) == (False, 0, None)


def test_unusable_ids_are_dropped(events):
    assert silver.build(events({"job_id": None}, {"job_id": "  "}, {"job_id": "x"})).count() == 1


def test_posted_date_falls_back_only_when_missing(events):
    rows = silver.build(
        events(
            {"job_id": "1", "posted_at": "2024-03-05T10:00:00Z"},
            {"job_id": "2", "ingestion_timestamp": "2024-04-01T00:00:00Z"},
            {"job_id": "3", "posted_at": "soon", "ingestion_timestamp": "2024-04-01T00:00:00Z"},
        )
    )
    found = {row.job_id: (row.posted_date, row.posted_at_raw) for row in rows.collect()}
    assert found["1"][0] == dt.date(2024, 3, 5)
    assert found["2"] == (dt.date(2024, 4, 1), "2024-04-01T00:00:00Z")
    assert found["3"] == (None, "soon")


def test_latest_version_wins_in_any_partitioning(events):
    copies = [
        {"job_id": "1", "title": f"T{i}", "ingestion_timestamp": f"2024-01-0{1 + i % 3}T00:00:00Z"}
        for i in range(9)
    ]
    df = events(*copies)
    winners = {
        silver.build(df.repartition(n, "title")).first().title for n in (1, 2, 5, 9)
    }
    assert winners == {"T2"}


def test_csv_words(text_rows):
    df = text_rows(
        {"job_id": "1", "salary_min": " 12.5 ", "is_remote": " Yes ", "skills": "a| b ||"},
        {"job_id": "2", "salary_min": "NaN", "is_remote": "t", "skills": ""},
        {"job_id": "3", "salary_min": "none", "is_remote": "0", "employment_type": " "},
        {"job_id": "4", "salary_min": "x", "skills": "10|20", "employment_type": "contract"},
    )
    rows = {row.job_id: row for row in postings_csv.normalize(df).collect()}
    assert [rows[i].salary_min for i in "1234"] == [12.5, None, None, None]
    assert [rows[i].is_remote for i in "1234"] == [True, True, False, False]
    assert [rows[i].skills for i in "1234"] == [["a", "b"], [], [], ["10", "20"]]
    assert [rows[i].employment_type for i in "34"] == ["full_time", "contract"]
    assert rows["1"].company_name is None
    assert rows["1"].ingestion_timestamp.endswith("Z")


def test_generated_code_stays_below_the_compiler_limit(spark, capsys, folder, events):
    path = folder("raw")
    events({"job_id": "1"}).write.parquet(path)
    capsys.readouterr()
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # adaptive plans print no code
    try:
        silver.build(spark.read.schema(schemas.EVENT).parquet(path)).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)
    assert sizes and max(map(int, sizes)) < 8000
