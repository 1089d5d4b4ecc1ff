"""Mart, panels, estimator and model."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hirelens import schemas
from hirelens.plans import dashboards, estimator, mart, salary_model, silver


@pytest.fixture
def silver_rows(spark):
    def build(*rows):
        names = schemas.SILVER.fieldNames()
        data = [tuple(row.get(n) for n in names) for row in rows]
        return spark.createDataFrame(data, schemas.SILVER)

    return build


def test_mart_defaults(silver_rows):
    row = mart.project(
        silver_rows({"job_id": "1", "company_name": "", "skills": None, "skills_count": 0})
    ).first()
    assert (row.skills_list, row.primary_skill, row.skills_count) == ("", "Python", 1)
    assert (row.is_remote, row.company_name, row.title) == (False, "Unknown Company", "Tech Role")
    assert (row.city, row.country) == ("San Francisco", "United States")
    assert (row.role_category, row.experience_level) == ("Software Engineering", "Mid-Level")


def test_mart_keeps_what_is_there(silver_rows):
    row = mart.project(
        silver_rows({"job_id": "1", "skills": ["b", "a"], "skills_count": 2, "is_remote": True})
    ).first()
    assert (row.skills_list, row.primary_skill, row.skills_count) == ("b, a", "b", 2)
    assert row.is_remote is True


def test_mart_layout(silver_rows):
    found = [(f.name, f.dataType) for f in mart.project(silver_rows({})).schema.fields]
    assert found == [(f.name, f.dataType) for f in schemas.MART.fields]


def test_panels_without_rows(silver_rows):
    table = mart.project(silver_rows({"job_id": "1", "annual_salary_usd": 50_000.0}))
    nobody = {"city": "Nowhere"}
    assert dashboards.d11_total(table, nobody).first().value == 0.0
    assert dashboards.d12_avg_salary(table, nobody).first().value == 0.0
    assert dashboards.d13_remote_rate(table, nobody).first().value == 0.0
    assert dashboards.d14_companies(table, nobody).first().value == 0.0
    assert dashboards.d31_filtered_salary(table, nobody).first().value == 168_450.0
    assert dashboards.d31_filtered_salary(table).first().value == 50_000.0


def test_panels_that_compare_ignore_their_own_choice(silver_rows):
    table = mart.project(
        silver_rows(
            {"job_id": "1", "role_category": "A", "annual_salary_usd": 10.0, "is_remote": True},
            {"job_id": "2", "role_category": "B", "annual_salary_usd": 20.0, "is_remote": False},
        )
    )
    roles = dashboards.d16_role_salary(table, {"role_category": "A"}).collect()
    assert [row.role_category for row in roles] == ["B", "A"]
    split = dashboards.d17_workplace_split(table, {"is_remote": "true"}).collect()
    assert {tuple(row) for row in split} == {("Remote", 1), ("Onsite / Hybrid", 1)}


def test_latest_metric(spark):
    rows = [("m", 1.0, dt.datetime(2024, 1, 1)), ("m", 2.0, dt.datetime(2024, 1, 2)),
            ("n", 9.0, dt.datetime(2025, 1, 1))]
    table = spark.createDataFrame(rows, schemas.METRIC)
    assert dashboards.latest_metric(table, "m").first().value == 2.0
    assert dashboards.latest_metric(table, "absent").count() == 0


def test_monthly_velocity_leaves_out_undated(silver_rows):
    table = mart.project(
        silver_rows(
            {"job_id": "1", "posted_date": dt.date(2024, 1, 31)},
            {"job_id": "2", "posted_date": dt.date(2024, 1, 1)},
            {"job_id": "3"},
        )
    )
    assert [tuple(r) for r in dashboards.d18_hiring_velocity(table).collect()] == [
        (dt.date(2024, 1, 1), 2)
    ]


# --- estimator --------------------------------------------------------------------------------

PROFILE = "id string, role_category string, experience_level string, city string, " \
    "is_remote boolean, skills array<string>"  # fmt: skip


def test_estimate(spark):
    rows = [
        ("known", "Data Engineering", "Senior", "San Francisco", True, ["a", "b", "c", "d"]),
        ("unknown", "Baker", "Boss", "Paris", False, None),
        ("many", "Data Engineering", "Senior", "Oslo", None, ["s"] * 20),
    ]
    found = {
        row.id: (row.estimated_salary, row.confidence)
        for row in estimator.estimate(spark.createDataFrame(rows, PROFILE)).collect()
    }
    assert found["known"] == (261104.00, 93.2)
    assert found["unknown"] == (130000.0, 86.0)
    assert found["many"] == (148500 * 1.28 + 70000, 96.5)


def test_curve(spark):
    rows = [("p", "Data Engineering", "Senior", "San Francisco", True, ["a"])]
    curve = estimator.seniority_curve(spark.createDataFrame(rows, PROFILE), "id").collect()
    expected = {
        level: round(148500 * float(factor) * 1.25 * 1.04 + 3500, 0)
        for level, factor in estimator.LEVEL_FACTOR.items()
    }
    assert {row.experience_level: row.estimated_salary for row in curve} == expected


# --- model ------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def postings(spark):
    rows = spark.range(600).select(
        F.concat(F.lit("J"), F.col("id")).alias("job_id"),
        F.when(F.col("id") % 2 == 0, "Data Engineering").alias("role_category"),
        F.when(F.col("id") % 3 == 0, "Senior").otherwise("Mid-Level").alias("experience_level"),
        F.when(F.col("id") % 5 == 0, "Oslo").otherwise("Rome").alias("city_normalized"),
        F.lit(" Full_Time ").alias("employment_type"),
        (F.col("id") % 4 == 0).alias("is_remote"),
        F.when(F.col("id") % 7 != 0, F.array(F.lit(" SQL "))).alias("skills"),
        (F.col("id") % 6).cast("int").alias("skills_count"),
        F.when(F.col("id") % 10 != 9, 60_000.0 + (F.col("id") % 6) * 9_000).alias(
            "annual_salary_usd"
        ),
    )
    return rows


@pytest.fixture(scope="module")
def model(postings):
    train, _ = salary_model.split(salary_model.prepare(postings))
    return salary_model.fit(train, trees=5, depth=4)


def test_prepare(postings):
    labelled = salary_model.prepare(postings)
    assert labelled.count() == 540
    everything = salary_model.prepare(postings, require_label=False)
    assert everything.count() == 600
    row = everything.filter("job_id = 'J7'").first()
    assert (row.role_category, row.primary_skill, row.employment_type) == (
        "Other Tech Roles",
        "general",
        "full_time",
    )
    assert everything.filter("job_id = 'J8'").first().primary_skill == "sql"


def test_prepare_without_optional_columns(spark):
    row = salary_model.prepare(
        spark.createDataFrame(
            [("A", "B", None, ["x", "y"], True)],
            "role_category string, experience_level string, employment_type string, "
            "skills array<string>, is_remote boolean",
        ),
        require_label=False,
    ).first()
    assert (row.city_normalized, row.skills_count_double, row.label) == ("Remote", 2.0, None)


def test_fit_is_repeatable(postings, model):
    train, test = salary_model.split(salary_model.prepare(postings))
    again = salary_model.fit(train, trees=5, depth=4)
    a = [row.prediction for row in model.transform(test).orderBy("job_id").collect()]
    b = [row.prediction for row in again.transform(test).orderBy("job_id").collect()]
    assert a == b


def test_evaluation_agrees_with_spark_ml(postings, model):
    _, test = salary_model.split(salary_model.prepare(postings))
    scored = model.transform(test)
    ours = salary_model.evaluate(scored).first()
    theirs = salary_model.evaluate_with_ml(scored)
    assert ours.rmse_usd == pytest.approx(theirs["rmse"])
    assert ours.r2_score == pytest.approx(theirs["r2"])
    assert ours.mae_usd == pytest.approx(theirs["mae"])


def test_saved_model_scores_alike(postings, model, folder):
    path = folder("model")
    salary_model.save(model, path)
    salary_model.save(model, path)
    loaded = salary_model.load(path)
    columns = ["prediction_id", "predicted_annual_salary"]
    a = sorted(map(tuple, salary_model.score(model, postings).select(*columns).collect()))
    b = sorted(map(tuple, salary_model.score(loaded, postings).select(*columns).collect()))
    assert a == b
    assert len(a) == 600
    with pytest.raises(Exception):
        salary_model.load(folder("nothing"))


def test_requests_with_unseen_city(spark, model):
    asked = salary_model.requests(
        spark,
        [
            ("r1", "Data Engineering", "Senior", "Atlantis", True, [" SQL ", "", "Spark"]),
            (None, "Data Engineering", "Senior", "Oslo", False, ["s"] * 9),
        ],
    )
    answers = salary_model.score_requests(model, asked)
    assert [(f.name, f.dataType) for f in answers.schema.fields] == [
        (f.name, f.dataType) for f in schemas.PREDICTION.fields
    ]
    rows = answers.orderBy("skills_count").collect()
    assert (rows[0].prediction_id, rows[0].skills_count, rows[0].primary_skill) == ("r1", 2, "sql")
    assert rows[0].confidence_score == 0.89
    assert rows[1].confidence_score == 0.96
    assert len(rows[1].prediction_id) == 36
    assert all(row.predicted_annual_salary > 0 for row in rows)


def test_prediction_sinks_share_one_layout(spark, postings, model, folder):
    path = folder("predictions")
    salary_model.overwrite_predictions(salary_model.score(model, postings), path)
    asked = salary_model.requests(spark, [("r", "A", "B", "C", True, ["x"])])
    salary_model.append_predictions(salary_model.score_requests(model, asked), path)
    stored = spark.read.schema(schemas.PREDICTION).parquet(path)
    assert stored.count() == 601
    recent = dashboards.d33_recent_predictions(stored)
    assert recent.count() == 20
    remote = dashboards.filter_predictions(stored, workplace="Remote Only")
    assert remote.count() == 151
    onsite = dashboards.filter_predictions(stored, "Data Engineering", "On-site Only")
    assert onsite.count() == 150
    assert dashboards.filter_predictions(stored).count() == 601


def test_metrics_report(spark, postings, model, folder):
    path = folder("report")
    _, test = salary_model.split(salary_model.prepare(postings))
    salary_model.save_metrics(salary_model.evaluate(model.transform(test)), path, 5, 4)
    row = spark.read.json(path).first()
    assert (row.model_type, row.num_trees, row.max_depth) == ("RandomForestRegressor", 5, 4)


def test_silver_feeds_the_model(events):
    built = silver.build(events({"job_id": "1", "title": "Dev", "salary_min": 50_000.0}))
    assert salary_model.prepare(built).first().label == 50_000.0
