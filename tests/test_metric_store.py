"""The metric store, and employers counted from sketches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hirelens import schemas
from hirelens.plans import dashboards, sketches
from hirelens.streaming import metric_store, metrics


@pytest.fixture
def store(spark, folder):
    return metric_store.MetricStore(spark, folder("metrics"), fan=4)


def report(spark, batch, landed, day=1, query="q"):
    when = dt.datetime(2024, 1, day, 0, batch % 60)
    return spark.createDataFrame([(query, "r", batch, when, landed + 1, 1, landed, 0, 2.0, 0.0, 5.0)], schemas.REPORT)


def totals(store):
    rows = metrics.series(store.read()).groupBy("metric_name").agg(F.max("value").alias("v")).collect()
    return {r.metric_name: r.v for r in rows if r.metric_name in (dashboards.BRONZE_ROWS, dashboards.FAILED)}


def test_many_reports_are_few_files(spark, store):
    for batch in range(21):
        store.add(report(spark, batch, 10))
    assert store.read().count() == 21 and len(store.read().inputFiles()) == 3  # 21 = 16 + 4 + 1
    assert totals(store) == {dashboards.BRONZE_ROWS: 210.0, dashboards.FAILED: 21.0}


def test_folded_days_keep_their_totals(spark, store):
    for batch in range(6):
        store.add(report(spark, batch, 10, day=1 + batch // 2))
    store.add(report(spark, 5, 10, day=3))  # the last batch ran again
    store.add(report(spark, 0, 7, day=1, query="other"))
    before = totals(store)
    store.fold_before("2024-01-03")
    assert totals(store) == before == {dashboards.BRONZE_ROWS: 60.0, dashboards.FAILED: 6.0}
    assert store.read().count() == 5 and len(store.read().inputFiles()) == 1
    store.add(report(spark, 6, 5, day=4))
    assert totals(store)[dashboards.BRONZE_ROWS] == 65.0


def test_a_restart_goes_on_in_the_same_store(spark, store):
    store.add(report(spark, 0, 10))
    again = metric_store.MetricStore(spark, store.store.root, fan=4)
    again.add(report(spark, 1, 10))
    assert totals(again)[dashboards.BRONZE_ROWS] == 20.0


def test_employers_from_sketches(spark):
    rows = [(dt.date(2024, 1 + i % 3, 1), f"r{i % 2}", "Oslo" if i % 5 else "Bergen", i % 2 == 0, f"c{i % 700}") for i in range(3000)]
    mart = spark.createDataFrame(rows, "posted_date date, role_category string, city string, is_remote boolean, company_name string")
    stored = sketches.sketched(mart)
    assert stored.count() <= 3 * 2 * 2 * 2
    for choices in ({}, {"city": "Bergen"}, {"role_category": "r1", "is_remote": "false"}):
        exact = dashboards.d14_companies(mart, choices).first().value
        assert abs(sketches.distinct_companies(stored, choices).first().value - exact) <= max(1, exact * sketches.error())
    assert sketches.distinct_companies(stored, {"city": "Nowhere"}).first().value == 0
    # sketches of two increments merge to that of both
    parts = sketches.sketched(mart.filter("company_name < 'c3'")).unionByName(sketches.sketched(mart.filter("company_name >= 'c3'")))
    assert abs(sketches.distinct_companies(parts).first().value - 700) <= 700 * sketches.error()
