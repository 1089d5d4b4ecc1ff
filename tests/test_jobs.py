"""The jobs end to end on landed messages."""

import pytest
from helpers import SMALL

from hirelens import jobs, schemas
from hirelens.sources import driver_tables, events, lake
from hirelens.streaming import bronze


@pytest.fixture(scope="module")
def landed(spark):
    from hirelens.session import fresh_folder

    messages, path = fresh_folder(spark, "messages"), fresh_folder(spark, "bronze")
    driver_tables.postings_as_messages(spark, SMALL).write.parquet(messages)
    stream = bronze.process(events.from_files(spark, messages))
    bronze.start(stream, path, fresh_folder(spark, "cp"), trigger=None).awaitTermination()
    return path


def test_bronze_to_dashboards(spark, landed, folder):
    root = folder("root")
    built = jobs.etl(spark, root, landed, folder("no-csv"))
    assert set(built) == {"silver", *schemas.GOLD}
    postings = built["silver"].count()
    assert built["fact_job_postings"].count() == postings
    assert built["fact_job_postings"].select("job_id").distinct().count() == postings

    assert jobs.ask(spark, root, "q01_kpi").first().total_job_postings == postings

    silver = jobs.silver_or_build(spark, root, landed, "")
    mart_path = f"{root}/job_postings_analytics"
    assert jobs.sync_mart(spark, silver, mart_path).count() == postings
    assert jobs.sync_mart(spark, silver, mart_path).count() == postings

    model = f"{root}/model"
    report = jobs.train(spark, silver, model, f"{root}/metrics", trees=3, depth=3).first()
    assert (report.num_trees, report.max_depth) == (3, 3)
    predictions = f"{root}/prediction_results"
    assert jobs.score(spark, silver, model, predictions).count() == postings
    request = ("r", "Data Engineering", "Senior", "Oslo", True, ["sql"])
    table = jobs.score_requests(spark, [request], model, predictions)
    assert table.count() == postings + 1

    names = lake.register_external(spark, "hirelens_jobs_test", root)
    for name in names:
        assert spark.table(f"hirelens_jobs_test.{name}").count() > 0, name


def test_a_day_is_merged_into_silver(spark, landed, folder):
    """A run for some days after a full run leaves what a full rebuild gives."""
    root, days = folder("root"), ("2002-01-01", "2002-01-01")
    full = jobs.etl(spark, root, landed, "", "bronze-to-silver")["silver"]
    expected = sorted(map(str, full.collect()))
    partly = full.filter("hash(job_id) % 3 <> 0").collect()
    spark.createDataFrame(partly, schemas.SILVER).write.mode("overwrite").parquet(f"{root}/silver")
    merged = jobs.etl(spark, root, landed, "", "bronze-to-silver", days)["silver"]
    first_day = lake.read_bronze(spark, landed, *days).select("job_id").distinct()
    assert len(partly) < merged.count() <= len(expected)
    assert set(map(str, merged.collect())) <= set(expected)
    ids = {row.job_id.strip() for row in first_day.collect()}
    assert ids and ids <= {row.job_id for row in merged.select("job_id").collect()}
    again = jobs.etl(spark, root, landed, "", "bronze-to-silver", ("2000-01-01", None))["silver"]
    assert sorted(map(str, again.collect())) == expected


def test_answers_are_printed_whole(spark):
    lines = list(jobs.printed(spark.range(250).selectExpr("id", "NULL AS nothing")))
    assert lines[0] == "id\tnothing" and len(lines) == 251 and lines[-1] == "249\t"


def test_missing_silver_is_built(spark, landed, folder):
    assert jobs.silver_or_build(spark, folder("root"), landed, "").count() > 0


def test_a_published_build_is_answered_from_and_replaced_whole(spark, landed, folder):
    root = folder("root")
    built = jobs.etl(spark, root, landed, "", publish=True)
    postings = built["silver"].count()
    assert jobs.ask(spark, root, "q01_kpi").first().total_job_postings == postings
    jobs.etl(spark, root, "", "", "silver-to-gold", publish=True)
    assert jobs.ask(spark, root, "q13_top5_levels").count() > 0
    store = jobs.Store(spark, root)
    assert store.current().number == 2
    homes = jobs.medallion.homes(store, store.current())
    lake.register_external(spark, "hirelens_published_test", root, homes)
    assert spark.table("hirelens_published_test.fact_job_postings").count() == postings


def test_upkeep_by_days_equals_one_build(spark, landed, folder):
    root = folder("root")
    jobs.upkeep(spark, root, landed, (None, "2002-01-01"), buckets=4)
    version = jobs.upkeep(spark, root, landed, ("2002-01-01", None), buckets=4, keep=1)
    live = jobs.LiveLake(spark, root)
    full = jobs.etl(spark, folder("full"), landed, "", "bronze-to-silver")["silver"]
    assert version.notes["buckets"] == 4 and live.store.current() == version
    assert sorted(map(str, live.table("silver").collect())) == sorted(map(str, full.collect()))
