"""Star schema, batch job and warehouse plans."""

import pytest
from helpers import SMALL, plan_of
from pyspark.sql import functions as F

from hirelens import catalogue, schemas
from hirelens.functions import aggregates
from hirelens.plans import gold, medallion, silver, warehouse
from hirelens.sources import lake


@pytest.fixture
def small_lake(spark, events, folder):
    raw = events(
        {
            "job_id": "1",
            "title": "Data Engineer",
            "company_name": "Acme",
            "company_industry": None,
            "city": "Oslo",
            "country": "Norway",
            "skills": ["SQL", " sql ", "  "],
            "salary_min": 100000.0,
            "posted_at": "2024-05-01",
        },
        {
            "job_id": "2",
            "title": "Lead Dev",
            "company_name": "Acme",
            "company_industry": "Rail",
            "city": "Oslo",
            "country": "Norway",
            "is_remote": True,
            "skills": ["Python"],
        },
        {"job_id": "3", "title": "Nurse", "company_name": "Beta", "city": "Remote",
         "country": "Norway", "posted_at": "2024-05-01"},
    )
    return medallion.Lakehouse(spark, folder("gold"), raw=lambda: raw)


def test_bridge_keeps_repeats_of_one_skill(small_lake):
    assert [row.skill_name for row in small_lake.table("dim_skill").collect()] == ["python", "sql"]
    pairs = sorted(tuple(row) for row in small_lake.table("bridge_job_skills").collect())
    assert pairs == [("1", 2), ("1", 2), ("2", 1)]


def test_missing_date_has_a_key_but_no_dimension_row(small_lake):
    days = small_lake.table("dim_date").collect()
    assert [(row.date_key, row.day_name, row.month_name) for row in days] == [
        (20240501, "Wednesday", "May")
    ]
    keys = {row.job_id: row.date_key for row in small_lake.table("fact_job_postings").collect()}
    assert keys == {"1": 20240501, "2": 19700101, "3": 20240501}


def test_company_attributes_come_from_the_lowest_id(small_lake):
    row = small_lake.table("dim_company").filter("company_name = 'Acme'").first()
    assert (row.company_key, row.company_industry, row.total_jobs_posted) == (1, "Technology", 2)


def test_same_place_with_both_remote_flags_gets_two_keys(small_lake):
    rows = small_lake.table("dim_location").filter("city = 'Remote'").orderBy("is_remote").collect()
    assert [(row.location_key, row.is_remote) for row in rows] == [(2, False), (3, True)]


def test_declared_layouts(small_lake):
    assert small_lake.table("silver").schema == schemas.SILVER
    for name, layout in schemas.GOLD.items():
        found = [(f.name, f.dataType) for f in small_lake.table(name).schema.fields]
        assert found == [(f.name, f.dataType) for f in layout.fields], name


def test_stages(spark, small_lake):
    first = medallion.run(small_lake, "bronze-to-silver")
    assert list(first) == ["silver"]
    later = medallion.Lakehouse(spark, small_lake.root)
    built = medallion.run(later, "silver-to-gold")
    assert set(built) == set(schemas.GOLD)
    assert built["fact_job_postings"].count() == 3
    with pytest.raises(ValueError):
        medallion.run(later, "gold")


def test_tables_survive_a_second_build_unchanged(spark, small_lake):
    first = medallion.run(small_lake)
    rows = {name: sorted(map(repr, table.collect())) for name, table in first.items()}
    again = medallion.run(medallion.Lakehouse(spark, small_lake.root), "silver-to-gold")
    for name, table in again.items():
        assert sorted(map(repr, table.collect())) == rows[name], name


def test_reopened_tables_keep_their_buckets(spark, small_lake):
    medallion.run(small_lake)
    database = small_lake._database()
    for name in medallion.BUCKETED:  # as in a new session, whose catalog is empty
        spark.sql(f"DROP TABLE {database}.{name}")
    later = medallion.Lakehouse(spark, small_lake.root, buckets=3).reopen()
    assert later._buckets == int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = warehouse._skill_facts(later.table, "title")
        assert "Exchange" not in plan_of(joined)
        assert joined.count() == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    assert warehouse.q01_kpi(later.table).first().total_job_postings == 3


def test_remote_postings_have_no_city_in_hubs(spark):
    hubs = catalogue.queries()["q06_hubs"](spark, SMALL)
    assert {row.remote_pct for row in hubs.collect()} == {0.0}


def test_breadth_tiers(spark):
    df = spark.createDataFrame([(n,) for n in (0, 2, 5, 10, 11)], "n int")
    tiers = [row[0] for row in df.select(warehouse.breadth_tier(F.col("n"))).collect()]
    assert tiers == [
        "0 Skills Listed",
        "1-2 Skills (Low)",
        "3-5 Skills (Medium)",
        "6-10 Skills (High)",
        "10+ Skills (Extensive)",
    ]


def test_bucketed_tables_join_without_moving_a_row(spark):
    context = catalogue.context(spark, SMALL)
    context.table("fact_job_postings"), context.table("bridge_job_skills")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = warehouse._skill_facts(context.table, "annual_salary_usd")
        plan = plan_of(joined)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    assert "SortMergeJoin" in plan
    assert "Exchange" not in plan


@pytest.mark.parametrize("name", list(warehouse.QUERIES))
def test_no_query_gathers_facts_in_one_task(spark, name):
    plan = plan_of(catalogue.queries()[name](spark, SMALL))
    if name != "q01_kpi":  # a global aggregate merges one partial row per task
        assert "SinglePartition" not in plan


def test_year_condition_reaches_the_fact_scan(spark):
    plan = plan_of(catalogue.queries()["q10_monthly"](spark, SMALL))
    assert "GreaterThan(date_key,20001231)" in plan


def test_averages_do_not_depend_on_order(spark):
    df = spark.range(10_000).select((F.rand(7) * 1e6).alias("x"))
    df = df.select(F.round("x", 2).alias("x"))
    results = {
        df.repartition(n, "x").agg(aggregates.mean("x")).first()[0] for n in (1, 3, 8, 50)
    }
    assert len(results) == 1


def test_percent_of_nothing_is_null(spark):
    empty = spark.createDataFrame([], "b boolean")
    assert empty.agg(aggregates.percent_if(F.col("b"))).first()[0] is None


def test_deviation_of_one_row(spark):
    one = spark.createDataFrame([(5.0,)], "x double")
    row = one.agg(aggregates.deviation("x"), aggregates.deviation("x", "sample")).first()
    assert tuple(row) == (0.0, None)


def test_external_tables(spark, small_lake):
    medallion.run(small_lake)
    names = lake.register_external(spark, "hirelens_test_ddl", small_lake.root)
    assert len(names) == 12
    count = spark.sql("SELECT count(*) FROM hirelens_test_ddl.fact_job_postings").first()[0]
    assert count == 3
    layout = spark.table("hirelens_test_ddl.dim_company").dtypes
    assert layout[0] == ("company_key", "bigint")


def test_report_order(small_lake):
    name = "gold_company_hiring"
    rows = gold.in_report_order(name, small_lake.table(name)).collect()
    assert [row.open_positions for row in rows] == [1, 1, 1]
    assert [row.company_industry for row in rows] == ["Rail", "Technology", "Technology"]


def test_bronze_or_csv(spark, events, folder):
    csv = folder("csv")
    spark.createDataFrame([("9", "Dev", "a|b", "2024-01-01T00:00:00Z")],
        "job_id string, title string, skills string, scraped_at string")
    rows = [tuple({"job_id": "9", "title": "Dev", "skills": "a|b",
        "scraped_at": "2024-01-01T00:00:00Z"}.get(n) for n in schemas.RAW_FIELDS)]
    spark.createDataFrame(rows, schemas.CSV).write.csv(csv, header=True)
    missing = lake.read_bronze_or_csv(spark, folder("nothing"), csv)
    assert missing.first().ingestion_timestamp == "2024-01-01T00:00:00Z"
    empty = folder("empty")
    spark.createDataFrame([], schemas.BRONZE).write.parquet(empty)
    assert lake.read_bronze_or_csv(spark, empty, csv).first().skills == ["a", "b"]
    assert silver.build(missing).first().posted_date.isoformat() == "2024-01-01"
