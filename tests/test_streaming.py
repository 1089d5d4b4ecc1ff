"""The Bronze stream: parsing, both kinds of de-duplication, lateness, restart, metrics."""

import datetime as dt
import json
import time

import pytest
from pyspark.sql import functions as F

from hirelens import schemas
from hirelens.plans import dashboards
from hirelens.sources import events as sources
from hirelens.sources import lake, postings_csv
from hirelens.streaming import bronze, metrics

NOON = dt.datetime(2024, 5, 1, 12)


def message(job_id="1", title="Dev", **fields):
    return json.dumps({"job_id": job_id, "title": title, **fields})


def at(clock):
    return f"2024-05-01T{clock}Z"


@pytest.fixture
def batch(spark):
    return lambda *texts: spark.createDataFrame([(t, NOON) for t in texts], schemas.ENVELOPE)


@pytest.fixture
def land(spark, batch):
    """Write one file; files are streamed in the order of their modification times."""

    def write(path, *texts):
        batch(*texts).coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)

    return write


def drain(spark, source, path, checkpoint, mode="global", files=None, salts=1):
    stream = sources.from_files(spark, source, files_per_trigger=files)
    query = bronze.start(bronze.process(stream, mode, salts), path, checkpoint, trigger=None)
    query.awaitTermination()
    return query


def test_parse_takes_bytes_and_text(spark, batch):
    rows = batch(message(skills=["a"], salary_min=1.5), "not json", "{}")
    as_bytes = rows.withColumn("value", F.col("value").cast("binary"))
    for df in (rows, as_bytes):
        ids = [row.job_id for row in bronze.parse(df).collect()]
        assert ids == ["1", None, None]
    assert bronze.parse(rows).first().kafka_timestamp == NOON


def test_validate_drops_blank_ids_and_titles(batch):
    rows = batch(
        message(), message(job_id=None), message(job_id="  "), message(title=None),
        message(title=" "), "not json",
    )
    assert bronze.validate(bronze.parse(rows)).count() == 1


def test_times_fall_back(batch):
    rows = batch(
        message("1", posted_at="2024-01-02T03:04:05Z", ingestion_timestamp=at("01:00:00")),
        message("2", posted_at="soon", ingestion_timestamp="later"),
    )
    first, second = bronze.add_times(bronze.parse(rows)).orderBy("job_id").collect()
    assert first.posted_time == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert first.ingestion_time == dt.datetime(2024, 5, 1, 1)
    assert second.posted_time == NOON
    assert second.ingestion_time == second.processing_time


def test_enrich(batch):
    rows = batch(message(salary_max=5.0, ingestion_timestamp="2024-03-09T00:00:00Z"))
    row = bronze.process(rows).first()
    assert (row.skills_count, row.has_salary_info) == (0, True)
    assert (row.ingest_year, row.ingest_month, row.ingest_day) == ("2024", "03", "09")


def test_layout(batch):
    found = [(f.name, f.dataType) for f in bronze.process(batch(message())).schema.fields]
    assert found == [(f.name, f.dataType) for f in schemas.BRONZE.fields]


@pytest.mark.parametrize(
    ("mode", "salts", "expected"),
    [("global", 1, ["a", "b"]), ("global", 4, ["a", "b"]), ("windowed", 1, ["a", "a", "b"])],
)
def test_dedup_modes_and_late_rows(spark, land, folder, mode, salts, expected):
    """Each run resumes the last one, whose closing empty batch has moved the watermark on."""
    source, out, checkpoint = folder("in"), folder("out"), folder("checkpoint")
    late = 0
    for events in (
        [("a", "00:00:00"), ("a", "00:01:00")],
        [("b", "02:00:00")],
        [("c", "00:00:30"), ("a", "02:01:00")],
    ):
        land(source, *[message(i, ingestion_timestamp=at(clock)) for i, clock in events])
        query = drain(spark, source, out, checkpoint, mode, salts=salts)
        late += sum(
            operator.numRowsDroppedByWatermark
            for progress in query.recentProgress
            for operator in progress.stateOperators
        )
    ids = sorted(row.job_id for row in lake.read_bronze(spark, out).collect())
    assert ids == expected
    assert late >= 1


def test_unknown_mode(spark, land, folder):
    source = folder("in")
    land(source, message())
    with pytest.raises(ValueError):
        bronze.process(sources.from_files(spark, source), "sometimes")


def test_stream_equals_batch(spark, land, folder, batch):
    texts = [message(f"{i % 40}", salary_min=float(i % 40)) for i in range(100)]
    source, out = folder("in"), folder("out")
    land(source, *texts)
    drain(spark, source, out, folder("checkpoint"))
    columns = ["job_id", "title", "salary_min", "skills_count", "has_salary_info"]
    streamed = sorted(map(tuple, lake.read_bronze(spark, out).select(*columns).collect()))
    batched = sorted(map(tuple, bronze.process(batch(*texts)).select(*columns).collect()))
    assert streamed == batched
    assert len(streamed) == 40


def test_restart_adds_only_new_messages(spark, land, folder):
    source, out, checkpoint = folder("in"), folder("out"), folder("checkpoint")
    land(source, message("1"), message("2"))
    drain(spark, source, out, checkpoint)
    drain(spark, source, out, checkpoint)
    assert lake.read_bronze(spark, out).count() == 2
    land(source, message("2"), message("3"))
    drain(spark, source, out, checkpoint)
    assert sorted(row.job_id for row in lake.read_bronze(spark, out).collect()) == ["1", "2", "3"]


def test_pace_limits_files_per_batch(spark, land, folder):
    source = folder("in")
    for i in range(3):
        land(source, message(str(i)))
    query = drain(spark, source, folder("out"), folder("checkpoint"), files=1)
    assert [p.numInputRows for p in query.recentProgress if p.numInputRows] == [1, 1, 1]


def test_a_backlog_of_days_makes_no_file_for_every_state_partition_and_day(spark, land, folder):
    """Files are days by writing tasks, however many partitions the state has; every row lands."""
    writers = bronze.WRITERS_PER_CORE * spark.sparkContext.defaultParallelism
    source, out, before = folder("in"), folder("out"), spark.conf.get("spark.sql.shuffle.partitions")
    stamps = [f"2024-05-{day:02d}T10:00:00Z" for day in (1, 2)]
    land(source, *[message(str(i), ingestion_timestamp=stamps[i % 2]) for i in range(40 * writers)])
    spark.conf.set("spark.sql.shuffle.partitions", 2 * writers)
    try:
        drain(spark, source, out, folder("checkpoint"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    rows = lake.read_bronze(spark, out)
    assert rows.count() == rows.select("job_id").distinct().count() == 40 * writers
    assert rows.select(F.input_file_name()).distinct().count() <= 2 * writers


@pytest.mark.parametrize("mode", ["global", "windowed"])
def test_what_follows_from_a_row_is_not_shuffled(spark, batch, land, folder, mode):
    """Times other than the stamp are added behind the de-duplication, and are the same."""
    source = folder("in")
    land(source, message(ingestion_timestamp=at("00:00:00")))
    for messages in (batch(message()), sources.from_files(spark, source)):
        processed = bronze.process(messages, mode)
        below = processed._jdf.queryExecution().analyzed().toString().split("Deduplicate")[1]
        assert not any(name in below for name in ("posted_time", "processing_time", "ingest_day"))
    texts = [message("1", ingestion_timestamp=at("01:02:03"), posted_at=at("00:00:01")), message("2", ingestion_timestamp="soon")]
    first, second = bronze.process(batch(*texts)).orderBy("job_id").collect()
    assert first.ingestion_time == dt.datetime(2024, 5, 1, 1, 2, 3) and first.posted_time == dt.datetime(2024, 5, 1, 0, 0, 1)
    assert second.ingestion_time == second.processing_time and second.posted_time == NOON


def test_processing_time_trigger_and_supervision(spark, land, folder):
    source, out = folder("in"), folder("out")
    land(source, message())
    processed = bronze.process(sources.from_files(spark, source))
    query = bronze.start(processed, out, folder("checkpoint"), trigger="1 second", name="paced")
    query.processAllAvailable()
    assert query.isActive
    query.stop()
    spark.streams.resetTerminated()
    assert lake.read_bronze(spark, out).count() == 1


def test_ingest_day_range_reads_only_those_folders(spark, land, folder):
    source, out = folder("in"), folder("out")
    days = ["2023-12-31", "2024-01-01", "2024-01-02", "2024-02-01"]
    land(source, *[message(day, ingestion_timestamp=f"{day}T00:00:00Z") for day in days])
    drain(spark, source, out, folder("checkpoint"))
    some = lake.read_bronze(spark, out, "2024-01-01", "2024-01-31")
    assert sorted(row.job_id for row in some.collect()) == ["2024-01-01", "2024-01-02"]
    assert some.first().ingest_month == "01"
    plan = some._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].split("PushedFilters")[0]
    assert "concat_ws(-, ingest_year" in filters


def test_preview_follows_the_bronze_table(spark, land, folder, capfd):
    source, out = folder("in"), folder("out")
    land(source, message("1", title="Seen in preview"))
    drain(spark, source, out, folder("checkpoint"))
    query = bronze.start_preview(spark, out, folder("checkpoint"), trigger="1 second")
    query.processAllAvailable()
    query.stop()
    spark.streams.resetTerminated()
    assert bronze.preview(lake.read_bronze(spark, out)).columns == list(bronze.PREVIEW_COLUMNS)


def test_metrics(spark, land, folder):
    """Every batch is recorded once, also when Spark itself remembers two reports only."""
    source, out, series = folder("in"), folder("out"), folder("metrics")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    recorder = metrics.record(spark, series, "bronze_ingestion")
    try:
        land(source, message("1"), message("1"), "not json")
        land(source, message("2"), message(" "))
        for i in range(3, 8):
            land(source, message(str(i)))
        checkpoint = folder("checkpoint")
        recorder.wait(drain(spark, source, out, checkpoint, files=1))
        land(source, message("8"), "{")
        recorder.wait(drain(spark, source, out, checkpoint, files=1))
    finally:
        spark.streams.removeListener(recorder)
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    table = metrics.read(spark, series)
    assert dashboards.d03_bronze_rows(table).first().value == 8.0
    assert dashboards.d05_failed(table).first().value == 3.0
    assert dashboards.d02_lag(table).first().value == 0.0
    assert dashboards.d01_ingest_rate(table).first().value >= 0.0
    durations = [row.batch_duration_ms for row in dashboards.d04_batch_duration(table).collect()]
    assert len(durations) >= 8 and all(value > 0 for value in durations[:7])


def test_a_batch_that_runs_again_counts_once(spark):
    when = dt.datetime(2024, 1, 1)
    rows = [("q", "r1", 0, when, 5, 1, 4, 0, 1.0, 0.0, 9.0), ("q", "r2", 0, when, 5, 1, 4, 0, 1.0, 0.0, 7.0),
            ("q", "r2", 1, when, 3, 0, 2, 1, 1.0, 0.0, 8.0), ("p", "r3", 0, when, 1, 0, 1, 0, 1.0, 0.0, 1.0)]
    table = metrics.series(spark.createDataFrame(rows, schemas.REPORT))
    found = {(r.metric_name, r.value) for r in table.collect()}
    assert {("total_bronze_rows", 6.0), ("late_rows", 1.0), ("failed_records", 1.0)} <= found
    assert table.count() == 18


@pytest.mark.parametrize("mode", ["global", "windowed"])
def test_a_message_without_stamp_makes_nothing_late(spark, land, folder, mode):
    source, out = folder("in"), folder("out")
    for i, clock in enumerate(["00:00:00", None, "00:30:00", "01:00:00"]):
        stamp = {"ingestion_timestamp": at(clock) if clock else None}
        land(source, message(f"a{i}", **stamp), message(f"b{i}", **stamp))
    drain(spark, source, out, folder("checkpoint"), mode, files=1)
    assert lake.read_bronze(spark, out).count() == 8


def test_salts_without_effect_are_refused(spark, land, folder, batch):
    source = folder("in")
    land(source, message())
    with pytest.raises(ValueError, match="salts"):
        bronze.process(sources.from_files(spark, source), "windowed", salts=4)
    with pytest.raises(ValueError, match="salts"):
        bronze.process(batch(message()), salts=4)


def test_supervise_stops_the_others_and_raises(spark, land, folder):
    def begin(name, column):
        stream = sources.from_files(spark, source).select(column)
        options = {"path": folder(name), "checkpointLocation": folder("checkpoint")}
        return stream.writeStream.format("parquet").options(**options).queryName(name).start()

    spark.streams.resetTerminated()
    source = folder("in")
    land(source, message())
    well = begin("well", F.col("value").cast("string"))
    begin("ill", F.raise_error(F.lit("broken")).cast("string").alias("value"))
    with pytest.raises(Exception, match="broken"):
        bronze.supervise(spark)
    assert not well.isActive
    spark.streams.resetTerminated()


def test_lag_is_what_the_source_reports():
    class Source:
        metrics = {"maxOffsetsBehindLatest": "42"}

    class Progress:
        sources = [Source()]

    assert metrics._lag(Progress()) == 42.0


def test_inspect_line(events):
    rows = events(
        {"job_id": "1", "company_name": "Acme", "title": "T" * 40, "salary_min": 1.0,
         "salary_max": 2.5, "salary_currency": "EUR", "skills": ["a", "b"], "city": "Oslo"},
        {"job_id": "2", "company_name": "C" * 25, "title": "Dev", "salary_min": 0.0,
         "salary_max": 2.5},
    )
    lines = {row.job_id: row.line for row in bronze.inspect_lines(rows).collect()}
    assert lines["1"] == " | ".join(
        ["Acme".ljust(20), "T" * 30, "Oslo".ljust(15), "EUR 1.0-2.5".ljust(18), "Skills: a, b"]
    )
    assert lines["2"] == " | ".join(
        ["C" * 25, "Dev".ljust(30), "Remote".ljust(15), "Unspecified".ljust(18), "Skills: None"]
    )


def test_replay_of_csv_files(spark, text_rows, folder):
    source, out = folder("csv"), folder("out")
    text_rows({"job_id": "1", "title": "Dev", "skills": "a|b"}).write.csv(source, header=True)
    stream = postings_csv.normalize(sources.from_csv_files(spark, source, 1))
    query = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", folder("checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert spark.read.parquet(out).first().skills == ["a", "b"]


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="kafka"):
        sources.from_kafka(spark, "localhost:9092", "job_postings")
