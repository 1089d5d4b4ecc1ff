"""The committing sink, its preview and compaction, query states and the lag of a file source."""

import pytest
from helpers import plan_of
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from hirelens import schemas
from hirelens.streaming import bronze, commits, metrics, states


@pytest.fixture
def rows(spark):
    """Bronze rows with these ids, alternately of two days."""

    def build(*ids):
        table = spark.createDataFrame([(str(i), "t", f"{i % 2 + 1:02d}") for i in ids], "job_id string, title string, ingest_day string")
        more = {f.name: F.lit(None).cast(f.dataType) for f in schemas.BRONZE.fields if f.name not in table.columns}
        return table.withColumns({**more, "ingest_year": F.lit("2024"), "ingest_month": F.lit("01")}).select(*schemas.BRONZE.fieldNames())

    return build


@pytest.fixture
def sink(spark, folder):
    return commits.CommittedSink(spark, folder("committed"), preview_rows=2, fan=2)


def ids(sink):
    return sorted(int(r.job_id) for r in commits.read(sink.store).collect())


def test_a_batch_replaces_itself(sink, rows):
    sink(rows(1, 2, 3), 0)
    sink(rows(4), 1)
    sink(rows(4), 1)
    assert ids(sink) == [1, 2, 3, 4]
    assert commits.read_preview(sink.store).count() == 3


def test_a_batch_that_was_compacted_adds_nothing(sink, rows):
    for number in range(4):
        sink(rows(number), number)
    assert list(sink.compact().tables[commits.TABLE]) == ["2-000000000000-000000000003"]
    before = sink.store.current().number
    sink(rows(3), 3)
    assert sink.store.current().number == before and ids(sink) == [0, 1, 2, 3]


def test_parts_and_files_stay_few(sink, rows):
    for number in range(13):
        sink(rows(*range(10 * number, 10 * number + 10)), number)
        sink.compact()
    parts = sink.store.current().tables[commits.TABLE]
    assert sorted(int(p.split("-")[0]) for p in parts) == [0, 2, 3]  # 13 = 8 + 4 + 1
    assert ids(sink) == list(range(130))
    merged = [p for p in parts if not p.startswith("0-")]
    files = commits.read(sink.store, parts=merged).inputFiles()
    assert len(files) <= 2 * len(merged)  # one a day
    one_day = commits.read(sink.store).filter("ingest_day = '01'")
    pruned = plan_of(one_day).split("PartitionFilters: [")[1].split("]")[0]
    assert one_day.count() == 65 and "ingest_day" in pruned


def test_tiers_that_fill_up_at_once_are_written_once(spark, sink, rows):
    """Seven batches by twos are two merged parts and a single one; nothing is written on the way to them."""
    for number in range(7):
        sink(rows(*range(10 * number, 10 * number + 10)), number)
    found = sink.compact()
    assert sorted(found.tables[commits.TABLE]) == ["0-000000000006-000000000006", "1-000000000004-000000000005", "2-000000000000-000000000003"]
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{sink.store.root}/{commits.TABLE}")
    assert len(folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)) == 7 + 2
    assert ids(sink) == list(range(70)) and sink.compact().number == found.number


def test_a_batch_is_computed_once(spark, sink, rows, monkeypatch):
    """The table's part is the only copy of a batch; the preview is read from it."""
    computed = spark.sparkContext.accumulator(0)

    def seen(value):
        computed.add(1)
        return value

    monkeypatch.setattr(type(spark.range(1)), "persist", lambda self, *_: pytest.fail("a second copy"))
    counted = F.udf(seen, "string").asNondeterministic()
    sink(rows(1, 2, 3).withColumn("job_id", counted("job_id")), 0)
    assert ids(sink) == [1, 2, 3] and commits.read_preview(sink.store).count() == 2
    assert computed.value == 3


def test_an_empty_batch_leaves_no_folder(spark, sink, rows):
    sink(rows(1), 0)
    sink(rows(2).limit(0), 1)
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{sink.store.root}/{commits.TABLE}")
    assert len(folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)) == 1 and ids(sink) == [1]


def test_empty_batches_publish_nothing(sink, rows):
    sink(rows(1).limit(0), 0)
    assert sink.store.current().number == 0 and ids(sink) == [] and commits.read_preview(sink.store).count() == 0


def test_a_query_that_dies_after_its_batch(spark, folder):
    source, root, checkpoint = folder("source"), folder("committed"), folder("checkpoint")
    spark.createDataFrame([("1", "a"), ("2", "b")], "job_id string, title string").select(
        F.to_json(F.struct("job_id", "title")).alias("value"), F.current_timestamp().alias("timestamp")
    ).write.parquet(source)

    class Dies(commits.CommittedSink):
        def __call__(self, batch, number):
            super().__call__(batch, number)
            raise RuntimeError("died")

    def run(sink):
        stream = spark.readStream.schema(schemas.ENVELOPE).parquet(source)
        commits.start(bronze.process(stream), sink, checkpoint, None, "dies").awaitTermination()

    with pytest.raises(StreamingQueryException, match="died"):
        run(Dies(spark, root))
    sink = commits.CommittedSink(spark, root)
    assert ids(sink) == [1, 2]
    run(sink)
    assert ids(sink) == [1, 2] and commits.read_preview(sink.store).count() == 2


def test_states_of_queries(spark, folder):
    found = states.watch(spark)

    def query(name, rows, **pace):
        writer = rows.writeStream.format("noop").option("checkpointLocation", folder(name))
        return writer.queryName(name).trigger(**pace).start()

    source = folder("numbers")
    spark.range(5).write.parquet(source)
    numbers = spark.readStream.schema("id long").parquet(source)
    done = query("done", numbers, availableNow=True)
    done.awaitTermination()
    found.wait(done)
    steady = query("steady", numbers, processingTime="1 second")
    steady.processAllAvailable()
    broken = query("broken", numbers.select(F.raise_error(F.lit("bad row")).cast("long").alias("x")), availableNow=True)
    table = {r.name: r for r in states.supervise(spark, found, [steady, broken]).collect()}
    assert {n: (r.state, r.rows) for n, r in table.items() if n != "broken"} == {"done": ("finished", 5), "steady": ("stopped", 5)}
    assert table["broken"].state == "failed" and "bad row" in table["broken"].error and table["done"].error is None
    spark.streams.removeListener(found)


def test_backlog_of_a_file_source(spark):
    report = ("q", "r", 0, None, 7, 0, 7, 0, 0.0, 0.0, 0.0)
    reports = spark.createDataFrame([report, report], schemas.REPORT)  # the batch ran twice
    assert metrics.backlog(reports, spark.range(10)).first().value == 3
    assert metrics.backlog(reports.limit(0), spark.range(10)).first().value == 10
    assert metrics.backlog(reports, spark.range(2)).first().value == 0
