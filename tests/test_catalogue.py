"""Helpers of the entries on rows of their own, and session settings they rely on."""

import pytest
from pyspark.sql import functions as F

from hirelens import catalogue
from hirelens.sources.versions import Store


def test_a_checksum_passes_the_largest_bigint(spark):
    rows = spark.range(5).withColumn("key", F.lit(2**62) + F.col("id"))
    got = rows.agg(catalogue.contents("sum(key)").alias("c"), catalogue.contents("sum(id)").alias("small")).first()
    assert got.c == (5 * 2**62 + 10) % 2**63 and got.small == 10
    with pytest.raises(Exception, match="OVERFLOW"):
        rows.agg(F.expr("sum(key)")).first()
    assert rows.limit(0).agg(catalogue.contents("sum(key)").alias("c")).first().c is None


def test_windowed_rows_come_whole(spark):
    table = spark.createDataFrame(
        [("1", "Acme", "u1", 2, True), ("1", "Acme", "u1", 2, True), ("2", None, None, 0, False), ("2", None, None, 0, False)],
        "job_id string, company_name string, url string, skills_count int, has_salary_info boolean",
    )
    valid = spark.createDataFrame([("1", "a"), ("1", "b"), ("1", "b"), ("2", None), ("2", None)], "job_id string, ingestion_timestamp string")
    got = sorted(map(tuple, catalogue.within_stamps(valid, table).collect()))
    assert got == [("1", "Acme", "u1", 2, True, 2, True), ("2", None, None, 0, False, 1, False)]


def test_entries_leave_no_method_to_the_interpreter(spark, folder):
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    catalogue.context(spark, folder("tables"))
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_a_large_part_is_several_files(spark, folder):
    store = Store(spark, folder("store"))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "64k")
    try:
        rows = spark.range(0, 60000, numPartitions=8).withColumn("text", F.md5(F.col("id").cast("string")))
        draft = store.draft()
        draft.replace("t", rows, F.lit(3), ["3"])
        version = draft.publish()
    finally:
        spark.conf.unset(size)
    table = store.read(version, "t", rows.schema)
    assert table.count() == 60000 and len(table.inputFiles()) > 1


def test_messages_land_in_order_of_time_without_a_shuffle(spark):
    """A batch's worth of files for each quarter; the rows of a staged file go to one file of a quarter."""
    rows = spark.range(0, 4000, 1, 20).select(
        F.concat_ws(" ", F.spark_partition_id(), "id").alias("value"),
        F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(100_000))).alias("timestamp"),
    )

    class Own(catalogue.Context):
        def messages(self):
            return rows

    path = Own(spark, "").landed_messages()
    landed = spark.read.parquet(path).withColumns({"file": F.col("_metadata.file_path"), "landed": F.col("_metadata.file_modification_time")})
    assert landed.select("value", "timestamp").exceptAll(rows).isEmpty() and landed.count() == 4000
    files = landed.groupBy("file", "landed").agg(F.min("timestamp").alias("low"), F.max("timestamp").alias("high")).orderBy("landed").collect()
    quarters = [files[i : i + catalogue.FILES] for i in range(0, len(files), catalogue.FILES)]
    assert len(files) == 4 * catalogue.FILES
    for early, late in zip(quarters, quarters[1:], strict=False):
        assert max(f.high for f in early) < min(f.low for f in late)
    spread = landed.groupBy(F.split("value", " ")[0]).agg(F.count_distinct("file").alias("files"))
    assert spread.agg(F.max("files")).first()[0] == 4


def test_few_files_of_messages_are_spread(spark):
    rows = spark.range(0, 400, 1, 3).select(F.col("id").cast("string").alias("value"), F.timestamp_seconds("id").alias("timestamp"))

    class Own(catalogue.Context):
        def messages(self):
            return rows

    landed = spark.read.parquet(Own(spark, "").landed_messages())
    assert landed.exceptAll(rows).isEmpty() and landed.count() == 400
    assert landed.select(F.input_file_name()).distinct().count() == 4 * catalogue.FILES
