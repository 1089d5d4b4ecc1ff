"""Streaming sources. Each yields ``value`` (JSON text or bytes) and ``timestamp``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hirelens import schemas
from hirelens.sources import postings_csv

# Source options of the Bronze job.
MAX_OFFSETS_PER_TRIGGER = 5_000


def from_kafka(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    max_offsets: int = MAX_OFFSETS_PER_TRIGGER,
    fail_on_data_loss: bool = False,
) -> DataFrame:
    """Subscribe to a topic; needs the Kafka connector on the class path.

    A backlog that outlives the topic's retention is lost without a word unless
    ``fail_on_data_loss`` is set; ``max_offsets`` bounds how fast a backlog is worked off.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
        .option("maxOffsetsPerTrigger", max_offsets)
        .load()
        .select("value", "timestamp")
    )


def from_files(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Replay landed parquet files; ``files_per_trigger`` sets the pace."""
    reader = spark.readStream.schema(schemas.ENVELOPE)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def from_csv_files(
    spark: SparkSession, path: str, files_per_trigger: int | None = None
) -> DataFrame:
    """Replay raw CSV files as a stream of text rows."""
    reader = spark.readStream.schema(schemas.CSV).options(**postings_csv.OPTIONS)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.csv(path)
