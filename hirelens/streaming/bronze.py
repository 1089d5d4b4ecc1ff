"""Messages to the Bronze table. Every step takes a batch or a streaming DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hirelens import schemas
from hirelens.functions import dates, text

# Lateness bound, trigger, partition columns and the preview's shape.
LATENESS = "10 minutes"
TRIGGER = "10 seconds"
PARTITIONS = ("ingest_year", "ingest_month", "ingest_day")
PREVIEW_COLUMNS = (
    "job_id",
    "company_name",
    "title",
    "city",
    "is_remote",
    "salary_min",
    "salary_max",
    "skills_count",
    "ingestion_time",
)
PREVIEW_ROWS = 10
#: Writing tasks for each core of the cluster.
WRITERS_PER_CORE = 3
QUALITY = "intake"
LANDED = "landed"
#: The time that drives the watermark; it does not reach the table.
EVENT_CLOCK = "_event_clock"


def parse(messages: DataFrame) -> DataFrame:
    """JSON to columns. A message that is no valid JSON becomes a row of nulls."""
    event = F.from_json(F.col("value").cast("string"), schemas.EVENT)
    parsed = messages.select(event.alias("event"), F.col("timestamp").alias("kafka_timestamp"))
    return parsed.select("event.*", "kafka_timestamp")


def validate(events: DataFrame) -> DataFrame:
    """Keep events with an id and a title; the query's progress counts both kinds."""
    usable = text.not_blank("job_id") & text.not_blank("title")
    observed = events.observe(
        QUALITY,
        F.count("*").alias("received"),
        F.count_if(~usable).alias("rejected"),
    )
    return observed.filter(usable)


def add_times(events: DataFrame, stamp: Column | None = None) -> DataFrame:
    """Event times from text, with the message time or the clock where text does not parse.

    ``stamp`` is the parsed ``ingestion_timestamp`` where there is one already.
    """
    if stamp is None:
        stamp = dates.parsed_time("ingestion_timestamp")
    return events.withColumns(
        {
            "posted_time": F.coalesce(dates.parsed_time("posted_at"), "kafka_timestamp"),
            "ingestion_time": F.coalesce(stamp, F.current_timestamp()),
            "processing_time": F.current_timestamp(),
        }
    )


def add_event_clock(events: DataFrame) -> DataFrame:
    """The stamp of the message; null without one.

    ``ingestion_time`` falls back on the clock of the cluster. As a watermark that, or the time at
    which the source took a replayed message in, would make all older messages late. A message
    without a stamp neither moves the watermark nor is ever late; the windowed mode forgets its id
    after the batch.
    """
    return events.withColumn(EVENT_CLOCK, dates.parsed_time("ingestion_timestamp"))


def deduplicate(
    events: DataFrame,
    mode: str = "global",
    keys: tuple[str, ...] = ("job_id",),
    event_time: str = "ingestion_time",
    salts: int = 1,
) -> DataFrame:
    """First event of each key.

    ``global`` remembers every key for good, so its state grows with the number of keys.
    ``windowed`` forgets a key once the watermark has passed it by ``LATENESS``, which bounds the
    state, and lets a key through again after that. Both drop events older than the watermark.

    ``salts`` above one helps ``global`` with a key that floods the stream: repeats first meet in
    that many groups per key, by arrival, and only the first of each group goes on. Elsewhere it
    would have no effect and is refused.
    """
    if salts > 1 and (mode != "global" or not events.isStreaming):
        raise ValueError("salts has an effect on a stream in global mode only")
    if not events.isStreaming:
        return events.dropDuplicates(list(keys))
    marked = events.withWatermark(event_time, LATENESS)
    if mode == "windowed":
        return marked.dropDuplicatesWithinWatermark(list(keys))
    if mode != "global":
        raise ValueError(f"mode must be 'global' or 'windowed', not {mode!r}")
    if salts > 1:
        arrival = F.xxhash64("kafka_timestamp", F.spark_partition_id())
        marked = marked.withColumn("_salt", F.pmod(arrival, F.lit(salts)))
        marked = marked.dropDuplicates([*keys, "_salt"]).drop("_salt")
    return marked.dropDuplicates(list(keys))


def enrich(events: DataFrame) -> DataFrame:
    time = F.col("ingestion_time")
    return events.withColumns(
        {
            "skills_count": text.size_or_zero("skills"),
            "has_salary_info": F.col("salary_min").isNotNull() | F.col("salary_max").isNotNull(),
            "ingest_year": F.date_format(time, "yyyy"),
            "ingest_month": F.date_format(time, "MM"),
            "ingest_day": F.date_format(time, "dd"),
        }
    )


def process(messages: DataFrame, dedup: str = "global", salts: int = 1) -> DataFrame:
    """The whole Bronze transformation, for a stream or for a batch of messages."""
    events = add_event_clock(validate(parse(messages)))
    # what follows from a row alone is added behind the shuffles of the de-duplication
    kept = deduplicate(events, mode=dedup, event_time=EVENT_CLOCK, salts=salts)
    # the observation also keeps the clock in the plan, without which no row would count as late
    landed = enrich(add_times(kept, F.col(EVENT_CLOCK))).observe(
        LANDED, F.count("*").alias("rows"), F.max(EVENT_CLOCK).alias("newest")
    )
    return landed.drop(EVENT_CLOCK)


def gathered(processed: DataFrame) -> DataFrame:
    """The stream's rows in as many tasks as the cluster's cores can use.

    A writing task has a file for each day it meets. One for every partition of the state would make
    files by partitions times days, a few rows in each, when a backlog of many days is worked off.
    """
    return processed.coalesce(WRITERS_PER_CORE * processed.sparkSession.sparkContext.defaultParallelism)


def start(
    processed: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = TRIGGER,
    name: str = "bronze_ingestion",
) -> StreamingQuery:
    """Append to the partitioned Bronze table. Without a trigger: all that is there, then stop."""
    pace = {"availableNow": True} if trigger is None else {"processingTime": trigger}
    return (
        gathered(processed)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*PARTITIONS)
        .trigger(**pace)
        .queryName(name)
        .start()
    )


def preview(bronze: DataFrame) -> DataFrame:
    return bronze.select(*PREVIEW_COLUMNS)


def start_preview(
    spark: SparkSession, bronze_path: str, checkpoint: str, trigger: str = TRIGGER
) -> StreamingQuery:
    """Show new Bronze rows on the console.

    This stream follows the Bronze table, not the source: it neither reads the topic a second time
    nor keeps a second set of seen ids.
    """
    landed = spark.readStream.schema(schemas.BRONZE).parquet(bronze_path)
    return (
        preview(landed)
        .writeStream.format("console")
        .outputMode("append")
        .option("truncate", "false")
        .option("numRows", PREVIEW_ROWS)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=trigger)
        .queryName("bronze_preview")
        .start()
    )


def supervise(spark: SparkSession) -> None:
    """Wait until any query ends, then stop the others; a failure is raised to the caller."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in spark.streams.active:
            query.stop()


def inspect_lines(events: DataFrame) -> DataFrame:
    """One readable line per event. Long titles and skill lists are cut in the line, not elsewhere."""

    def cell(value: Column, width: int) -> Column:
        return F.rpad(value, F.greatest(F.length(value), F.lit(width)), F.lit(" "))

    low, high = F.col("salary_min"), F.col("salary_max")
    span = F.concat(low.cast("string"), F.lit("-"), high.cast("string"))
    pay = F.when((low != 0) & (high != 0), F.concat_ws(" ", "salary_currency", span))
    skills = F.coalesce(F.nullif(F.array_join("skills", ", "), F.lit("")), F.lit("None"))
    city = F.coalesce(F.nullif("city", F.lit("")), F.lit("Remote"))
    title = F.coalesce("title", F.lit("N/A"))
    line = F.concat_ws(
        " | ",
        cell(F.coalesce("company_name", F.lit("N/A")), 20),
        cell(F.substring(title, 1, 30), 30),
        cell(city, 15),
        cell(F.coalesce(pay, F.lit("Unspecified")), 18),
        F.concat(F.lit("Skills: "), F.substring(skills, 1, 30)),
    )
    return events.select("job_id", line.alias("line"))
