"""The pipeline's jobs, for ``spark-submit`` or ``python -m hirelens.jobs``.

Each function takes a session and paths and returns what it wrote, read back.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from hirelens import schemas
from hirelens.operators.insert import insert_only
from hirelens.plans import mart, medallion, salary_model, warehouse
from hirelens.plans.silver import identified
from hirelens.plans.upkeep import BUCKETS, LiveLake
from hirelens.sources import events, lake
from hirelens.sources.versions import Store, Version
from hirelens.streaming import bronze, metrics


STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def in_utc(spark: SparkSession) -> None:
    """Ingest days and posted times are days and times of UTC, whatever the session's zone is."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def ingest(
    spark: SparkSession,
    servers: str,
    topic: str,
    bronze_path: str,
    checkpoint: str,
    dedup: str = "global",
    preview: bool = False,
    salts: int = 1,
    max_offsets: int = events.MAX_OFFSETS_PER_TRIGGER,
    fail_on_data_loss: bool = False,
    metrics_path: str | None = None,
) -> list[StreamingQuery]:
    """Start the Bronze stream from a topic, and on request a console preview of what lands.

    Seen ids are kept in RocksDB, on disk, and every progress report is recorded below
    ``metrics_path`` (``<checkpoint>-metrics`` if not given).
    """
    in_utc(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    metrics.record(spark, metrics_path or f"{checkpoint}-metrics")
    messages = events.from_kafka(
        spark, servers, topic, max_offsets=max_offsets, fail_on_data_loss=fail_on_data_loss
    )
    processed = bronze.process(messages, dedup, salts)
    queries = [bronze.start(processed, bronze_path, checkpoint)]
    if preview:
        queries.append(bronze.start_preview(spark, bronze_path, f"{checkpoint}-preview"))
    return queries


def etl(
    spark: SparkSession,
    root: str,
    bronze_path: str,
    csv_path: str,
    stage: str = "all",
    days: tuple[str | None, str | None] = (None, None),
    buckets: int | None = None,
    publish: bool = False,
) -> dict[str, DataFrame]:
    """Bronze (or CSV) to Silver to Gold below ``root``.

    With ``days``, the postings that arrived on those ingest days are built anew in Silver and all
    others stay as they are; Gold then follows from the whole of Silver. With ``publish``, the build
    goes to folders of its own and becomes the current version at its end, all tables at once.
    """
    in_utc(spark)

    def raw() -> DataFrame:
        return lake.read_bronze_or_csv(spark, bronze_path, csv_path)

    def arrived() -> DataFrame:
        return lake.read_bronze(spark, bronze_path, *days)

    some = arrived if days != (None, None) else None
    source = None if stage == "silver-to-gold" else raw
    if publish:
        store = Store(spark, root)
        version = medallion.build_version(store, source, stage, buckets=buckets, arrived=some)
        return {name: spark.read.parquet(home) for name, home in medallion.homes(store, version).items()}
    lakehouse = medallion.Lakehouse(spark, root, raw=source, buckets=buckets, arrived=some)
    return medallion.run(lakehouse, stage)


def ask(spark: SparkSession, root: str, question: str) -> DataFrame:
    """One of the twenty warehouse questions, over the Gold tables already below ``root``."""
    store = Store(spark, root)
    version = store.current()
    tables = medallion.opened(store, version) if version.number else medallion.Lakehouse(spark, root).reopen()
    return warehouse.QUERIES[question](tables.table)


def upkeep(
    spark: SparkSession,
    root: str,
    bronze_path: str,
    days: tuple[str | None, str | None] = (None, None),
    buckets: int = BUCKETS,
    keep: int | None = None,
) -> Version:
    """Add the rows that arrived on some ingest days to the lake kept below ``root``.

    The first run takes all that is there. Days may overlap those of earlier runs. With ``keep``,
    all but that many versions are dropped afterwards.
    """
    in_utc(spark)
    live = LiveLake(spark, root, buckets=buckets)
    version = live.apply(lake.read_bronze(spark, bronze_path, *days))
    if keep is not None:
        live.store.expire(keep)
    return version


def printed(answer: DataFrame) -> Iterator[str]:
    """A header and every row, tab-separated; one partition at a time is on the driver."""
    yield "\t".join(answer.columns)
    for row in answer.toLocalIterator():
        yield "\t".join("" if value is None else str(value) for value in row)


def silver_or_build(
    spark: SparkSession, root: str, bronze_path: str, csv_path: str
) -> DataFrame:
    """Silver below ``root``, built first if it is missing or empty."""
    try:
        rows = lake.read_silver(spark, f"{root}/silver")
        if not rows.isEmpty():
            return rows
    except AnalysisException:
        pass
    return etl(spark, root, bronze_path, csv_path, "bronze-to-silver")["silver"]


def train(
    spark: SparkSession,
    silver: DataFrame,
    model_path: str,
    metrics_path: str,
    trees: int = salary_model.TREES,
    depth: int = salary_model.DEPTH,
) -> DataFrame:
    """Fit on the training share, save model and test metrics; returns the metrics."""
    in_utc(spark)
    training, test = salary_model.split(salary_model.prepare(silver))
    salary_model.save(salary_model.fit(training, trees, depth), model_path)
    scored = salary_model.load(model_path).transform(test)
    salary_model.save_metrics(salary_model.evaluate(scored), metrics_path, trees, depth)
    return spark.read.json(metrics_path)


def score(spark: SparkSession, silver: DataFrame, model_path: str, path: str) -> DataFrame:
    """Replace the prediction table with one prediction per posting."""
    salary_model.overwrite_predictions(
        salary_model.score(salary_model.load(model_path), silver), path
    )
    return spark.read.schema(schemas.PREDICTION).parquet(path)


def score_requests(
    spark: SparkSession, rows: list[tuple], model_path: str, path: str
) -> DataFrame:
    """Score ad-hoc requests, add them to the prediction table, and return the table."""
    asked = salary_model.requests(spark, rows)
    scored = salary_model.score_requests(salary_model.load(model_path), asked)
    salary_model.append_predictions(scored, path)
    return spark.read.schema(schemas.PREDICTION).parquet(path)


def sync_mart(
    spark: SparkSession, silver: DataFrame, path: str, arrived: DataFrame | None = None
) -> DataFrame:
    """Add the postings the mart does not hold yet; with ``arrived``, of those raw rows only."""
    if arrived is not None:
        ids = identified(arrived).select("job_id").distinct()
        silver = silver.join(ids, "job_id", "left_semi")
    insert_only(mart.project(silver), path, ["job_id"])
    return spark.read.schema(schemas.MART).parquet(path)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    jobs = ["ingest", "etl", "upkeep", "ask", "train", "score", "request", "mart", "tables"]
    parser.add_argument("job", choices=jobs)
    parser.add_argument("--root", help="folder of Silver, Gold, mart, model and predictions")
    parser.add_argument("--bronze", help="Bronze folder")
    parser.add_argument("--csv", help="CSV folder used when Bronze is missing or empty")
    parser.add_argument("--stage", choices=medallion.STAGES, default="all")
    parser.add_argument("--question", choices=list(warehouse.QUERIES))
    parser.add_argument("--first-day")
    parser.add_argument("--last-day")
    parser.add_argument("--servers")
    parser.add_argument("--topic", default="job_postings")
    parser.add_argument("--checkpoint")
    parser.add_argument("--dedup", choices=["global", "windowed"], default="global")
    parser.add_argument("--preview", action="store_true")
    parser.add_argument("--salts", type=int, default=1, help="groups per id in global mode")
    parser.add_argument("--max-offsets", type=int, default=events.MAX_OFFSETS_PER_TRIGGER)
    parser.add_argument("--fail-on-data-loss", action="store_true")
    parser.add_argument("--buckets", type=int, help="buckets of fact and bridge, or of a lake kept up")
    parser.add_argument("--publish", action="store_true", help="replace all tables in one step")
    parser.add_argument("--keep", type=int, help="versions that stay after upkeep")
    parser.add_argument("--request", help="a posting to score, as JSON, for the job request")
    parser.add_argument("--database", default="hirelens", help="catalog name for the job tables")
    parser.add_argument("--trees", type=int, default=salary_model.TREES)
    parser.add_argument("--depth", type=int, default=salary_model.DEPTH)
    args = parser.parse_args()

    spark = SparkSession.builder.appName(f"hirelens-{args.job}").getOrCreate()
    in_utc(spark)
    if args.job == "ingest":
        ingest(
            spark, args.servers, args.topic, args.bronze, args.checkpoint, args.dedup,
            args.preview, args.salts, args.max_offsets, args.fail_on_data_loss,
        )
        bronze.supervise(spark)
        return
    if args.job == "etl":
        days = (args.first_day, args.last_day)
        etl(spark, args.root, args.bronze, args.csv, args.stage, days, args.buckets, args.publish)
        return
    if args.job == "upkeep":
        days = (args.first_day, args.last_day)
        upkeep(spark, args.root, args.bronze, days, args.buckets or BUCKETS, args.keep)
        return
    if args.job == "ask":
        for line in printed(ask(spark, args.root, args.question)):
            print(line)
        return
    if args.job == "request":
        asked = json.loads(args.request)
        row = tuple(asked.get(name) for name in schemas.REQUEST.fieldNames())
        score_requests(spark, [row], f"{args.root}/model", f"{args.root}/prediction_results")
        return
    if args.job == "tables":
        store = Store(spark, args.root)
        lake.register_external(spark, args.database, args.root, medallion.homes(store, store.current()))
        return
    silver = silver_or_build(spark, args.root, args.bronze, args.csv)
    model = f"{args.root}/model"
    if args.job == "train":
        train(spark, silver, model, f"{args.root}/model_metrics", args.trees, args.depth).show()
    elif args.job == "score":
        score(spark, silver, model, f"{args.root}/prediction_results")
    else:
        days = (args.first_day, args.last_day)
        some = None if days == (None, None) else lake.read_bronze(spark, args.bronze, *days)
        sync_mart(spark, silver, f"{args.root}/job_postings_analytics", some)


if __name__ == "__main__":
    main()
