"""Every operator and query under its name: the Spark job and, where SQL can say it, the oracle.

Gold and Silver tables are written once per session and data folder and read back, as the batch
job does; each entry builds only the tables it reads.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens import oracle as O
from hirelens import schemas
from hirelens.functions import aggregates as A
from hirelens.functions import dates, location, rules, salary
from hirelens.operators import insert, topk, wildcard
from hirelens.plans import dashboards, estimator, forest_table, gold, mart, medallion, salary_model, silver
from hirelens.plans import sketches, upkeep, warehouse
from hirelens.session import configured, fresh_folder, prefer_compiled
from hirelens.sources import driver_tables, events, lake, postings_csv
from hirelens.sources.versions import Store
from hirelens.operators.keys import dense_key
from hirelens.streaming import bronze, commits, metric_store, metrics, states


#: Files that land at a time; grows with the cluster, so that no task holds more than its share.
FILES = 8


@dataclass
class Context:
    """What entries share for one session and data folder."""

    spark: SparkSession
    sf_dir: str
    kept: dict = field(default_factory=dict)

    def once(self, name: str, make: Callable):
        if name not in self.kept:
            self.kept[name] = make()
        return self.kept[name]

    def source(self, name: str) -> DataFrame:
        return driver_tables.table(self.spark, self.sf_dir, name)

    def raw(self) -> DataFrame:
        return driver_tables.postings(self.spark, self.sf_dir)

    def messages(self) -> DataFrame:
        return driver_tables.postings_as_messages(self.spark, self.sf_dir)

    @property
    def lakehouse(self) -> medallion.Lakehouse:
        root = self.once("root", lambda: fresh_folder(self.spark, "lakehouse"))
        return self.once(
            "lakehouse", lambda: medallion.Lakehouse(self.spark, root, raw=self.raw)
        )

    def table(self, name: str) -> DataFrame:
        return self.lakehouse.table(name)

    def silver(self) -> DataFrame:
        return self.table("silver")

    def mart(self) -> DataFrame:
        return mart.project(self.silver())

    def live(self) -> upkeep.LiveLake:
        """A lake that took all postings in four batches, some of them replacing earlier ones."""

        def run() -> upkeep.LiveLake:
            # the postings are derived once, not once a batch, and a batch reads its own
            hour = F.substring("ingestion_timestamp", 12, 2).cast("int")
            batch = F.coalesce(hour % O.BATCHES, F.lit(0))
            path = fresh_folder(self.spark, "arrivals")
            self.raw().withColumn("_batch", batch).write.partitionBy("_batch").parquet(path)
            rows = self.spark.read.parquet(path)
            live = upkeep.LiveLake(self.spark, fresh_folder(self.spark, "live"), buckets=8)
            for number in range(O.BATCHES):
                live.apply(rows.filter(F.col("_batch") == number).drop("_batch"), stored=True)
            return live

        return self.once("live", run)

    def landed_messages(self) -> str:
        """The messages in four parts by time; a part is ``FILES`` files, which a batch takes."""

        def land() -> str:
            path, whole = fresh_folder(self.spark, "messages"), fresh_folder(self.spark, "messages-all")
            rows = lake.overwrite(self.messages(), whole)
            cuts = rows.agg(F.percentile_approx("timestamp", [0.25, 0.5, 0.75])).first()[0]
            part = sum((F.col("timestamp") > cut).cast("int") for cut in cuts)
            counts = rows.groupBy(part.alias("part"), F.col("_metadata.file_name").alias("file")).count().collect()
            for number in range(len(cuts) + 1):
                found = sorted((r for r in counts if r["part"] == number), key=lambda r: (-r["count"], r["file"]))
                files = [f"{whole}/{r['file']}" for r in found]
                if len(files) < FILES:
                    self.land(rows.filter(part == number), path)
                else:
                    with configured(self.spark, "spark.sql.unionOutputPartitioning", "false"):  # a task for each hand
                        self.dealt(files, rows).filter(part == number).write.mode("append").parquet(path)
            return path

        return self.once("messages", land)

    def dealt(self, files: list[str], table: DataFrame) -> DataFrame:
        """At least ``FILES`` files of a table, the largest first, as ``FILES`` partitions.

        They are dealt out whole, so none of their rows is sorted or shuffled.
        """
        # there and back, so that one partition does not get the largest of every round
        hands = [files[i :: 2 * FILES] + files[2 * FILES - 1 - i :: 2 * FILES] for i in range(FILES)]
        read = self.spark.read.schema(table.schema)
        return reduce(DataFrame.unionByName, [read.parquet(*hand).coalesce(1) for hand in hands])

    @staticmethod
    def land(rows: DataFrame, path: str) -> None:
        """Add rows as ``FILES`` files, one batch of a stream at that pace."""
        rows.repartition(FILES).write.mode("append").parquet(path)

    def landed_csv(self) -> str:
        def land() -> str:
            path = fresh_folder(self.spark, "csv")
            rows = driver_tables.postings_as_text(self.spark, self.sf_dir)
            rows.write.csv(path, header=True, escape='"', nullValue="")
            return path

        return self.once("csv", land)

    def bronze(self, mode: str = "global", salts: int = 1) -> str:
        """Run the Bronze stream over the landed messages, a part per batch, in order of time.

        Every hundredth message or so has no stamp. Returns the table's path.
        """

        def run() -> str:
            path = fresh_folder(self.spark, "bronze")
            stream = events.from_files(self.spark, self.landed_messages(), files_per_trigger=FILES)
            series = fresh_folder(self.spark, "metrics")
            recorder = metrics.record(self.spark, series, f"bronze_{mode}_{salts}")
            query = bronze.start(
                bronze.process(stream, mode, salts),
                path,
                fresh_folder(self.spark, "checkpoint"),
                trigger=None,
                name=f"bronze_{mode}_{salts}",
            )
            query.awaitTermination()
            recorder.wait(query)
            self.spark.streams.removeListener(recorder)
            self.kept[f"metrics {mode} {salts}"] = series
            return path

        return self.once(f"bronze {mode} {salts}", run)

    def bronze_table(self, mode: str = "global", salts: int = 1) -> DataFrame:
        return lake.read_bronze(self.spark, self.bronze(mode, salts))

    def metrics(self) -> DataFrame:
        self.bronze()
        return metrics.read(self.spark, self.kept["metrics global 1"])

    def model(self) -> PipelineModel:
        def train() -> str:
            train_rows, _ = salary_model.split(salary_model.prepare(self.silver()))
            path = fresh_folder(self.spark, "model")
            salary_model.save(salary_model.fit(train_rows), path)
            return path

        return salary_model.load(self.once("model", train))

    def scored_by_table(self, prepared: DataFrame, key: str = "job_id") -> DataFrame:
        """Scores of the loaded model, and of its trees read as a table, side by side."""
        model = self.model()
        forest = forest_table.nodes(self.spark, self.kept["model"])
        return forest_table.scored(model.transform(prepared), forest, salary_model.DEPTH, key)

    def predictions(self) -> DataFrame:
        def predict() -> str:
            path = fresh_folder(self.spark, "predictions")
            salary_model.overwrite_predictions(
                salary_model.score(self.model(), self.silver()), path
            )
            return path

        path = self.once("predictions", predict)
        return self.spark.read.schema(schemas.PREDICTION).parquet(path)

    def streamed(self, name: str, rows: DataFrame) -> DataFrame:
        """Drive a streaming DataFrame over what is there and return what it wrote."""
        path = fresh_folder(self.spark, name)
        query = (
            rows.writeStream.format("parquet")
            .option("path", path)
            .option("checkpointLocation", fresh_folder(self.spark, "checkpoint"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return self.spark.read.schema(rows.schema).parquet(path)


Job = Callable[[Context], DataFrame]
JOBS: dict[str, Job] = {}
SELECTS: dict[str, str] = {}


def job(name: str, sql: str | None = None) -> Callable[[Job], Job]:
    def register(build: Job) -> Job:
        JOBS[name] = build
        if sql is not None:
            SELECTS[name] = sql
        return build

    return register


def add(name: str, build: Job, sql: str | None = None) -> None:
    job(name, sql)(build)


SILVER_COLUMNS = ", ".join(schemas.SILVER.fieldNames())

# --- sources ----------------------------------------------------------------------------------

@job("src_csv_normalize", O.NORMALIZED)
def _(c: Context) -> DataFrame:
    text_rows = driver_tables.postings_as_text(c.spark, c.sf_dir)
    return postings_csv.normalize(text_rows).drop("ingestion_timestamp")


@job("src_csv_fallback", "SELECT job_id, company_name, city_normalized, annual_salary_usd, "
     "skills_count, posted_date FROM csv_silver")  # fmt: skip
def _(c: Context) -> DataFrame:
    rows = lake.read_bronze_or_csv(c.spark, f"{c.landed_csv()}-no-bronze", c.landed_csv())
    return silver.build(rows).select(
        *"job_id company_name city_normalized annual_salary_usd skills_count posted_date".split()
    )


BRONZE_SQL = (
    "SELECT DISTINCT job_id, company_name, url, "
    "CAST(coalesce(len(skills), 0) AS INTEGER) AS skills_count, "
    "(salary_min IS NOT NULL OR salary_max IS NOT NULL) AS has_salary_info "
    "FROM postings WHERE trim(job_id) <> '' AND trim(title) <> ''"
)
BRONZE_COLUMNS = "job_id company_name url skills_count has_salary_info".split()


@job("src_bronze_parquet", BRONZE_SQL)
def _(c: Context) -> DataFrame:
    return c.bronze_table().select(*BRONZE_COLUMNS)


@job("src_replay", "SELECT nullif(trim(job_id), '') AS job_id, "
     "nullif(trim(title), '') AS title FROM postings")  # fmt: skip
def _(c: Context) -> DataFrame:
    replay = events.from_csv_files(c.spark, c.landed_csv(), files_per_trigger=2)
    return c.streamed("replay", postings_csv.normalize(replay).select("job_id", "title"))


add("src_silver_parquet", Context.silver, f"SELECT {SILVER_COLUMNS} FROM silver")


@job("src_request_rows", "SELECT job_id AS request_id, role_category, experience_level, "
     "city_normalized AS city, is_remote, skills FROM silver")  # fmt: skip
def _(c: Context) -> DataFrame:
    return _requests(c)


def _requests(c: Context) -> DataFrame:
    return c.silver().select(
        F.col("job_id").alias("request_id"),
        "role_category",
        "experience_level",
        F.col("city_normalized").alias("city"),
        "is_remote",
        "skills",
    )


@job("src_model", "SELECT job_id, true AS agrees FROM features WHERE label > 0")
def _(c: Context) -> DataFrame:
    """The loaded model scores every posting as its trees do, read from their files as a table."""
    rows = c.scored_by_table(salary_model.prepare(c.silver()))
    return rows.select("job_id", forest_table.agrees("prediction", "table_prediction").alias("agrees"))


@job("sink_model", "SELECT job_id, true AS agrees FROM features WHERE label > 0")
def _(c: Context) -> DataFrame:
    """A model scores the same before it is saved and after it is loaded."""
    prepared = salary_model.prepare(c.silver())
    fitted = salary_model.fit(salary_model.split(prepared)[0], trees=5, depth=5)
    path = fresh_folder(c.spark, "model")
    salary_model.save(fitted, path)
    before = fitted.transform(prepared).select("job_id", F.col("prediction").alias("before"))
    after = salary_model.load(path).transform(prepared).select("job_id", "prediction")
    both = before.join(after, "job_id")
    return both.select("job_id", forest_table.agrees("before", "prediction").alias("agrees"))


@job("src_temp_views", "SELECT role_category, count(*) AS jobs FROM silver GROUP BY ALL")
def _(c: Context) -> DataFrame:
    lake.register_views({"silver_view": c.silver()})
    return c.spark.sql("SELECT role_category, count(*) AS jobs FROM silver_view GROUP BY ALL")


@job("src_external_tables", "SELECT company_industry, count(*) AS companies, "
     "CAST(sum(total_jobs_posted) AS BIGINT) AS jobs FROM dim_company GROUP BY ALL")  # fmt: skip
def _(c: Context) -> DataFrame:
    c.table("dim_company")
    lake.register_external(c.spark, "hirelens_external", c.lakehouse.root)
    return c.spark.sql(
        "SELECT company_industry, count(*) AS companies, sum(total_jobs_posted) AS jobs "
        "FROM hirelens_external.dim_company GROUP BY ALL"
    )


@job("src_multi_part_read", "SELECT count(*) AS postings, "
     "count(DISTINCT job_id) AS ids FROM silver")  # fmt: skip
def _(c: Context) -> DataFrame:
    c.silver()
    parts = lake.read_silver(c.spark, c.lakehouse.path("silver"))
    return parts.agg(F.count("*").alias("postings"), F.count_distinct("job_id").alias("ids"))


# --- sinks with a batch result ----------------------------------------------------------------


@job("sink_overwrite_parquet", "SELECT * FROM dim_job_role")
def _(c: Context) -> DataFrame:
    path = fresh_folder(c.spark, "overwrite")
    lake.overwrite(c.table("dim_job_role").limit(1), path)
    return lake.overwrite(c.table("dim_job_role"), path)


MART_COLUMNS = ", ".join(name for name in schemas.MART.fieldNames() if name != "created_at")


@job("sink_mart_insert_only", "SELECT job_id, CASE WHEN is_remote THEN 'kept' ELSE title END "
     "AS title, city FROM mart")  # fmt: skip
def _(c: Context) -> DataFrame:
    path = fresh_folder(c.spark, "insert-only")
    rows = c.mart().select("job_id", "title", "city", "is_remote")
    present = rows.filter("is_remote").withColumn("title", F.lit("kept"))
    insert.insert_only(present.drop("is_remote"), path, ["job_id"])
    insert.insert_only(rows.drop("is_remote"), path, ["job_id"])
    return c.spark.read.parquet(path)


@job("sink_predictions_append", "SELECT CAST(2 * count(*) AS BIGINT) AS predictions, "
     "count(*) AS ids FROM silver")  # fmt: skip
def _(c: Context) -> DataFrame:
    path = fresh_folder(c.spark, "appended")
    for _ in range(2):
        salary_model.append_predictions(c.predictions(), path)
    stored = c.spark.read.schema(schemas.PREDICTION).parquet(path)
    return stored.agg(
        F.count("*").alias("predictions"), F.count_distinct("prediction_id").alias("ids")
    )


@job("sink_predictions_overwrite", "SELECT count(*) AS predictions FROM silver")
def _(c: Context) -> DataFrame:
    path = fresh_folder(c.spark, "overwritten")
    for _ in range(2):
        salary_model.overwrite_predictions(c.predictions(), path)
    stored = c.spark.read.schema(schemas.PREDICTION).parquet(path)
    return stored.agg(F.count("*").alias("predictions"))


@job("sink_model_metrics", "SELECT 'RandomForestRegressor' AS model_type, "
     f"CAST({salary_model.TREES} AS BIGINT) AS num_trees, CAST({salary_model.DEPTH} AS BIGINT) AS max_depth, "
     "count(*) AS test_records, true AS r2_score, true AS rmse_usd, true AS mae_usd FROM features "
     "WHERE label > 0 AND NOT substr(md5(job_id), 1, 4) < 'cccd'")  # fmt: skip
def _(c: Context) -> DataFrame:
    """The stored report, its figures compared with those of the trees as a table."""
    path = fresh_folder(c.spark, "model-metrics")
    salary_model.save_metrics(_evaluation(c), path)
    other = _table_evaluation(c)
    stored = c.spark.read.json(path)
    close = {n: F.abs(F.col(n) - F.lit(other[n])) <= 0.01 for n in ("r2_score", "rmse_usd", "mae_usd")}
    return stored.select("model_type", "num_trees", "max_depth", "test_records", *(v.alias(n) for n, v in close.items()))


class Unlucky(commits.CommittedSink):
    """A sink whose query dies once, after a batch is published and before it is checkpointed."""

    def __call__(self, batch: DataFrame, number: int) -> None:
        super().__call__(batch, number)
        if number == 1 and not getattr(self, "died", False):
            self.died = True
            raise RuntimeError("died")


def _committed(c: Context) -> commits.CommittedSink:
    """The messages through the committing sink, one batch twice, with the whole preview; compacted by twos."""

    def run() -> commits.CommittedSink:
        sink = Unlucky(c.spark, fresh_folder(c.spark, "committed"), preview_rows=None, fan=2)
        checkpoint = fresh_folder(c.spark, "checkpoint")
        for last in (False, True):
            stream = bronze.process(events.from_files(c.spark, c.landed_messages(), FILES))
            query = commits.start(stream, sink, checkpoint, trigger=None, name="committed")
            try:
                query.awaitTermination()
            except StreamingQueryException:
                if last:
                    raise
        c.kept["preview version"] = sink.store.current()
        sink.compact()
        return sink

    return c.once("committed", run)


@job("sink_preview_stream", "SELECT DISTINCT job_id, company_name, city, is_remote, salary_min, "
     "salary_max, CAST(coalesce(len(skills), 0) AS INTEGER) AS skills_count FROM postings "
     "WHERE trim(job_id) <> '' AND trim(title) <> ''")  # fmt: skip
def _(c: Context) -> DataFrame:
    """What the running query wrote to the preview beside the table."""
    shown = commits.read_preview(_committed(c).store, c.kept["preview version"])
    return shown.drop("title", "ingestion_time")


@job("sink_bronze_committed", BRONZE_SQL)
def _(c: Context) -> DataFrame:
    """A batch that ran twice and the compaction leave each posting once."""
    return commits.read(_committed(c).store).select(*BRONZE_COLUMNS)


@job("sink_bronze_compacted", "SELECT CAST(1 AS BIGINT) AS parts, CAST(4 AS BIGINT) AS parts_before, "
     f"count(*) AS rows FROM ({BRONZE_SQL})")  # fmt: skip
def _(c: Context) -> DataFrame:
    """Four batches in tiers of two are one part."""
    store, before = _committed(c).store, c.kept["preview version"]
    now = store.current()
    return commits.read(store, now).agg(
        F.lit(len(now.tables[commits.TABLE])).cast("bigint").alias("parts"),
        F.lit(len(before.tables[commits.TABLE])).cast("bigint").alias("parts_before"),
        F.count("*").alias("rows"),
    )


add("sink_stream_metrics", lambda c: c.metrics().groupBy("metric_name").agg(
    (F.count("*") >= 4).alias("one_per_batch")),
    "SELECT unnest(['kafka_ingestion_rate', 'consumer_lag', 'total_bronze_rows', "
    "'microbatch_duration_ms', 'failed_records', 'late_rows']) AS metric_name, "
    "true AS one_per_batch")  # fmt: skip

# --- projections, filters, predicates ---------------------------------------------------------

PLAIN = "job_id, company_name, title, is_remote, salary_min, salary_max, skills, posted_at"


@job("parse_events", f"SELECT {PLAIN}, ingestion_timestamp FROM postings UNION ALL "
     "SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM orders "
     "WHERE o_orderkey % 500 = 0")  # fmt: skip
def _(c: Context) -> DataFrame:
    return bronze.parse(c.messages()).select(
        *[name.strip() for name in PLAIN.split(",")], "ingestion_timestamp"
    )


@job("validate_events", f"SELECT {PLAIN} FROM postings "
     "WHERE trim(job_id) <> '' AND trim(title) <> ''")  # fmt: skip
def _(c: Context) -> DataFrame:
    kept = bronze.validate(bronze.parse(c.messages()))
    return kept.select(*[name.strip() for name in PLAIN.split(",")])


def _moment(column: str) -> str:
    return f"CAST(replace(replace({column}, 'T', ' '), 'Z', '') AS TIMESTAMP)"


BROKEN = "FROM orders WHERE o_orderkey % 500 = 0"
STAMP = _moment("ingestion_timestamp")
POSTED = f"CASE WHEN posted_at <> 'soon' THEN {_moment('posted_at')} END"


def _if_stamped(name: str):
    """Without a stamp the job takes the clock, which no second run can repeat."""
    return F.when(F.col("ingestion_timestamp").isNotNull(), F.col(name)).alias(name)


@job("event_times", f"SELECT job_id, coalesce({POSTED}, {STAMP}, TIMESTAMP '2002-01-01') AS "
     f"posted_time, {STAMP} AS ingestion_time FROM postings UNION ALL "
     f"SELECT NULL, o_orderdate, NULL {BROKEN}")  # fmt: skip
def _(c: Context) -> DataFrame:
    timed = bronze.add_times(bronze.parse(c.messages()))
    return timed.select("job_id", "posted_time", _if_stamped("ingestion_time"))


@job("enrich_events", "SELECT job_id, CAST(coalesce(len(skills), 0) AS INTEGER) AS skills_count, "
     "(salary_min IS NOT NULL OR salary_max IS NOT NULL) AS has_salary_info, "
     "substr(ingestion_timestamp, 1, 4) AS ingest_year, "
     "substr(ingestion_timestamp, 6, 2) AS ingest_month, "
     "substr(ingestion_timestamp, 9, 2) AS ingest_day FROM postings "
     f"UNION ALL SELECT NULL, 0, false, NULL, NULL, NULL {BROKEN}")  # fmt: skip
def _(c: Context) -> DataFrame:
    enriched = bronze.enrich(bronze.add_times(bronze.parse(c.messages())))
    days = [_if_stamped(name) for name in bronze.PARTITIONS]
    return enriched.select("job_id", "skills_count", "has_salary_info", *days)


add("silver_clean", lambda c: silver.build(c.raw()), f"SELECT {SILVER_COLUMNS} FROM silver")


def _titled(c: Context) -> DataFrame:
    return c.raw().select("job_id", "title", F.lower("title").alias("lower_title"))


@job("classify_role", "SELECT job_id, title, "
     f"{O.labelled('lower(title)', rules.ROLES)} AS role_category FROM postings")  # fmt: skip
def _(c: Context) -> DataFrame:
    role = rules.role_category(F.col("lower_title")).alias("role_category")
    return _titled(c).select("job_id", "title", role)


@job("classify_role_compat", "SELECT job_id, title, "
     f"{O.labelled('lower(title)', rules.ROLES_COMPAT)} AS role_category FROM postings"
     )
def _(c: Context) -> DataFrame:
    role = rules.role_category(F.col("lower_title"), rules.ROLES_COMPAT).alias("role_category")
    return _titled(c).select("job_id", "title", role)


@job("classify_experience", "SELECT job_id, title, "
     f"{O.labelled('lower(title)', rules.LEVELS)} AS experience_level FROM postings")  # fmt: skip
def _(c: Context) -> DataFrame:
    level = rules.experience_level(F.col("lower_title")).alias("experience_level")
    return _titled(c).select("job_id", "title", level)


@job("normalize_location", f"SELECT job_id, {O.CITY} AS city_normalized FROM postings")
def _(c: Context) -> DataFrame:
    city = location.city_or_remote(F.col("is_remote"), "location_raw", "city", "country")
    return c.raw().select("job_id", city.alias("city_normalized"))


@job("annualize_salary", f"SELECT job_id, {O.annual()} AS annual_salary_usd FROM postings")
def _(c: Context) -> DataFrame:
    pay = salary.annualized("salary_min", "salary_max", F.lower("salary_period"))
    return c.raw().select("job_id", pay.alias("annual_salary_usd"))


@job("null_salary_outliers",
     f"SELECT job_id, {O.in_band('pay')} AS annual_salary_usd FROM "
     f"(SELECT job_id, {O.annual()} AS pay FROM postings)")  # fmt: skip
def _(c: Context) -> DataFrame:
    pay = salary.annualized("salary_min", "salary_max", F.lower("salary_period")).alias("pay")
    paid = c.raw().select("job_id", pay)
    return paid.select("job_id", salary.within_band(F.col("pay")).alias("annual_salary_usd"))


@job("posted_date", f"SELECT job_id, {O.POSTED_DATE} AS posted_date, "
     f"{O.POSTED_RAW} AS posted_at_raw FROM postings")  # fmt: skip
def _(c: Context) -> DataFrame:
    raw = F.coalesce("posted_at", "ingestion_timestamp")
    return c.raw().select(
        "job_id", dates.parsed_date(raw).alias("posted_date"), raw.alias("posted_at_raw")
    )


FEATURE_COLUMNS = ["job_id", *salary_model.CATEGORIES, *salary_model.NUMBERS, "label"]


@job("prepare_features", f"SELECT {', '.join(FEATURE_COLUMNS)} FROM features WHERE label > 0")
def _(c: Context) -> DataFrame:
    return salary_model.prepare(c.silver()).select(*FEATURE_COLUMNS)


@job("prepare_features_unlabelled", f"SELECT {', '.join(FEATURE_COLUMNS)} FROM features")
def _(c: Context) -> DataFrame:
    return salary_model.prepare(c.silver(), require_label=False).select(*FEATURE_COLUMNS)


add("mart_projection", lambda c: c.mart().drop("created_at"), f"SELECT {MART_COLUMNS} FROM mart")

CHOICES = {
    "role_category": "Data Engineering",
    "experience_level": "All",
    "city": "All",
    "is_remote": "false",
}
CHOSEN = "role_category = 'Data Engineering' AND NOT is_remote"
CHOSEN_NO_ROLE = "NOT is_remote"
CHOSEN_NO_REMOTE = "role_category = 'Data Engineering'"


@job("wildcard_filter", f"SELECT job_id, role_category, city, is_remote FROM mart WHERE {CHOSEN}")
def _(c: Context) -> DataFrame:
    kept = wildcard.where_selected(c.mart(), CHOICES)
    return kept.select("job_id", "role_category", "city", "is_remote")


@job("wildcard_filter_off", "SELECT job_id, role_category FROM mart")
def _(c: Context) -> DataFrame:
    everything = dict.fromkeys(CHOICES, wildcard.ANY)
    return wildcard.where_selected(c.mart(), everything).select("job_id", "role_category")


TIER = (
    "CASE WHEN skills_count = 0 THEN '0 Skills Listed' "
    "WHEN skills_count <= 2 THEN '1-2 Skills (Low)' WHEN skills_count <= 5 "
    "THEN '3-5 Skills (Medium)' WHEN skills_count <= 10 THEN '6-10 Skills (High)' "
    "ELSE '10+ Skills (Extensive)' END"
)


@job("skill_breadth_tier", f"SELECT job_id, {TIER} AS skill_breadth_tier FROM silver")
def _(c: Context) -> DataFrame:
    tier = warehouse.breadth_tier(F.col("skills_count"))
    return c.silver().select("job_id", tier.alias("skill_breadth_tier"))


@job("workplace_label", "SELECT job_id, CASE WHEN is_remote THEN 'Remote' "
     "ELSE 'Onsite / Hybrid' END AS workplace_type FROM silver")  # fmt: skip
def _(c: Context) -> DataFrame:
    label = dashboards.workplace_label(F.col("is_remote"))
    return c.silver().select("job_id", label.alias("workplace_type"))


@job("inspect_events", "SELECT job_id, concat_ws(' | ', "
     "rpad(coalesce(company_name, 'N/A'), greatest(20, "
     "CAST(length(coalesce(company_name, 'N/A')) AS INTEGER)), ' '), "
     "rpad(substr(title, 1, 30), 30, ' '), rpad(coalesce(nullif(city, ''), 'Remote'), 15, ' '), "
     "rpad(pay, greatest(18, CAST(length(pay) AS INTEGER)), ' '), "
     "'Skills: ' || substr(coalesce(nullif(array_to_string(skills, ', '), ''), 'None'), 1, 30)) "
     "AS line FROM (SELECT *, CASE WHEN salary_min <> 0 AND salary_max <> 0 THEN "
     "concat_ws(' ', salary_currency, CAST(salary_min AS VARCHAR) || '-' || "
     "CAST(salary_max AS VARCHAR)) ELSE 'Unspecified' END AS pay FROM postings)")  # fmt: skip
def _(c: Context) -> DataFrame:
    return bronze.inspect_lines(c.raw())


# --- joins ------------------------------------------------------------------------------------

FACT_KEYS = "job_id, company_key, role_key, location_key, date_key"


@job("join_fact_dims", f"SELECT {FACT_KEYS} FROM fact")
def _(c: Context) -> DataFrame:
    for name in ("dim_company", "dim_job_role", "dim_location"):
        c.table(name)
    stored = c.lakehouse._stored
    rows = gold.foreign_keys(
        c.silver(), stored("dim_company"), stored("dim_job_role"), stored("dim_location")
    )
    return rows.select(*[name.strip() for name in FACT_KEYS.split(",")])


add("join_bridge_skill", lambda c: gold.bridge(c.silver(), c.lakehouse._stored("dim_skill")),
    "SELECT job_id, skill_key FROM bridge")


@job("join_star_2way", "SELECT fact.job_id, role_category, experience_level FROM fact "
     "JOIN dim_job_role USING (role_key)")  # fmt: skip
def _(c: Context) -> DataFrame:
    roles = F.broadcast(c.table("dim_job_role"))
    joined = c.table("fact_job_postings").join(roles, "role_key")
    return joined.select("job_id", "role_category", "experience_level")


@job("join_star_3way", "SELECT fact.job_id, role_category, year, quarter FROM fact "
     "JOIN dim_job_role USING (role_key) JOIN dim_date USING (date_key)")  # fmt: skip
def _(c: Context) -> DataFrame:
    facts = c.table("fact_job_postings").select("job_id", "role_key", "date_key")
    joined = facts.join(F.broadcast(c.table("dim_job_role")), "role_key")
    joined = joined.join(c.table("dim_date"), "date_key")
    return joined.select("job_id", "role_category", "year", "quarter")


@job("join_bridge_3way", "SELECT fact.job_id, skill_name, annual_salary_usd FROM bridge "
     "JOIN dim_skill USING (skill_key) JOIN fact USING (job_id)")  # fmt: skip
def _(c: Context) -> DataFrame:
    facts = c.table("fact_job_postings").select("job_id", "annual_salary_usd")
    joined = c.table("bridge_job_skills").join(facts, "job_id")
    return joined.join(c.table("dim_skill"), "skill_key").drop("skill_key")


@job("join_bridge_4way", "SELECT fact.job_id, skill_name, role_category FROM bridge "
     "JOIN dim_skill USING (skill_key) JOIN fact USING (job_id) "
     "JOIN dim_job_role USING (role_key)")  # fmt: skip
def _(c: Context) -> DataFrame:
    facts = c.table("fact_job_postings").select("job_id", "role_key")
    roles = c.table("dim_job_role").select("role_key", "role_category")
    joined = c.table("bridge_job_skills").join(facts, "job_id")
    joined = joined.join(F.broadcast(roles), "role_key")
    joined = joined.join(c.table("dim_skill"), "skill_key")
    return joined.select("job_id", "skill_name", "role_category")


TOP5 = "SELECT company_key FROM fact GROUP BY 1 ORDER BY count(*) DESC, company_key LIMIT 5"


@job("join_semi_topk", f"SELECT job_id, company_key FROM fact WHERE company_key IN ({TOP5})")
def _(c: Context) -> DataFrame:
    facts = c.table("fact_job_postings")
    sizes = facts.groupBy("company_key").agg(F.count("*").alias("n"))
    leaders = topk.top(sizes, 5, [F.col("n").desc(), F.col("company_key")])
    kept = facts.join(F.broadcast(leaders), "company_key", "left_semi")
    return kept.select("job_id", "company_key")


@job("join_anti_insert", "SELECT job_id, title FROM mart WHERE NOT is_remote")
def _(c: Context) -> DataFrame:
    rows = c.mart().select("job_id", "title", "is_remote")
    return insert.new_rows(rows.drop("is_remote"), rows.filter("is_remote"), ["job_id"])


# --- aggregations -----------------------------------------------------------------------------

PAY = "annual_salary_usd"


def _grouped(name: str, keys: list[str], sql: str, measures: Callable[[], dict]) -> None:
    """Group Silver by some columns. Measures are built on call: columns need a session."""

    def build(c: Context) -> DataFrame:
        columns = [column.alias(alias) for alias, column in measures().items()]
        return c.silver().groupBy(*keys).agg(*columns)

    prefix = "".join(f"{key}, " for key in keys)
    add(name, build, f"SELECT {prefix}{sql} FROM silver{' GROUP BY ALL' if keys else ''}")


_grouped(
    "agg_count",
    ["role_category", "is_remote"],
    "count(annual_salary_usd) AS paid",
    lambda: {"paid": F.count(PAY)},
)
_grouped(
    "agg_count_distinct",
    ["role_category"],
    "count(DISTINCT company_name) AS companies",
    lambda: {"companies": F.count_distinct("company_name")},
)
_grouped(
    "agg_avg_min_max",
    ["company_name"],
    f"{O.mean(PAY)} AS avg_pay, min({PAY}) AS min_pay, max({PAY}) AS max_pay",
    lambda: {"avg_pay": A.mean(PAY), "min_pay": A.lowest(PAY), "max_pay": A.highest(PAY)},
)
_grouped(
    "agg_stddev_spread",
    ["role_category"],
    f"round(stddev_pop({PAY}), 2) AS deviation, round(stddev_samp({PAY}), 2) AS sample, "
    f"round(max({PAY}) - min({PAY}), 2) AS spread",
    lambda: {
        "deviation": A.deviation(PAY),
        "sample": A.deviation(PAY, "sample"),
        "spread": A.spread(PAY),
    },
)
_grouped(
    "agg_conditional_pct",
    ["company_name"],
    f"{O.percent('is_remote')} AS remote_pct",
    lambda: {"remote_pct": A.percent_if(F.col("is_remote"))},
)
_grouped(
    "agg_pct_null_safe",
    ["role_category"],
    f"coalesce({O.percent('is_remote', 1)}, 0) AS remote_pct",
    lambda: {"remote_pct": F.coalesce(A.percent_if(F.col("is_remote"), 1), F.lit(0.0))},
)
_grouped(
    "agg_avg_default",
    ["company_name"],
    f"coalesce({O.mean(PAY, 0)}, 168450) AS avg_pay",
    lambda: {"avg_pay": F.coalesce(A.mean(PAY, 0), F.lit(168450.0))},
)
_grouped(
    "agg_first",
    ["company_name"],
    "arg_min_null(company_domain, job_id) AS company_domain, "
    "arg_min_null(company_industry, job_id) AS company_industry",
    lambda: {
        "company_domain": F.min_by("company_domain", "job_id"),
        "company_industry": F.min_by("company_industry", "job_id"),
    },
)
_grouped(
    "agg_global",
    [],
    f"count(*) AS postings, {O.mean(PAY)} AS avg_pay",
    lambda: {"postings": F.count("*"), "avg_pay": A.mean(PAY)},
)


def delta_sql(remote: str, onsite: str) -> str:
    return (
        f"SELECT role_category, {O.mean(remote)} AS avg_remote_salary, "
        f"{O.mean(onsite)} AS avg_onsite_salary, "
        f"round(avg({remote}) - avg({onsite}), 2) AS remote_salary_delta "
        f"FROM silver WHERE {PAY} IS NOT NULL GROUP BY ALL"
    )


REMOTE_PAY = f"CASE WHEN is_remote THEN {PAY} END"
ONSITE_PAY = f"CASE WHEN NOT is_remote THEN {PAY} END"
add("agg_conditional_avg_delta", lambda c: warehouse.q09_remote_premium(c.table),
    delta_sql(REMOTE_PAY, ONSITE_PAY))


@job("agg_having", "SELECT skill_name, count(*) AS mentions FROM mentions GROUP BY 1 "
     "HAVING count(*) >= 50")  # fmt: skip
def _(c: Context) -> DataFrame:
    counted = gold.skill_mentions(c.silver()).groupBy("skill_name")
    return counted.agg(F.count("*").alias("mentions")).filter("mentions >= 50")


@job("agg_group_by_expr", f"SELECT {TIER} AS tier, count(*) AS jobs FROM silver GROUP BY 1")
def _(c: Context) -> DataFrame:
    tier = warehouse.breadth_tier(F.col("skills_count")).alias("tier")
    return c.silver().groupBy(tier).agg(F.count("*").alias("jobs"))


add("agg_distinct", lambda c: c.silver().select("city_normalized", "is_remote").distinct(),
    "SELECT DISTINCT city_normalized, is_remote FROM silver")
add("agg_latest_metric", lambda c: dashboards.d03_bronze_rows(c.metrics()).drop("recorded_at"),
    "SELECT 'total_bronze_rows' AS metric_name, CAST(count(*) AS DOUBLE) AS value "
    f"FROM ({BRONZE_SQL})")  # fmt: skip
add("dedup_batch", lambda c: silver.deduplicated(silver.identified(c.raw())),
    f"SELECT {', '.join(silver.USED_FIELDS)} FROM latest")

# --- keys and sorts ---------------------------------------------------------------------------

for _name, _table, _columns in (
    ("win_company_key", "dim_company", "company_key, company_name"),
    ("win_role_key", "dim_job_role", "role_key, role_category, experience_level"),
    ("win_location_key", "dim_location", "location_key, city, country, is_remote"),
    ("win_skill_key", "dim_skill", "skill_key, skill_name"),
    ("win_fact_key", "fact_job_postings", "fact_key, job_id, date_key"),
):
    add(
        _name,
        lambda c, table=_table, columns=_columns: c.table(table).select(*columns.split(", ")),
        f"SELECT {_columns} FROM {'fact' if _table == 'fact_job_postings' else _table}",
    )


@job("sort_total", "SELECT role_category, city, experience_level, total_postings FROM "
     "(SELECT role_category, city_normalized AS city, experience_level, count(*) AS "
     "total_postings FROM silver WHERE annual_salary_usd IS NOT NULL GROUP BY ALL) "
     "ORDER BY total_postings DESC, role_category, city, experience_level")  # fmt: skip
def _(c: Context) -> DataFrame:
    name = "gold_salary_by_role_city"
    return gold.in_report_order(name, c.table(name)).select(
        "role_category", "city", "experience_level", "total_postings"
    )


@job("topk", "SELECT job_id, annual_salary_usd FROM silver "
     "ORDER BY annual_salary_usd DESC NULLS LAST, job_id LIMIT 20")  # fmt: skip
def _(c: Context) -> DataFrame:
    pay = c.silver().select("job_id", PAY)
    return topk.top(pay, 20, [F.col(PAY).desc_nulls_last(), F.col("job_id")])


@job("latest_n", "SELECT job_id, posted_date FROM silver "
     "ORDER BY posted_date DESC NULLS LAST, job_id LIMIT 20")  # fmt: skip
def _(c: Context) -> DataFrame:
    dated = c.silver().select("job_id", "posted_date")
    return topk.top(dated, 20, [F.col("posted_date").desc_nulls_last(), F.col("job_id")])


add("sample_rows", lambda c: topk.top(c.silver().select("job_id", "title"), 5, [F.col("job_id")]),
    "SELECT job_id, title FROM silver ORDER BY job_id LIMIT 5")

# --- streaming --------------------------------------------------------------------------------


def _event_stream(c: Context) -> DataFrame:
    """The event table as a stream, with its JSON property parsed and a zoned timestamp."""
    table = c.source("events")
    stream = (
        c.spark.readStream.schema(table.schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(c.sf_dir)
    )
    return stream.select(
        "event_id",
        "user_id",
        F.col("ts").cast("timestamp").alias("ts"),
        "event_type",
        F.from_json("props", "k int").getField("k").alias("k"),
    )


@job("stream_watermark", "WITH e AS (SELECT *, time_bucket(INTERVAL 1 HOUR, ts) AS hour FROM events) "
     "SELECT event_type, count(*) AS events, "
     "sum(CAST(json_extract(props, '$.k') AS INTEGER))::BIGINT AS k FROM e "
     "WHERE hour + INTERVAL 1 HOUR <= (SELECT max(date_trunc('millisecond', ts)) - INTERVAL 10 MINUTE FROM e) "
     "GROUP BY event_type")  # fmt: skip
def _(c: Context) -> DataFrame:
    """Hourly sums in append mode: an hour comes out once the watermark has passed its end."""
    hourly = (
        _event_stream(c)
        .withWatermark("ts", bronze.LATENESS)
        .groupBy(F.window("ts", "1 hour"), "event_type")
        .agg(F.count("*").alias("events"), F.sum("k").alias("k"))
        .select("event_type", "events", "k")
    )
    closed = c.streamed("watermark", hourly).groupBy("event_type")
    return closed.agg(F.sum("events").alias("events"), F.sum("k").alias("k"))


@job("stream_dedup", "SELECT DISTINCT event_id FROM events")
def _(c: Context) -> DataFrame:
    kept = bronze.deduplicate(_event_stream(c), keys=("event_id",), event_time="ts")
    return c.streamed("dedup", kept.select("event_id"))


@job("stream_dedup_repeats", "SELECT DISTINCT user_id FROM events")
def _(c: Context) -> DataFrame:
    kept = bronze.deduplicate(_event_stream(c), keys=("user_id",), event_time="ts")
    return c.streamed("dedup", kept.select("user_id"))


@job("stream_dedup_windowed", f"SELECT landed.*, stamps, true AS within FROM ({BRONZE_SQL}) landed JOIN "
     "(SELECT job_id, count(DISTINCT coalesce(ingestion_timestamp, '')) AS stamps FROM postings "
     "WHERE trim(job_id) <> '' AND trim(title) <> '' GROUP BY job_id) s ON s.job_id = landed.job_id")  # fmt: skip
def _(c: Context) -> DataFrame:
    """What landed, each row once. An id may pass again once it is forgotten, but not more often than
    it has stamps: repeats under one stamp, of which there are many, pass once.
    """
    return within_stamps(bronze.validate(bronze.parse(c.messages())), c.bronze_table("windowed"))


def within_stamps(valid: DataFrame, table: DataFrame) -> DataFrame:
    """The rows of a Bronze table, and whether their ids passed as often as the messages allow."""
    stamp = F.coalesce("ingestion_timestamp", F.lit(""))
    stamps = valid.groupBy("job_id").agg(F.count_distinct(stamp).alias("stamps"))
    passed = table.groupBy("job_id").agg(F.count("*").alias("passed"))
    landed = table.select(*BRONZE_COLUMNS).distinct()
    return landed.join(stamps, "job_id").join(passed, "job_id").select(
        *BRONZE_COLUMNS, "stamps", F.col("passed").between(1, F.col("stamps")).alias("within")
    )


@job("stream_dedup_salted", BRONZE_SQL)
def _(c: Context) -> DataFrame:
    return c.bronze_table("global", salts=8).select(*BRONZE_COLUMNS)


@job("stream_rate_limit", "SELECT event_id % 4 AS file, count(*) AS rows, 1 AS batches "
     "FROM events GROUP BY ALL")  # fmt: skip
def _(c: Context) -> DataFrame:
    """The events land in four parts of many files; read at that pace, each batch is one part."""
    landed = fresh_folder(c.spark, "paced")
    rows = c.source("events").select("event_id")
    for number in range(4):
        c.land(rows.filter(F.col("event_id") % 4 == number), landed)
    paced = c.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", FILES).parquet(landed)
    # the clock of a batch is the same in all of its rows
    timed = paced.withColumn("batch", F.current_timestamp())
    return c.streamed("paced-out", timed).groupBy((F.col("event_id") % 4).alias("file")).agg(
        F.count("*").alias("rows"), F.count_distinct("batch").cast("int").alias("batches")
    )


@job("stream_supervise", "SELECT 'strict' AS name, 'failed' AS state, CAST(NULL AS BIGINT) AS rows, "
     "max(event_id) AS stopped_at FROM events UNION ALL "
     "SELECT 'steady', 'stopped', count(*), NULL FROM events")  # fmt: skip
def _(c: Context) -> DataFrame:
    """One query reads all events and waits for more; another dies of the last event's id, and the
    first is stopped.
    """
    last = c.source("events").agg(F.max("event_id")).first()[0]
    watcher = states.watch(c.spark)
    steady = _triggered(c, _event_stream(c).select("event_id"), "steady", processingTime="1 second")
    steady.processAllAvailable()
    refused = F.when(F.col("event_id") == last, F.raise_error(F.concat(F.lit("refused:"), "event_id")).cast("bigint"))
    strict = _event_stream(c).select(F.coalesce(refused, "event_id").alias("event_id"))
    strict = _triggered(c, strict, "strict", availableNow=True)
    found = states.supervise(c.spark, watcher, [steady, strict])
    c.spark.streams.removeListener(watcher)
    stopped_at = F.nullif(F.regexp_extract("error", "refused:([0-9]+)", 1), F.lit("")).cast("bigint")
    ended = F.col("state") == states.STOPPED
    return found.select("name", "state", F.when(ended, F.col("rows")).alias("rows"), stopped_at.alias("stopped_at"))


@job("stream_trigger", "SELECT 'finished' AS state, count(*) AS rows, count(*) AS landed FROM events "
     "UNION ALL SELECT 'stopped', count(*), count(*) FROM events")  # fmt: skip
def _(c: Context) -> DataFrame:
    """The same events under both triggers: one takes what is there and ends, one waits for more."""
    parts, watcher = [], states.watch(c.spark)
    for name, pace in (("once", {"availableNow": True}), ("paced", {"processingTime": "1 second"})):
        out = fresh_folder(c.spark, name)
        query = _triggered(c, _event_stream(c).select("event_id"), name, out, **pace)
        if name == "once":
            query.awaitTermination()
        else:
            query.processAllAvailable()
            watcher.stop(query)
        watcher.wait(query)
        parts.append(c.spark.read.schema("event_id bigint").parquet(out).agg(F.lit(name).alias("name"), F.count("*").alias("landed")))
    c.spark.streams.removeListener(watcher)
    found = watcher.table(c.spark).join(parts[0].unionByName(parts[1]), "name")
    return found.select("state", "rows", "landed")


def _triggered(c: Context, rows: DataFrame, name: str, out: str | None = None, **pace):
    writer = rows.writeStream.format("parquet").option("path", out or fresh_folder(c.spark, name))
    writer = writer.option("checkpointLocation", fresh_folder(c.spark, "checkpoint"))
    return writer.queryName(name).trigger(**pace).start()


@job("stream_checkpoint", BRONZE_SQL)
def _(c: Context) -> DataFrame:
    """A second run on the same checkpoint finds nothing new and adds nothing."""
    path, checkpoint = fresh_folder(c.spark, "bronze"), fresh_folder(c.spark, "checkpoint")
    for _ in range(2):
        stream = bronze.process(events.from_files(c.spark, c.landed_messages(), FILES))
        bronze.start(stream, path, checkpoint, trigger=None, name="restarted").awaitTermination()
    return lake.read_bronze(c.spark, path).select(*BRONZE_COLUMNS)


add("stream_bronze_job", lambda c: c.bronze_table().select(*BRONZE_COLUMNS), BRONZE_SQL)
TOTALS = [dashboards.BRONZE_ROWS, dashboards.FAILED, metrics.LATE_ROWS]
add("stream_metrics", lambda c: c.metrics().filter(F.col("metric_name").isin(TOTALS))
    .groupBy("metric_name").agg(F.max("value").alias("total")),
    "SELECT 'total_bronze_rows' AS metric_name, CAST(count(*) AS DOUBLE) AS total "
    f"FROM ({BRONZE_SQL}) UNION ALL SELECT 'late_rows', 0 UNION ALL "
    "SELECT 'failed_records', count(*) + (SELECT count(*) FROM orders WHERE o_orderkey % 500 = 0) "
    "FROM postings WHERE coalesce(trim(job_id), '') = '' OR coalesce(trim(title), '') = ''")  # fmt: skip


LATE_SQL = """
WITH e AS (SELECT event_id, ts, ntile(2) OVER (ORDER BY ts, event_id) = 2 AS newer FROM events),
m AS (SELECT max(date_trunc('millisecond', ts)) - INTERVAL 10 MINUTE AS mark FROM e WHERE newer)
SELECT event_id, newer OR ts > mark AS landed FROM e, m"""


@job("stream_late_data", LATE_SQL)
def _(c: Context) -> DataFrame:
    """The newer half of the events, then the older half on the same checkpoint.

    Older events that the watermark has passed are dropped; ``landed`` tells which.
    """
    source, out = fresh_folder(c.spark, "late"), fresh_folder(c.spark, "late-out")
    checkpoint = fresh_folder(c.spark, "checkpoint")
    events_table = c.source("events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    # exact ranks without gathering the table in one task; the older half has the odd one
    ranked = dense_key(events_table, "place", [F.col("ts").asc_nulls_first(), F.col("event_id")])
    n = events_table.count()
    halves = ranked.withColumn("half", F.when(F.col("place") > n - n // 2, 2).otherwise(1)).drop("place")
    for half in (2, 1):
        rows = halves.filter(F.col("half") == half).drop("half")
        rows.write.mode("append").parquet(source)
        stream = c.spark.readStream.schema(rows.schema).parquet(source)
        kept = bronze.deduplicate(stream, keys=("event_id",), event_time="ts")
        query = (
            kept.writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    landed = c.spark.read.schema(rows.schema).parquet(out).select("event_id")
    landed = landed.withColumn("landed", F.lit(True))
    return events_table.join(landed, "event_id", "left").select(
        "event_id", F.coalesce("landed", F.lit(False)).alias("landed")
    )

# --- Gold, warehouse, dashboards --------------------------------------------------------------

for _name in ("dim_company", "dim_job_role", "dim_location", "dim_date", "dim_skill"):
    _fields = ", ".join(schemas.GOLD[_name].fieldNames())
    add(f"gold_{_name}", lambda c, name=_name: c.table(name), f"SELECT {_fields} FROM {_name}")
add("gold_fact_job_postings", lambda c: c.table("fact_job_postings"), "SELECT * FROM fact")
add("gold_bridge_job_skills", lambda c: c.table("bridge_job_skills"), "SELECT * FROM bridge")

AGGREGATES = {
    "gold_top_skills": "SELECT skill_name, count(*) AS posting_count, "
    f"{O.mean(PAY)} AS avg_salary_usd, {O.percent('is_remote')} AS remote_percentage "
    "FROM mentions GROUP BY 1",
    "gold_salary_by_role_city": "SELECT role_category, city_normalized AS city, "
    f"experience_level, count(*) AS total_postings, {O.mean(PAY)} AS avg_annual_salary, "
    f"min({PAY}) AS min_annual_salary, max({PAY}) AS max_annual_salary "
    f"FROM silver WHERE {PAY} IS NOT NULL GROUP BY ALL",
    "gold_remote_trends": "SELECT role_category, is_remote, count(*) AS total_jobs, "
    f"{O.mean(PAY)} AS avg_salary, {O.mean_int('skills_count', 2)} AS avg_skills_required "
    "FROM silver GROUP BY ALL",
    "gold_company_hiring": "SELECT company_name, company_industry, count(*) AS open_positions, "
    f"{O.mean(PAY)} AS avg_offered_salary, {O.percent('is_remote')} AS pct_remote "
    "FROM silver GROUP BY ALL",
}
for _name, _sql in AGGREGATES.items():
    add(_name, lambda c, name=_name: gold.in_report_order(name, c.table(name)), _sql)


# Each table with its name in the oracle and a sum that depends on keys and contents of its rows.
CONTENTS = {
    "silver": ("silver", "sum(length(job_id) * (skills_count + 1))"),
    "fact_job_postings": (
        "fact", "sum(fact_key * (company_key + 3 * role_key + 5 * location_key) + date_key)"
    ),
    "bridge_job_skills": ("bridge", "sum(length(job_id) * skill_key)"),
    "dim_company": ("dim_company", "sum(company_key * (length(company_name) + total_jobs_posted))"),
    "dim_job_role": ("dim_job_role", "sum(role_key * length(role_category))"),
    "dim_location": ("dim_location", "sum(location_key * length(city))"),
    "dim_date": ("dim_date", "sum(date_key * length(day_name))"),
    "dim_skill": ("dim_skill", "sum(skill_key * length(skill_name))"),
}


def contents(total: str) -> Column:
    """A sum of CONTENTS as a checksum: exact, and beyond a bigint its remainder by 2^63 instead of an error."""
    exact = F.expr(f"sum(CAST({total.removeprefix('sum')} AS DECIMAL(28,0)))")
    return (exact % F.lit(str(2**63)).cast("decimal(20,0)")).cast("bigint")


@job("job_medallion", " UNION ALL ".join(
     f"SELECT '{name}' AS name, count(*) AS rows, CAST({total} AS BIGINT) AS contents FROM {source}"
     for name, (source, total) in CONTENTS.items()))
def _(c: Context) -> DataFrame:
    root = fresh_folder(c.spark, "medallion")
    built = medallion.run(medallion.Lakehouse(c.spark, root, raw=c.raw))
    parts = [
        built[name].agg(
            F.lit(name).alias("name"),
            F.count("*").alias("rows"),
            contents(total).alias("contents"),
        )
        for name, (_, total) in CONTENTS.items()
    ]
    return reduce(DataFrame.unionByName, parts)


# --- versions and increments ------------------------------------------------------------------


class Killed(RuntimeError):
    pass


@job("publish_killed_build", "SELECT fact_key, job_id, company_key, location_key, title FROM fact")
def _(c: Context) -> DataFrame:
    """A second build dies when Silver and a part of Gold are written: readers see the first, whole."""
    store = Store(c.spark, fresh_folder(c.spark, "published"))
    medallion.build_version(store, c.raw)
    draft = store.draft()
    try:
        second = medallion.Lakehouse(
            c.spark, f"{store.root}/{medallion.BUILDS}/{draft.run}", lambda: c.raw().filter("is_remote")
        )
        medallion.run(second, "bronze-to-silver")
        for name in ("dim_company", "gold_remote_trends"):
            draft.put(name, f"{medallion.BUILDS}/{draft.run}/{name}")
            second.table(name)
        raise Killed
    except Killed:
        pass
    facts = medallion.opened(store).table("fact_job_postings")
    return facts.select("fact_key", "job_id", "company_key", "location_key", "title")


SOME = "url LIKE '%5'"


@job("publish_switch", "SELECT 'held' AS reader, company_name, total_jobs_posted FROM dim_company "
     "UNION ALL SELECT 'new', company_name, count(*) FROM "
     f"({O.silver_of(SOME)}) GROUP BY ALL")  # fmt: skip
def _(c: Context) -> DataFrame:
    """A reader goes on with the version it opened; one that comes later sees the next, whole."""
    store = Store(c.spark, fresh_folder(c.spark, "published"))
    medallion.build_version(store, c.raw)
    held = medallion.opened(store)
    medallion.build_version(store, lambda: c.raw().filter(SOME))
    new = medallion.opened(store)
    shown = [
        tables.table("dim_company").select(F.lit(reader).alias("reader"), "company_name", "total_jobs_posted")
        for reader, tables in (("held", held), ("new", new))
    ]
    return shown[0].unionByName(shown[1])


add("silver_increments", lambda c: c.live().table("silver"), f"SELECT {SILVER_COLUMNS} FROM silver")
for _name in upkeep.KEPT:
    _fields = [f for f in schemas.GOLD[_name].fieldNames() if f != upkeep.KEPT[_name].key_map]
    add(
        f"{_name if _name.startswith('gold') else 'gold_' + _name}_increments",
        lambda c, name=_name, fields=tuple(_fields): c.live().table(name).select(*fields),
        AGGREGATES.get(_name, f"SELECT {', '.join(_fields)} FROM {_name}"),
    )
for _key, (_, _names) in upkeep.NAMES.items():
    _of = "{silver}" if _key != "skill_key" else O.MENTIONS.replace("FROM silver", "FROM ({silver})")
    add(
        f"win_{_key}_stable",
        lambda c, key=_key: c.live().table(key),
        O.keys_by_arrival(_key, _names, _of),
    )


@job("gold_fact_increments", "SELECT job_id, company_name, city_normalized AS city, role_category, "
     "experience_level, annual_salary_usd, is_remote FROM silver")  # fmt: skip
def _(c: Context) -> DataFrame:
    """The facts through their keys, which other increments gave out."""
    table = c.live().table
    facts = table("fact_job_postings").join(table("company_key"), "company_key")
    facts = facts.join(table("dim_location").drop("is_remote"), "location_key")
    facts = facts.join(F.broadcast(table("dim_job_role")), "role_key")
    return facts.select(
        "job_id", "company_name", "city", "role_category", "experience_level", PAY, "is_remote"
    )


@job("gold_bridge_increments", "SELECT job_id, skill_name FROM mentions")
def _(c: Context) -> DataFrame:
    pairs = c.live().table("bridge_job_skills")
    return pairs.join(c.live().table("dim_skill"), "skill_key").select("job_id", "skill_name")


@job("gold_fact_key_increments", "SELECT count(*) AS facts, count(*) AS keys, "
     "CAST(1 AS BIGINT) AS lowest, count(*) AS highest FROM silver")  # fmt: skip
def _(c: Context) -> DataFrame:
    """Fact keys are dense and unique after any number of increments."""
    key = F.col("fact_key")
    return c.live().table("fact_job_postings").agg(
        F.count("*").alias("facts"), F.count_distinct(key).alias("keys"),
        F.min(key).alias("lowest"), F.max(key).alias("highest"),
    )


PAID = f"{PAY} IS NOT NULL"
AVG, LOW, HIGH = O.mean(PAY), f"round(min({PAY}), 2)", f"round(max({PAY}), 2)"
SHARE = O.percent("is_remote")
ONE_INDUSTRY = (
    "(SELECT s.job_id, s.company_name, d.company_industry, s.annual_salary_usd, s.is_remote, "
    "s.experience_level FROM silver s JOIN dim_company d ON d.company_name = s.company_name)"
)
WAREHOUSE_SQL = {
    "q01_kpi": f"SELECT count(*) AS total_job_postings, {AVG} AS avg_annual_salary_usd, "
    f"count(DISTINCT company_name) AS total_hiring_companies, {SHARE} AS overall_remote_pct "
    "FROM silver",
    "q02_top_skills": f"SELECT skill_name, count(*) AS total_mentions, {AVG} AS "
    f"avg_salary_with_skill, {SHARE} AS remote_pct FROM mentions GROUP BY 1 "
    "ORDER BY 2 DESC, 1 LIMIT 15",
    "q03_paying_skills": f"SELECT skill_name, count(*) AS sample_size, {AVG} AS avg_salary_usd, "
    f"{LOW} AS min_salary_usd, {HIGH} AS max_salary_usd FROM mentions WHERE {PAID} GROUP BY 1 "
    "HAVING count(*) >= 50 ORDER BY 3 DESC, 1 LIMIT 15",
    "q04_role_benchmark": f"SELECT role_category, count(*) AS total_openings, {AVG} AS "
    f"avg_salary_usd, {LOW} AS min_salary_usd, {HIGH} AS max_salary_usd FROM silver "
    f"WHERE {PAID} GROUP BY 1",
    "q05_seniority": f"SELECT experience_level, count(*) AS role_count, {AVG} AS avg_salary_usd, "
    f"{O.mean_int('skills_count', 1)} AS avg_skills_required FROM silver WHERE {PAID} GROUP BY 1",
    "q06_hubs": "SELECT city_normalized AS city, country_normalized AS country, "
    f"count(*) AS total_jobs, {AVG} AS avg_salary_usd, {SHARE} AS remote_pct FROM silver "
    "WHERE city_normalized NOT IN ('Remote', 'Unspecified') GROUP BY ALL "
    "ORDER BY 3 DESC, 1, 2 LIMIT 10",
    "q07_remote_by_role": "SELECT role_category, count(*) FILTER (is_remote) AS remote_jobs, "
    f"count(*) FILTER (NOT is_remote) AS onsite_jobs, {SHARE} AS remote_pct FROM silver "
    "GROUP BY 1",
    "q08_companies": "SELECT company_name, company_industry, count(*) AS active_postings, "
    f"{AVG} AS avg_salary_usd, {SHARE} AS remote_friendly_pct FROM {ONE_INDUSTRY} GROUP BY ALL "
    "ORDER BY 3 DESC, 1 LIMIT 20",
    "q09_remote_premium": delta_sql(REMOTE_PAY, ONSITE_PAY),
    "q10_monthly": "SELECT CAST(year(posted_date) AS INTEGER) AS year, "
    "CAST(month(posted_date) AS INTEGER) AS month, monthname(posted_date) AS month_name, "
    f"count(*) AS total_postings, {AVG} AS avg_salary_usd FROM silver "
    "WHERE year(posted_date) > 2000 GROUP BY ALL",
    "q11_data_skills": f"SELECT role_category, skill_name, count(*) AS skill_demand_count, {AVG} "
    "AS avg_salary FROM mentions WHERE role_category IN ('Data Engineering', "
    "'Data Science & AI') GROUP BY ALL ORDER BY 1, 3 DESC, 2 LIMIT 20",
    "q12_high_remote": f"SELECT role_category, count(*) AS high_paying_remote_jobs, {AVG} AS "
    f"avg_salary_usd FROM silver WHERE is_remote AND {PAY} >= 150000 GROUP BY 1",
    "q13_top5_levels": "SELECT company_name, experience_level, count(*) AS total_jobs FROM silver "
    "WHERE company_name IN (SELECT company_name FROM silver GROUP BY 1 "
    "ORDER BY count(*) DESC, 1 LIMIT 5) GROUP BY ALL",
    "q14_remote_skills": f"SELECT skill_name, count(*) AS total_postings, {SHARE} AS "
    "remote_percentage FROM mentions GROUP BY 1 HAVING count(*) >= 30 ORDER BY 3 DESC, 1 LIMIT 15",
    "q15_quarterly": "SELECT CAST(year(posted_date) AS INTEGER) AS year, "
    "CAST(quarter(posted_date) AS INTEGER) AS quarter, role_category, "
    "count(*) AS quarterly_openings FROM silver WHERE year(posted_date) > 2000 GROUP BY ALL",
    "q16_skill_breadth": f"SELECT {TIER} AS skill_breadth_tier, count(*) AS job_count, {AVG} AS "
    f"avg_annual_salary FROM silver WHERE {PAID} GROUP BY 1",
    "q17_industry": f"SELECT company_industry, count(*) AS total_jobs, {AVG} AS avg_salary_usd "
    f"FROM {ONE_INDUSTRY} WHERE {PAID} AND company_industry IS NOT NULL GROUP BY 1 "
    "ORDER BY 3 DESC, 1 LIMIT 15",
    "q18_dispersion": f"SELECT role_category, {AVG} AS avg_salary, round(max({PAY}) - min({PAY}), "
    f"2) AS salary_spread, round(stddev_pop({PAY}), 2) AS salary_std_dev FROM silver "
    f"WHERE {PAID} GROUP BY 1",
    "q19_employment": f"SELECT employment_type, count(*) AS posting_count, {AVG} AS "
    f"avg_salary_usd, {SHARE} AS remote_pct FROM silver GROUP BY 1",
    "q20_leadership": "SELECT city_normalized AS city, role_category, count(*) AS "
    f"leadership_openings, {AVG} AS avg_leadership_salary FROM silver "
    "WHERE experience_level = 'Lead / Principal' AND city_normalized <> 'Remote' GROUP BY ALL "
    "ORDER BY 3 DESC, 1, 2 LIMIT 15",
}
for _name, _query in warehouse.QUERIES.items():
    add(_name, lambda c, query=_query: query(c.table), WAREHOUSE_SQL[_name])

add("d01_ingest_rate", lambda c: dashboards.d01_ingest_rate(c.metrics()).select("metric_name",
    F.col("value").between(0, 1e12).alias("a_rate")),
    "SELECT 'kafka_ingestion_rate' AS metric_name, true AS a_rate")
EARLY = "2002-01-01 01:00:00"


@job("d02_lag", "SELECT 'consumer_lag' AS metric_name, CAST(count(*) + (SELECT count(*) FROM orders "
     f"WHERE o_orderkey % 500 = 0 AND o_orderdate >= TIMESTAMP '{EARLY}') AS DOUBLE) AS value "
     f"FROM postings WHERE {STAMP} >= TIMESTAMP '{EARLY}'")  # fmt: skip
def _(c: Context) -> DataFrame:
    """Messages land while no query runs: the lag is what the last run has not read."""
    source, series = fresh_folder(c.spark, "lagging"), fresh_folder(c.spark, "metrics")
    early = F.col("timestamp") < F.lit(EARLY).cast("timestamp")
    c.land(c.messages().filter(early), source)
    recorder = metrics.record(c.spark, series, "lagging")
    stream = bronze.process(events.from_files(c.spark, source))
    query = bronze.start(stream, fresh_folder(c.spark, "bronze"), fresh_folder(c.spark, "checkpoint"), None, "lagging")
    query.awaitTermination()
    recorder.wait(query)
    c.spark.streams.removeListener(recorder)
    c.land(c.messages().filter(~early), source)
    reports = c.spark.read.schema(schemas.REPORT).parquet(series)
    lag = metrics.backlog(reports, c.spark.read.schema(schemas.ENVELOPE).parquet(source))
    return dashboards.d02_lag(lag).drop("recorded_at")


add("d03_bronze_rows", lambda c: dashboards.d03_bronze_rows(c.metrics()).drop("recorded_at"),
    "SELECT 'total_bronze_rows' AS metric_name, CAST(count(*) AS DOUBLE) AS value "
    f"FROM ({BRONZE_SQL})")  # fmt: skip


@job("d04_batch_duration", "SELECT true AS one_per_batch, true AS all_positive, true AS within_the_run")
def _(c: Context) -> DataFrame:
    """Every batch has a duration, and together they fit between the first report and the last."""
    shown = dashboards.d04_batch_duration(c.metrics())
    batches = c.metrics().filter(F.col("metric_name") == dashboards.BRONZE_ROWS).count()
    span = F.unix_millis(F.max("recorded_at")) - F.unix_millis(F.min("recorded_at"))
    return shown.agg(
        (F.count("*") == batches).alias("one_per_batch"),
        F.bool_and(F.col("batch_duration_ms") > 0).alias("all_positive"),
        # reports carry the start of their batch, so all durations but the last lie between them
        (F.sum("batch_duration_ms") - F.max_by("batch_duration_ms", "recorded_at") <= span + 1000).alias("within_the_run"),
    )


add("d05_failed", lambda c: dashboards.d05_failed(c.metrics()).drop("recorded_at"),
    "SELECT 'failed_records' AS metric_name, CAST(count(*) + (SELECT count(*) FROM orders "
    "WHERE o_orderkey % 500 = 0) AS DOUBLE) AS value FROM postings "
    "WHERE coalesce(trim(job_id), '') = '' OR coalesce(trim(title), '') = ''")  # fmt: skip

PANELS = {
    "d11_total": (dashboards.d11_total,
        f"SELECT CAST(count(*) AS DOUBLE) AS value FROM mart WHERE {CHOSEN}"),
    "d12_avg_salary": (dashboards.d12_avg_salary,
        f"SELECT coalesce({O.mean(PAY, 0)}, 0) AS value FROM mart WHERE {CHOSEN}"),
    "d13_remote_rate": (dashboards.d13_remote_rate,
        f"SELECT coalesce({O.percent('is_remote', 1)}, 0) AS value FROM mart WHERE {CHOSEN}"),
    "d14_companies": (dashboards.d14_companies,
        f"SELECT CAST(count(DISTINCT company_name) AS DOUBLE) AS value FROM mart WHERE {CHOSEN}"),
    "d15_top_primary_skills": (dashboards.d15_top_primary_skills,
        f"SELECT primary_skill AS skill, count(*) AS postings FROM mart WHERE {CHOSEN} "
        "GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"),
    "d16_role_salary": (dashboards.d16_role_salary,
        f"SELECT role_category, {O.mean(PAY, 0)} AS avg_salary FROM mart WHERE {PAID} AND "
        f"{CHOSEN_NO_ROLE} GROUP BY 1"),
    "d17_workplace_split": (dashboards.d17_workplace_split,
        "SELECT CASE WHEN is_remote THEN 'Remote' ELSE 'Onsite / Hybrid' END AS workplace_type, "
        f"count(*) AS total_jobs FROM mart WHERE {CHOSEN_NO_REMOTE} GROUP BY 1"),
    "d18_hiring_velocity": (dashboards.d18_hiring_velocity,
        "SELECT CAST(date_trunc('month', posted_date) AS DATE) AS month, count(*) AS "
        f"total_postings FROM mart WHERE posted_date IS NOT NULL AND {CHOSEN} GROUP BY 1"),
    "d31_filtered_salary": (dashboards.d31_filtered_salary,
        f"SELECT coalesce({O.mean(PAY, 0)}, 168450) AS value FROM mart WHERE {CHOSEN_NO_REMOTE}"),
}
for _name, (_panel, _sql) in PANELS.items():
    add(_name, lambda c, panel=_panel: panel(c.mart(), CHOICES), _sql)


CUBE = "role_category, city, is_remote"


@job("d14_companies_sketched", f"SELECT {CUBE}, count(DISTINCT company_name) AS companies, true AS within "
     f"FROM mart GROUP BY CUBE ({CUBE})")  # fmt: skip
def _(c: Context) -> DataFrame:
    """Every choice of filters: the exact number, and whether the union of stored sketches is as near
    as its error allows.
    """
    stored = lake.overwrite(sketches.sketched(c.mart()), fresh_folder(c.spark, "sketches"))
    names = CUBE.split(", ")
    place = F.grouping_id().alias("place")
    exact = c.mart().cube(*names).agg(place, F.count_distinct("company_name").alias("companies"))
    guess = stored.cube(*names).agg(place, sketches.merged().alias("estimate"))
    same = [exact[n].eqNullSafe(guess[n]) for n in (*names, "place")]
    near = F.abs(F.col("estimate") - F.col("companies")) <= F.greatest(F.lit(1.0), F.col("companies") * sketches.error())
    return exact.join(guess, same, "left").select(*(exact[n] for n in names), "companies", F.coalesce(near, F.lit(False)).alias("within"))


@job("sink_metric_store", "SELECT 'total_bronze_rows' AS metric_name, CAST(count(*) AS DOUBLE) AS total, "
     f"true AS kept_in_few FROM ({BRONZE_SQL})")  # fmt: skip
def _(c: Context) -> DataFrame:
    """Two runs of one query into one store by tiers of two; the first days folded: the total stays."""
    root, source = fresh_folder(c.spark, "metric-store"), c.landed_messages()
    path, checkpoint = fresh_folder(c.spark, "bronze"), fresh_folder(c.spark, "checkpoint")
    for _ in range(2):
        recorder = metric_store.record(c.spark, root, "stored", fan=2)
        stream = bronze.process(events.from_files(c.spark, source, FILES))
        query = bronze.start(stream, path, checkpoint, trigger=None, name="stored")
        query.awaitTermination()
        recorder.wait(query)
        c.spark.streams.removeListener(recorder)
    store = metric_store.MetricStore(c.spark, root, 2)
    reports = store.read().count()
    files = len(store.read().inputFiles())
    store.fold_before("2100-01-01")
    few = files <= reports.bit_length() and store.read().count() == 1
    found = metric_store.series(c.spark, root).filter(F.col("metric_name") == dashboards.BRONZE_ROWS)
    return found.groupBy("metric_name").agg(F.max("value").alias("total")).withColumn("kept_in_few", F.lit(few))


@job("d33_recent_predictions", "SELECT job_id AS prediction_id, role_category, experience_level, "
     "city_normalized AS city, is_remote FROM silver ORDER BY job_id LIMIT 20")  # fmt: skip
def _(c: Context) -> DataFrame:
    """All predictions of a batch have one time, so the newest are those with the lowest ids."""
    predictions = c.predictions()
    shown = dashboards.d33_recent_predictions(predictions)
    columns = [n for n in shown.columns if n != "prediction_timestamp"]
    newest = topk.top(predictions, 20, [F.col("prediction_timestamp").desc(), F.col("prediction_id")])
    found = newest.join(shown.select(*columns).distinct(), columns, "left_semi")
    return found.select("prediction_id", "role_category", "experience_level", "city", "is_remote")



# --- machine learning -------------------------------------------------------------------------


def _prepared(c: Context) -> DataFrame:
    return salary_model.prepare(c.silver())


def _evaluation(c: Context) -> DataFrame:
    _, test_rows = salary_model.split(_prepared(c))
    return salary_model.evaluate(c.model().transform(test_rows))


def _table_evaluation(c: Context) -> dict[str, float]:
    """RMSE, R2 and MAE of the scores by the trees as a table, by SQL."""
    _, test_rows = salary_model.split(_prepared(c))
    scored = c.scored_by_table(test_rows).select("label", F.col("table_prediction").alias("p"))
    return c.spark.sql(
        "SELECT sqrt(avg(pow(label - p, 2))) AS rmse_usd, avg(abs(label - p)) AS mae_usd, "
        "1 - sum(pow(label - p, 2)) / regr_syy(label, p) AS r2_score FROM {t}", t=scored
    ).first().asDict()


@job("ml_index", "SELECT job_id, CAST(place AS DOUBLE) AS role_category_idx FROM features "
     "JOIN (SELECT role_category, row_number() OVER (ORDER BY count(*) DESC, role_category) - 1 "
     "AS place FROM features WHERE label > 0 GROUP BY 1) USING (role_category) "
     "WHERE label > 0")  # fmt: skip
def _(c: Context) -> DataFrame:
    prepared = _prepared(c)
    indexer = salary_model.stages()[0].fit(prepared)
    return indexer.transform(prepared).select("job_id", "role_category_idx")


def _features(c: Context) -> DataFrame:
    prepared = _prepared(c)
    return salary_model.pipeline().fit(prepared).transform(prepared)


PLACES = (
    "(SELECT role_category, row_number() OVER (ORDER BY count(*) DESC, role_category) - 1 AS place, "
    "count(*) OVER () AS n FROM features WHERE label > 0 GROUP BY 1)"
)
# Each column has a slot per value and one for values unseen in training; two numbers follow.
WIDTH = " + ".join(f"count(DISTINCT {name}) + 1" for name in salary_model.CATEGORIES) + " + 2"
VECTORS = (
    f"SELECT job_id, label, CAST(width AS INTEGER) AS width, CAST({len(salary_model.CATEGORIES)} + "
    "(is_remote_double <> 0)::INTEGER + (skills_count_double <> 0)::INTEGER AS INTEGER) AS non_zero, "
    "is_remote_double + skills_count_double AS numbers "
    f"FROM features, (SELECT {WIDTH} AS width FROM features WHERE label > 0) WHERE label > 0"
)


@job("ml_onehot", "SELECT job_id, list_transform(range(0, n + 1), lambda i: "
     "CASE WHEN i = place THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS role_category_vec "
     f"FROM features JOIN {PLACES} USING (role_category) WHERE label > 0")  # fmt: skip
def _(c: Context) -> DataFrame:
    vector = vector_to_array("role_category_vec").alias("role_category_vec")
    return _features(c).select("job_id", vector)


def _described(rows: DataFrame, *columns: str) -> DataFrame:
    """Width, filled slots and the sum of the two numbers of each feature vector."""
    vector = vector_to_array("features")
    filled = F.size(F.filter(vector, lambda x: x != 0)).alias("non_zero")
    numbers = F.element_at(vector, -1) + F.element_at(vector, -2)
    return rows.select(*columns, F.size(vector).alias("width"), filled, numbers.alias("numbers"))


add("ml_assemble", lambda c: _described(_features(c), "job_id"),
    f"SELECT job_id, width, non_zero, numbers FROM ({VECTORS})")
add("ml_pipeline", lambda c: _described(_features(c), "job_id", "label"), VECTORS)


FEW_SLOTS = 16
SLOTTED = ", ".join(
    f"'#' || CAST(('0x' || substr(md5({name}), 1, 8))::BIGINT % {FEW_SLOTS} AS VARCHAR) AS {name}"
    for name in salary_model.WIDE
)
SLOTTED_FEATURES = f"(SELECT * REPLACE ({SLOTTED}) FROM features)"


@job("ml_index_slotted", f"SELECT job_id, {', '.join(salary_model.WIDE)}, label FROM {SLOTTED_FEATURES} WHERE label > 0")
def _(c: Context) -> DataFrame:
    return salary_model.slotted(_prepared(c), FEW_SLOTS).select("job_id", *salary_model.WIDE, "label")


@job("ml_assemble_slotted", "SELECT job_id, width, non_zero, numbers FROM "
     f"({VECTORS.replace('FROM features', f'FROM {SLOTTED_FEATURES}')})")  # fmt: skip
def _(c: Context) -> DataFrame:
    """Vectors whose width the slots bound, not the cities and skills."""
    prepared = salary_model.slotted(_prepared(c), FEW_SLOTS)
    return _described(salary_model.pipeline().fit(prepared).transform(prepared), "job_id")


@job("ml_split", "SELECT job_id, substr(md5(job_id), 1, 4) < 'cccd' AS training FROM features "
     "WHERE label > 0")  # fmt: skip
def _(c: Context) -> DataFrame:
    train_rows, test_rows = salary_model.split(_prepared(c).select("job_id", "label"))
    return (
        train_rows.select("job_id", F.lit(True).alias("training"))
        .unionByName(test_rows.select("job_id", F.lit(False).alias("training")))
    )


TEST_ROWS = "label > 0 AND NOT substr(md5(job_id), 1, 4) < 'cccd'"


@job("ml_fit_rf", f"SELECT job_id, label, true AS agrees FROM features WHERE {TEST_ROWS}")
def _(c: Context) -> DataFrame:
    """The fitted forest's scores of the test postings equal those of its table of trees."""
    rows = c.scored_by_table(salary_model.split(_prepared(c))[1])
    return rows.select("job_id", "label", forest_table.agrees("prediction", "table_prediction").alias("agrees"))


@job("ml_forest_table", f"SELECT CAST(range AS INTEGER) AS tree, true AS whole FROM range({salary_model.TREES})")
def _(c: Context) -> DataFrame:
    """Every tree has its root, every child its node, and no level beyond the depth."""
    c.model()
    forest = forest_table.nodes(c.spark, c.kept["model"])
    inner = F.col("feature") != forest_table.LEAF
    return forest.groupBy("tree").agg(
        ((F.min("node") == 0) & (F.max("node") == F.count("*") - 1) & (F.count("*") == 2 * F.count_if(inner) + 1)
         & (F.count("*") < 2 ** (salary_model.DEPTH + 1)) & F.bool_and(~inner | (F.col("left") == F.col("node") + 1))).alias("whole")
    )


@job("ml_evaluate", f"SELECT count(*) AS test_records, true AS rmse_usd, true AS r2_score, true AS mae_usd FROM features WHERE {TEST_ROWS}")
def _(c: Context) -> DataFrame:
    """The three figures against those of the trees as a table, by SQL."""
    other = _table_evaluation(c)
    close = [(F.abs(F.col(n) - F.lit(v)) <= 1e-6 * abs(v)).alias(n) for n, v in other.items()]
    return _evaluation(c).select("test_records", *close)


@job("ml_predict_single", "SELECT job_id AS prediction_id, role_category, experience_level, city_normalized AS city, "
     "is_remote, len(list_filter(coalesce(skills, []), lambda s: trim(s) <> ''))::INT AS skills_count, true AS agrees FROM silver")  # fmt: skip
def _(c: Context) -> DataFrame:
    """Requests are scored as a batch with the same skills is, whatever their number."""
    single = salary_model.score_requests(c.model(), _requests(c))
    tags = F.filter(F.transform(F.coalesce("skills", F.array().cast("array<string>")), lambda s: F.lower(F.trim(s))), lambda s: s != "")
    same = _requests(c).withColumns({"skills": tags, "employment_type": F.lit(salary_model.CATEGORIES["employment_type"])})
    expected = c.scored_by_table(salary_model.prepare(same, require_label=False), "request_id").select(F.col("request_id").alias("prediction_id"), "table_prediction")
    agrees = F.abs(F.col("predicted_annual_salary") - F.col("table_prediction")) <= 0.0051
    return single.join(expected, "prediction_id").select(
        "prediction_id", "role_category", "experience_level", "city", "is_remote", "skills_count", agrees.alias("agrees")
    )


@job("ml_predict_batch", "SELECT job_id AS prediction_id, true AS agrees FROM silver")
def _(c: Context) -> DataFrame:
    """The stored prediction of every posting is that of the trees as a table, rounded."""
    expected = c.scored_by_table(salary_model.prepare(c.silver(), require_label=False))
    both = c.predictions().join(expected.select(F.col("job_id").alias("prediction_id"), "table_prediction"), "prediction_id")
    return both.select("prediction_id", (F.abs(F.col("predicted_annual_salary") - F.col("table_prediction")) <= 0.0051).alias("agrees"))


@job("ml_predict_batch_rows", "SELECT job_id AS prediction_id, role_category, experience_level, "
     "city_normalized AS city, is_remote, skills_count, coalesce(lower(trim(skills[1])), "
     "'general') AS primary_skill, 0.88::DOUBLE AS confidence_score FROM silver")  # fmt: skip
def _(c: Context) -> DataFrame:
    return c.predictions().drop("prediction_timestamp", "predicted_annual_salary")


def _profiles(c: Context) -> DataFrame:
    """Postings as estimator input, with cities renamed in part so that all factors occur."""
    known = list(estimator.CITY_FACTOR)
    index = F.pmod(F.length("title") + F.col("skills_count"), F.lit(len(known) + 1))
    city = F.coalesce(F.get(F.array(*[F.lit(x) for x in known]), index), F.col("city_normalized"))
    return c.silver().select(
        "job_id", "role_category", "experience_level", city.alias("city"), "is_remote", "skills"
    )


def _case(column: str, table: dict, default, kind: str) -> str:
    cases = " ".join(
        f"WHEN {O.quoted(name)} THEN CAST({value} AS {kind})" for name, value in table.items()
    )
    return f"CASE {column} {cases} ELSE CAST({default} AS {kind}) END"


PROFILE_SQL = (
    "(SELECT job_id, role_category, experience_level, coalesce(list_extract("
    f"{O.listed(estimator.CITY_FACTOR)}, CAST((length(title) + skills_count) % "
    f"{len(estimator.CITY_FACTOR) + 1} + 1 AS INTEGER)), city_normalized) AS city, is_remote, "
    "skills_count FROM silver)"
)
LEVEL_FREE = (
    _case("role_category", estimator.BASE_PAY, 130000, "DECIMAL(6,0)")
    + " * "
    + _case("city", estimator.CITY_FACTOR, "1.00", "DECIMAL(3,2)")
    + " * CASE WHEN is_remote THEN CAST(1.04 AS DECIMAL(3,2)) ELSE CAST(1 AS DECIMAL(3,2)) END"
)
BONUS = "CAST(skills_count * 3500 AS DECIMAL(12,0))"


@job("estimate_rule_based", "SELECT job_id, city, CAST(round("
     f"{LEVEL_FREE} * {_case('experience_level', estimator.LEVEL_FACTOR, '1.00', 'DECIMAL(3,2)')}"
     f" + {BONUS}, 2) AS DOUBLE) AS estimated_salary, CAST(least(86.0 + skills_count * "
     f"CAST(1.8 AS DECIMAL(2,1)), 96.5) AS DOUBLE) AS confidence FROM {PROFILE_SQL}")  # fmt: skip
def _(c: Context) -> DataFrame:
    found = estimator.estimate(_profiles(c))
    return found.select("job_id", "city", "estimated_salary", "confidence")


@job("seniority_curve", "SELECT job_id, level AS experience_level, CAST(round("
     f"{LEVEL_FREE} * factor + {BONUS}, 0) AS DOUBLE) AS estimated_salary FROM {PROFILE_SQL} "
     "JOIN (VALUES ('Entry / Junior', CAST(0.72 AS DECIMAL(3,2))), "
     "('Mid-Level', CAST(1.00 AS DECIMAL(3,2))), ('Senior', CAST(1.28 AS DECIMAL(3,2))), "
     "('Lead / Principal', CAST(1.55 AS DECIMAL(3,2)))) levels(level, factor) ON true"
     )
def _(c: Context) -> DataFrame:
    return estimator.seniority_curve(_profiles(c), "job_id")


@job("filter_predictions", "SELECT job_id AS prediction_id, city_normalized AS city FROM silver "
     "WHERE role_category = 'DevOps & Cloud' AND is_remote")  # fmt: skip
def _(c: Context) -> DataFrame:
    kept = dashboards.filter_predictions(c.predictions(), "DevOps & Cloud", "Remote Only")
    return kept.select("prediction_id", "city")


# --- driver interface -------------------------------------------------------------------------

_contexts: dict[tuple[str, str], Context] = {}


def context(spark: SparkSession, sf_dir: str) -> Context:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    prefer_compiled(spark)
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _contexts:
        _contexts[key] = Context(spark, key[1])
    return _contexts[key]


def runner(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: JOBS[name](context(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: runner(name) for name in JOBS}


def oracle_sql() -> dict[str, str]:
    return {name: O.statement(select) for name, select in SELECTS.items()}
