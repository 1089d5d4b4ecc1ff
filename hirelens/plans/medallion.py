"""The batch job: raw postings to Silver to Gold, each table written once and read back.

Nothing downstream of a written table recomputes what led to it, so duplicate resolution and
surrogate keys are decided once, and a lost executor costs a few tasks rather than the lineage.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens import schemas
from hirelens.plans import gold, silver
from hirelens.session import fresh_folder, prefer_compiled
from hirelens.sources import lake
from hirelens.sources.versions import Store, Version

LAYOUT = "_layout"
BUCKETED = ("fact_job_postings", "bridge_job_skills")
#: Postings in one bucket of fact and bridge, so that a bucket's file and task stay of one size.
ROWS_PER_BUCKET = 1_000_000
STAGES = ("all", "bronze-to-silver", "silver-to-gold")


class Lakehouse:
    """Tables below one root folder, built on first use and read from their files afterwards."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        raw: Callable[[], DataFrame] | None = None,
        using: silver.Rules = silver.Rules(),
        buckets: int | None = None,
        arrived: Callable[[], DataFrame] | None = None,
        homes: Mapping[str, str] | None = None,
    ):
        """``raw`` yields everything ingested; with ``arrived``, only the postings of those rows are
        built anew in a Silver table that exists. ``buckets`` overrides the count from the rows.
        ``homes`` says where tables that exist are read from, if not below the root.
        """
        self.spark = spark
        self.root = root.rstrip("/")
        self._raw = raw
        self._using = using
        self._arrived = arrived
        self._buckets = buckets
        self._open: dict[str, DataFrame] = {}
        self._homes = dict(homes or {})
        prefer_compiled(spark)
        # a bucket of fact and bridge is one file, in the order it was sorted in when written
        spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _home(self, name: str) -> str:
        """Where an earlier build left a table."""
        return self._homes.get(name, self.path(name))

    def table(self, name: str) -> DataFrame:
        """The published columns of a table in their declared types."""
        if name == "silver":
            return self._stored(name)
        return self._stored(name).select(*schemas.GOLD[name].fieldNames())

    def tables(self, names: Iterable[str]) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in names}

    def _stored(self, name: str) -> DataFrame:
        """As on disk, with the weight column that dimensions carry for the joins."""
        if name not in self._open:
            self._open[name] = self._write(name, self._define(name))
        return self._open[name]

    def _define(self, name: str) -> DataFrame:
        if name == "silver":
            if self._raw is None:
                return lake.read_silver(self.spark, self._home("silver"))
            if self._arrived is None:
                return silver.build(self._raw(), self._using)
            return self._refreshed_silver()
        base = self._stored("silver")
        if name == "fact_job_postings":
            foreign = gold.foreign_keys(
                base,
                self._stored("dim_company"),
                self._stored("dim_job_role"),
                self._stored("dim_location"),
            )
            return gold.fact(base, foreign, gold.fact_keys(base), self._bucket_count())
        if name == "bridge_job_skills":
            pairs = gold.bridge(base, self._stored("dim_skill"))
            return pairs.repartition(self._bucket_count(), "job_id")
        single = {
            "dim_company": gold.dim_company,
            "dim_job_role": gold.dim_job_role,
            "dim_location": gold.dim_location,
            "dim_date": gold.dim_date,
            "dim_skill": gold.dim_skill,
            "gold_top_skills": gold.top_skills,
            "gold_salary_by_role_city": gold.salary_by_role_city,
            "gold_remote_trends": gold.remote_trends,
            "gold_company_hiring": gold.company_hiring,
        }
        return single[name](base)

    def _refreshed_silver(self) -> DataFrame:
        """Written beside the old table first, which it is read from."""
        try:
            old = lake.read_silver(self.spark, self._home("silver"))
        except AnalysisException:
            old = self.spark.createDataFrame([], schemas.SILVER)
        new = silver.refreshed(old, self._raw(), self._arrived(), self._using)
        return lake.overwrite(new, fresh_folder(self.spark, "silver"))

    def _bucket_count(self) -> int:
        """At least the shuffle partitions, and more as the postings grow."""
        if self._buckets is None:
            least = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            self._buckets = max(least, -(-self._stored("silver").count() // ROWS_PER_BUCKET))
        return self._buckets

    def note_layout(self) -> None:
        """Leave the bucket count for ``reopen``; once, after fact and bridge are settled."""
        note = self.spark.range(1).select(F.lit(self._bucket_count()).alias("buckets"))
        note.write.mode("overwrite").json(self.path(LAYOUT))

    def _write(self, name: str, df: DataFrame) -> DataFrame:
        if name == "silver" and self._raw is None:
            return df
        if name in BUCKETED:
            return self._write_bucketed(name, df)
        return lake.overwrite(df, self.path(name))

    def _database(self) -> str:
        database = "hirelens_" + hashlib.md5(self.root.encode()).hexdigest()
        self.spark.sql(
            f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{self.root}/_database'"
        )
        return database

    def reopen(self) -> Lakehouse:
        """Use the tables that an earlier run left below the root instead of building them.

        The bucket count comes from the note that run left: declaring another one over the same
        files would give wrong joins.
        """
        layout = self._home("fact_job_postings").rpartition("/")[0] + "/" + LAYOUT
        self._buckets = self.spark.read.json(layout).first()["buckets"]
        database = self._database()
        self._open["silver"] = lake.read_silver(self.spark, self._home("silver"))
        for name in schemas.GOLD:
            if name not in BUCKETED:
                self._open[name] = self.spark.read.parquet(self._home(name))
                continue
            fields = schemas.GOLD[name].fields
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet "
                f"CLUSTERED BY (job_id) SORTED BY (job_id) INTO {self._buckets} BUCKETS "
                f"LOCATION '{self._home(name)}'"
            )
            self._open[name] = self.spark.table(f"{database}.{name}")
        return self

    def _write_bucketed(self, name: str, df: DataFrame) -> DataFrame:
        """Fact and bridge share a bucketing by job id, so joining them shuffles neither.

        They arrive hash-partitioned by that id into as many partitions as there are buckets, which
        makes one file per bucket.
        """
        database = self._database()
        (
            df.write.mode("overwrite")
            .option("path", self.path(name))
            .bucketBy(self._bucket_count(), "job_id")
            .sortBy("job_id")
            .saveAsTable(f"{database}.{name}")
        )
        return self.spark.table(f"{database}.{name}")


# Tables of one wave do not depend on each other. The long ones, fact and bridge, start first, and the
# aggregates fill the cores that their tails leave idle.
DIMENSIONS = tuple(name for name in schemas.GOLD if name.startswith("dim_"))
AGGREGATES = tuple(name for name in schemas.GOLD if name not in (*DIMENSIONS, *BUCKETED))
WAVES = (("silver",), DIMENSIONS, (*BUCKETED, *AGGREGATES))
JOBS_AT_ONCE = 5


def run(lakehouse: Lakehouse, stage: str = "all") -> dict[str, DataFrame]:
    """Build the tables of one stage and return them as read back.

    Several tables of a wave are submitted at a time, so the tail of one write does not leave the
    executors idle.
    """
    if stage not in STAGES:
        raise ValueError(f"stage must be one of {STAGES}, not {stage!r}")
    waves = {"all": WAVES, "bronze-to-silver": WAVES[:1], "silver-to-gold": WAVES[1:]}[stage]
    lakehouse.table("silver")  # all others start from it, so it is settled before they run at once
    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        for wave in waves:
            if BUCKETED[0] in wave:
                lakehouse.note_layout()
            list(pool.map(lakehouse.table, wave))
    return lakehouse.tables(name for wave in waves for name in wave)


# --- builds that readers see as a whole -------------------------------------------------------

BUILDS = "_builds"


def homes(store: Store, version: Version) -> dict[str, str]:
    """The folder of every table of a version that ``build_version`` published."""
    return {name: folders[0] for name in version.tables if (folders := store.folders(version, name))}


def build_version(
    store: Store,
    raw: Callable[[], DataFrame] | None = None,
    stage: str = "all",
    using: silver.Rules = silver.Rules(),
    buckets: int | None = None,
    arrived: Callable[[], DataFrame] | None = None,
) -> Version:
    """Build the tables of a stage in folders of their own and publish them together.

    Readers keep the version they opened; a build that fails publishes nothing. The stages read
    Silver from the version that was current when the build began.
    """
    draft = store.draft()
    lakehouse = Lakehouse(
        store.spark, f"{store.root}/{BUILDS}/{draft.run}", None if stage == "silver-to-gold" else raw,
        using, buckets, arrived, homes(store, draft.base),
    )
    built = run(lakehouse, stage)
    checked(built)
    for name in built:
        draft.put(name, f"{BUILDS}/{draft.run}/{name}")
    return draft.publish()


def checked(built: Mapping[str, DataFrame]) -> None:
    """Refuse a build whose facts are not the postings of its Silver, one each."""
    if not {"silver", "fact_job_postings"} <= built.keys():
        return
    postings, facts = built["silver"].count(), built["fact_job_postings"].count()
    if postings != facts:
        raise ValueError(f"{facts} facts for {postings} postings")


def opened(store: Store, version: Version | None = None) -> Lakehouse:
    """The tables of a published version, which stay as they are whatever is published later."""
    version = version or store.current()
    root = f"{store.root}/{BUILDS}/readers-{version.number}"
    return Lakehouse(store.spark, root, homes=homes(store, version)).reopen()
