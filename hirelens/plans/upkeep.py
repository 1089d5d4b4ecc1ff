"""A lake that is kept up by increments: each reads what arrived and the parts it touches.

Every increment publishes one new version (``sources.versions``). Tables of postings are layers, one an
increment: what is there stays as it is, new rows are a layer of their own, and the ids of renewed
postings say which rows of earlier layers no longer hold. So an increment writes its own rows once,
and does not rewrite a bucket for each of the few postings it renews; ``LAYERS`` of them are folded into
one. Tables of groups lie in hash buckets, of which only touched ones have new folders.

* ``latest`` holds the winning raw row of each posting. The winner under a total order among all
  that has come equals the winner among the one kept and those that arrive, so Bronze is not read
  again, and neither an older version that comes late nor the same rows again change anything. Rows
  whose id comes once and is new, most of them, are found by their ids alone and go to the layer as they are.
* ``silver`` follows for the postings whose winner changed. Their former and present rows, with a
  sign, are all that Gold sees. Postings that only the table or only the increment holds are neither
  compared nor sorted against others; renewed ones, few beside new ones, leave by a small anti join.
* Dimensions and aggregates have a state of exact sums per group, from which touched groups are
  finished anew. Lowest and highest pay, and the posting that names a company's domain, are kept as
  extremes of the group. Only a group whose extreme was taken back looks for the next one in Silver.
* Surrogate keys are appended and never change, so facts of other postings stay right as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens import schemas
from hirelens.functions import aggregates as A
from hirelens.operators import increment as I
from hirelens.operators.keys import dense_key
from hirelens.plans import gold, silver
from hirelens.plans.medallion import JOBS_AT_ONCE
from hirelens.session import fresh_folder
from hirelens.sources import lake
from hirelens.sources.versions import Draft, Store, Version

#: Buckets of the groups in a new lake. An increment rewrites the buckets it touches.
BUCKETS = 256
#: Layers of a table of postings that are folded into one, so that an increment rewrites a share of it.
LAYERS = 16
LAYERED = ("latest", "silver", "fact_job_postings", "bridge_job_skills")
#: Per layer, the postings whose rows in earlier layers no longer hold.
RENEWED = "renewed"
#: Raised when stored tables change their form.
LAYOUT = 2
PAY = "annual_salary_usd"
MENTION = "skill_name"


@dataclass(frozen=True)
class Kept:
    """A table kept as sums and extremes: which rows count, by which group, and how a group becomes a row."""

    group: Sequence[str]
    finish: Callable[[DataFrame], DataFrame]
    sums: Callable[[], Mapping[str, Column]] = dict
    ends: Callable[[], Mapping[str, I.End]] = dict
    rows: Callable[[DataFrame], DataFrame] = field(default=lambda changes: changes)
    key_map: str | None = None


def _mentions(changes: DataFrame) -> DataFrame:
    return gold.skill_mentions(changes, PAY, "is_remote", I.SIGN)


def _pay() -> dict[str, Column]:
    return {"paid": I.counted(F.col(PAY).isNotNull()), "pay": I.summed(PAY)}


def _pay_and_remote() -> dict[str, Column]:
    return {**_pay(), "remote": I.counted(F.col("is_remote"))}


def _average() -> Column:
    return A.ratio(F.col("pay"), F.col("paid"), 2)


def _remote_share() -> Column:
    return A.percent(F.col("remote"), F.col(I.ROWS))


def _top_skills(state: DataFrame) -> DataFrame:
    return state.select(
        MENTION, F.col(I.ROWS).alias("posting_count"), _average().alias("avg_salary_usd"),
        _remote_share().alias("remote_percentage"),
    )


def _salary_by_role_city(state: DataFrame) -> DataFrame:
    return state.select(
        "role_category", F.col("city_normalized").alias("city"), "experience_level",
        F.col(I.ROWS).alias("total_postings"), A.ratio(F.col("pay"), F.col(I.ROWS), 2).alias("avg_annual_salary"),
        F.round("low", 2).alias("min_annual_salary"), F.round("high", 2).alias("max_annual_salary"),
    )


def _remote_trends(state: DataFrame) -> DataFrame:
    skills = A.ratio(F.col("skills").cast("decimal(20,0)"), F.col(I.ROWS), 2)
    return state.select(
        "role_category", "is_remote", F.col(I.ROWS).alias("total_jobs"), _average().alias("avg_salary"),
        skills.alias("avg_skills_required"),
    )


def _company_hiring(state: DataFrame) -> DataFrame:
    return state.select(
        "company_name", "company_industry", F.col(I.ROWS).alias("open_positions"),
        _average().alias("avg_offered_salary"), _remote_share().alias("pct_remote"),
    )


def _companies(state: DataFrame) -> DataFrame:
    """Domain and industry come from the posting with the lowest id."""
    return state.select(
        "company_name", "first.company_domain", "first.company_industry", F.col(I.ROWS).alias("total_jobs_posted")
    )


def _places(state: DataFrame) -> DataFrame:
    return state.select(F.col("city_normalized").alias("city"), F.col("country_normalized").alias("country"), "is_remote")


PLACE = ["city_normalized", "country_normalized", "is_remote"]
ROLE = ["role_category", "experience_level"]
KEPT: dict[str, Kept] = {
    "dim_company": Kept(
        ["company_name"], _companies, key_map="company_key",
        ends=lambda: {"first": I.End(F.struct("job_id", "company_domain", "company_industry"))},
    ),
    "dim_job_role": Kept(ROLE, lambda state: state.select(*ROLE), key_map="role_key"),
    "dim_location": Kept(PLACE, _places, key_map="location_key"),
    "dim_date": Kept(["posted_date"], gold.dim_date, rows=lambda changes: changes.filter("posted_date IS NOT NULL")),
    "dim_skill": Kept([MENTION], lambda state: state.select(MENTION), rows=_mentions, key_map="skill_key"),
    "gold_top_skills": Kept([MENTION], _top_skills, _pay_and_remote, rows=_mentions),
    "gold_salary_by_role_city": Kept(
        ["role_category", "city_normalized", "experience_level"], _salary_by_role_city, lambda: {"pay": I.summed(PAY)},
        lambda: {"low": I.End(F.col(PAY)), "high": I.End(F.col(PAY), highest=True)},
        lambda changes: changes.filter(F.col(PAY).isNotNull()),
    ),
    "gold_remote_trends": Kept(
        ["role_category", "is_remote"], _remote_trends, lambda: {**_pay(), "skills": I.summed_int("skills_count")}
    ),
    "gold_company_hiring": Kept(["company_name", "company_industry"], _company_hiring, _pay_and_remote),
}

LATEST = T.StructType([schemas.EVENT[name] for name in silver.USED_FIELDS])
#: What names a row of a dimension with a surrogate key, as Silver and as the dimension call it.
NAMES = {
    "company_key": ("dim_company", {"company_name": "company_name"}),
    "role_key": ("dim_job_role", {"role_category": "role_category", "experience_level": "experience_level"}),
    "location_key": ("dim_location", {"city_normalized": "city", "country_normalized": "country", "is_remote": "is_remote"}),
    "skill_key": ("dim_skill", {MENTION: MENTION}),
}


class LiveLake:
    """The lake below one root. ``apply`` adds what arrived; ``table`` reads a published version."""

    def __init__(self, spark: SparkSession, root: str, using: silver.Rules = silver.Rules(), buckets: int = BUCKETS):
        self.spark, self.store, self._using = spark, Store(spark, root), using
        self._new_buckets = buckets

    def schema(self, table: str) -> T.StructType:
        if table == "latest":
            return LATEST
        if table == RENEWED:
            return T.StructType([LATEST["job_id"]])
        if table == "silver":
            return schemas.SILVER
        if table in NAMES:
            home, names = NAMES[table]
            return T.StructType([T.StructField(table, T.LongType()), *(schemas.GOLD[home][n] for n in names.values())])
        return schemas.GOLD[table]

    def table(self, name: str, version: Version | None = None) -> DataFrame:
        version = version or self.store.current()
        if name in LAYERED:
            return self._layered(version, name)
        return self.store.read(version, name, self.schema(name))

    def _layered(self, version: Version, name: str) -> DataFrame:
        """The rows of all layers, but those that a later layer renews."""
        schema, gone, layers = self.schema(name), version.tables.get(RENEWED, {}), []
        for part in sorted(version.tables.get(name, {})):
            rows = self.store.read(version, name, schema, [part])
            if later := [p for p in gone if p > part]:
                rows = rows.join(self.store.read(version, RENEWED, self.schema(RENEWED), later), "job_id", "left_anti")
            layers.append(rows.select(*schema.fieldNames()))
        return reduce(DataFrame.unionAll, layers) if layers else self.store.read(version, name, schema)

    def build(self, raw: DataFrame) -> Version:
        """A first version; everything is an increment to an empty lake."""
        return self.apply(raw)

    def apply(self, arrived: DataFrame, stored: bool = False) -> Version:
        """Publish the lake with these raw rows added; the version there is if they change nothing.

        Rows are read several times. Unless the caller says that they are ``stored``, that is, come from
        files that stay as they are, a copy is written first.
        """
        base = self.store.current()
        if base.tables and base.notes.get("layout") != LAYOUT:
            raise ValueError(f"{self.store.root} was made by another release; build it anew")
        draft = self.store.draft(base)
        draft.notes["layout"] = LAYOUT
        buckets = draft.notes.setdefault("buckets", self._new_buckets)

        rows = silver.identified(arrived)
        rows = rows if stored else self._staged(rows, "arrived")
        # only ids are compared with the whole table; rows alone with their id are neither sorted nor shuffled
        known = self.store.read(base, "latest", self.schema(RENEWED))
        odd = self._staged(I.not_alone(rows, known, "job_id"), "odd")
        both = odd.filter(I.KNOWN).select("job_id")
        rivals = self._staged(self.table("latest", base).join(both, "job_id", "left_semi"), "rivals")
        rest = rows.join(odd, "job_id", "left_semi")
        won = I.differing(rivals, silver.deduplicated(rivals.unionByName(rest)), "job_id", silver.USED_FIELDS[1:])
        # each table's new rows are written once, as its layer, and read from there
        winners = self._layer(draft, "latest", rows.join(odd, "job_id", "left_anti").unionByName(won))
        if winners.isEmpty():
            return base
        renewed = self._layer(draft, RENEWED, winners.select("job_id").join(both, "job_id", "left_semi"))
        former = self._staged(self.table("silver", base).join(renewed, "job_id", "left_semi"), "former")
        now = self._layer(draft, "silver", silver.derived(silver.cleaned(winners), self._using))
        changes = I.signed(former, now)

        maps = {key: self._grown(draft, base, key, changes) for key in NAMES}
        postings = self.table("silver", draft.preview())
        with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
            list(pool.map(lambda name: self._keep(draft, base, name, changes, maps, buckets, postings), KEPT))
        self._facts(draft, base, now, renewed, maps)
        self._fold(draft)
        return draft.publish()

    def _layer(self, draft: Draft, name: str, rows: DataFrame) -> DataFrame:
        """Add a layer to a table of postings and return it as read back."""
        draft.layer(name, rows.select(*self.schema(name).fieldNames()))
        return self.store.spark.read.schema(self.schema(name)).parquet(f"{self.store.root}/{draft.folder(name)}")

    def _fold(self, draft: Draft) -> None:
        """Once there are ``LAYERS``, each table of postings is one again."""
        version = draft.preview()
        if len(version.tables["latest"]) < LAYERS:
            return
        for name in LAYERED:
            draft.fold(name, self.table(name, version))
        draft.drop(RENEWED)

    def _staged(self, df: DataFrame, name: str) -> DataFrame:
        return lake.overwrite(df, fresh_folder(self.spark, f"upkeep-{name}"))

    def _grown(self, draft: Draft, base: Version, key: str, changes: DataFrame) -> DataFrame:
        """The key map with the names that are new; they are appended as a part of their own."""
        _, names = NAMES[key]
        rows = changes.filter(F.col(I.SIGN) > 0)
        rows = gold.skill_mentions(rows) if key == "skill_key" else rows
        known = self.table(key, base)
        last = draft.notes.get(key, 0)
        named = rows.select(*(F.col(c).alias(n) for c, n in names.items()))
        fresh = self._staged(I.new_keys(named, known, key, last), key)
        added = fresh.count()
        if added:
            draft.append(key, fresh)
            draft.notes[key] = last + added
        return known.unionByName(fresh)

    def _keep(
        self, draft: Draft, base: Version, name: str, changes: DataFrame, maps: dict, buckets: int, postings: DataFrame
    ) -> None:
        """State and table of one kept table, in the buckets of the groups that changed."""
        kept = KEPT[name]
        ends = kept.ends()
        more = self._staged(I.delta(kept.rows(changes), kept.group, kept.sums(), ends), f"delta-{name}")
        part = I.buckets_of(kept.group, buckets)
        hit = I.touched(more, part)
        if not hit:
            return
        # the state has the layout of its delta, without what was taken back
        layout = more.drop(*(I.lost(end) for end in ends)).schema
        state = self.store.read(base, f"state_{name}", layout, hit)
        state = self._staged(I.merged(state, more, kept.group, ends), f"state-{name}")
        if ends:
            unsure = state.filter(I.OPEN)
            if not unsure.isEmpty():
                rows = kept.rows(postings.withColumn(I.SIGN, F.lit(1)))
                state = self._staged(I.settled(state, rows, kept.group, ends), f"settled-{name}")
            state = state.drop(I.OPEN)
        draft.replace(f"state_{name}", state, part, hit)
        rows = kept.finish(state)
        if kept.key_map is not None:
            _, names = NAMES[kept.key_map]
            rows = rows.join(maps[kept.key_map], list(names.values()))
        rows = rows.select(*schemas.GOLD[name].fieldNames())
        renamed = {"city_normalized": "city", "country_normalized": "country", "posted_date": "full_date"}
        group = [c if c in rows.columns else renamed[c] for c in kept.group]
        draft.replace(name, rows, I.buckets_of(group, buckets), hit)

    def _facts(self, draft: Draft, base: Version, now: DataFrame, renewed: DataFrame, maps: dict) -> None:
        """Facts and skill pairs of the renewed postings; a posting that had a fact key keeps it."""
        weighted = {key: grown.withColumn(gold.WEIGHT, F.lit(1)) for key, grown in maps.items()}
        foreign = gold.foreign_keys(now, weighted["company_key"], maps["role_key"], weighted["location_key"])
        facts = self.table("fact_job_postings", base)
        had = facts.select("job_id", "fact_key").join(renewed, "job_id", "left_semi")
        last = draft.notes.get("fact_key", 0)
        fresh = now.select("posted_date", "job_id").join(renewed, "job_id", "left_anti")
        order = [F.col("posted_date").asc_nulls_first(), F.col("job_id")]
        numbered = dense_key(fresh, "fact_key", order).select("job_id", (F.col("fact_key") + last).alias("fact_key"))
        own = self._staged(had.unionByName(numbered), "fact-keys")
        draft.notes["fact_key"] = max(last, own.agg(F.max("fact_key")).first()[0] or 0)
        rows = now.select("job_id", *gold.FACT_COLUMNS).join(foreign, "job_id").join(own, "job_id")
        self._layer(draft, "fact_job_postings", rows)
        self._layer(draft, "bridge_job_skills", gold.bridge(now, weighted["skill_key"]))
