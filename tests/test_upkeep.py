"""A lake kept up by increments against one built from everything."""

import pytest
from pyspark.sql import functions as F

from hirelens.operators import increment
from hirelens.plans import medallion, upkeep

POSTING = {"title": "Data Engineer", "company_name": "Acme", "city": "Oslo", "country": "Norway"}


def posting(job_id, stamp, **fields):
    return {**POSTING, "job_id": job_id, "ingestion_timestamp": f"2024-01-{stamp:02d}T00:00:00Z", **fields}


@pytest.fixture
def live(spark, folder):
    return upkeep.LiveLake(spark, folder("live"), buckets=64)


def bag(df, *columns):
    return sorted(map(str, df.select(*columns).collect()))


def same_as_full(spark, live, folder, raw):
    full = medallion.Lakehouse(spark, folder("full"), raw=lambda: raw)
    for name, kept in {"silver": None, **upkeep.KEPT}.items():
        columns = [c for c in full.table(name).columns if kept is None or c != kept.key_map]
        assert bag(live.table(name), *columns) == bag(full.table(name), *columns), name


def test_replaced_postings_are_taken_back(spark, live, events, folder):
    batches = [
        [
            posting("1", 1, salary_min=90000.0, skills=["sql", "sql"], is_remote=True),
            posting("2", 1, salary_min=50000.0, skills=["java"], company_name="Beta", posted_at="2024-01-01"),
            posting("3", 5, salary_min=70000.0, company_industry="Rail"),
        ],
        [
            # the best paid one falls, a company and a skill disappear, an older version comes late
            posting("1", 2, salary_min=40000.0, skills=["sql"]),
            posting("2", 3, salary_min=60000.0, skills=None, company_name="Acme"),
            posting("3", 4, salary_min=1000000.0, company_name="Late"),
        ],
        [posting("4", 6, company_name="Beta", skills=["java", "rust"], city="Bergen"), posting(" ", 6), posting("1", 2, salary_min=40000.0, skills=["sql"])],
    ]
    seen, keys = [], {}
    for batch in batches:
        seen += batch
        live.apply(events(*batch))
        same_as_full(spark, live, folder, events(*seen))
        now = {r.company_name: r.company_key for r in live.table("company_key").collect()}
        assert {n: k for n, k in now.items() if n in keys} == keys, "a key changed"
        assert sorted(now.values()) == list(range(1, len(now) + 1))
        keys = now
    assert {r.company_name for r in live.table("dim_company").collect()} == {"Acme", "Beta"}
    star = live.table("fact_job_postings").join(live.table("dim_company"), "company_key")
    assert bag(star, "job_id", "company_name") == bag(live.table("silver"), "job_id", "company_name")
    assert sorted(r.fact_key for r in live.table("fact_job_postings").collect()) == [1, 2, 3, 4]


def test_the_same_rows_again_publish_nothing(live, events):
    batch = [posting("1", 1), posting("2", 1, skills=["a"])]
    first = live.apply(events(*batch))
    assert live.apply(events(*batch[::-1], batch[0])).number == first.number
    assert live.apply(events(posting("", 3), posting(None, 3))).number == first.number


def test_an_empty_lake_takes_nothing(live, events):
    assert live.apply(events()).number == 0
    assert live.table("silver").count() == 0 and live.table("gold_top_skills").count() == 0


def test_an_increment_writes_the_buckets_it_touches(live, events):
    """One renewed posting of a hundred: one new folder of each posting table, its groups only in Gold."""
    first = live.apply(events(*(posting(f"J{i}", 1, company_name=f"C{i}", skills=[f"s{i}"], posted_at="2024-01-01") for i in range(100))))
    second = live.apply(events(posting("J7", 2, company_name="C7", skills=["s7"], posted_at="2024-01-01", salary_min=90000.0)))

    def new(table):
        return [p for p, f in second.tables[table].items() if first.tables.get(table, {}).get(p) != f]

    for table in ("latest", "silver", "fact_job_postings", "bridge_job_skills", "gold_top_skills", "gold_company_hiring", "gold_remote_trends"):
        assert len(new(table)) == 1, table
    for table in ("dim_company", "dim_skill", "dim_location", "dim_date", "company_key", "skill_key"):
        assert new(table) == [], table
    assert live.table("silver", first).filter("annual_salary_usd IS NOT NULL").count() == 0
    assert live.table("silver", second).filter("annual_salary_usd IS NOT NULL").count() == 1


def test_an_increment_writes_its_own_rows_only(spark, events, folder):
    """Renewing one posting of ten in a bucket does not write the other nine again."""
    live = upkeep.LiveLake(spark, folder("live"), buckets=1)
    first = live.apply(events(*(posting(str(i), 1, skills=["sql"]) for i in range(10))))
    second = live.apply(events(posting("7", 2, title="Nurse", skills=["sql"]), posting("10", 2, skills=["java"])))
    for table in upkeep.LAYERED:
        folders = [f"{live.store.root}/{f}" for p, f in second.tables[table].items() if first.tables[table].get(p) != f]
        assert spark.read.parquet(*folders).count() == 2, table
        assert live.table(table, second).count() == 11, table
        assert live.table(table, first).count() == 10, table
    assert live.table("silver", second).filter("title = 'Nurse'").count() == 1


def test_rows_alone_with_their_id_are_not_compared(spark, live, events, folder, monkeypatch):
    """Of 100 rows that arrive, those that repeat an id or renew a posting meet the window; the others do not."""
    seen = [posting(f"J{i}", 3, company_name=f"C{i % 7}") for i in range(50)]
    live.apply(events(*seen))
    compared, keep = [], upkeep.silver.deduplicated
    monkeypatch.setattr(upkeep.silver, "deduplicated", lambda rows: compared.append(rows.count()) or keep(rows))
    batch = [posting(f" N{i} ", 4, skills=["sql"]) for i in range(95)]
    batch += [posting("N1", 5, title="Nurse"), posting("N1", 4), posting("J1", 4, title="Nurse"), posting("J2", 2), posting(None, 4)]
    path = folder("arrived")
    events(*batch).write.parquet(path)
    version = live.apply(spark.read.parquet(path), stored=True)
    assert compared == [7]  # three of N1, two of J1 and J2 that arrive, two that are there
    assert version.number == 2 and live.table("latest").count() == 145
    assert {r.job_id for r in live.table("silver").filter("title = 'Nurse'").collect()} == {"N1", "J1"}
    monkeypatch.undo()
    same_as_full(spark, live, folder, events(*seen, *batch))


def test_folded_layers_hold_what_a_full_build_holds(spark, live, events, folder, monkeypatch):
    """Extremes are taken back, also by postings that leave a group, before and after layers are folded."""
    monkeypatch.setattr(upkeep, "LAYERS", 2)
    companies, seen = ["Acme", "Beta", "Core"], []
    for stamp in range(1, 4):
        batch = [
            posting(
                str(i), stamp, company_name=companies[(i + stamp) % 3], company_domain=f"d{i % 4}-{stamp // 2}.com",
                company_industry=None if i % 5 == 0 else "Rail", skills=[f"s{i % 3}"], is_remote=i % 2 == 0,
                salary_min=None if i % 7 == 0 else 50000.0 + 1000 * ((i * 7 + stamp * 5) % 13), city="Oslo" if i % 2 else "Bergen",
            )
            for i in range(20) if stamp == 1 or i % 3 == stamp % 3
        ]
        seen += batch
        version = live.apply(events(*batch))
        assert len(version.tables["latest"]) < 2 or stamp == 1
    same_as_full(spark, live, folder, events(*seen))
    keys = [r.fact_key for r in live.table("fact_job_postings").collect()]
    assert sorted(keys) == list(range(1, 21))
    assert live.table("bridge_job_skills").count() == 20


def test_extremes_that_are_taken_back_are_open(spark):
    """Only a lost extreme that no new row reaches asks for the rows."""
    ends = {"low": increment.End(F.col("x")), "high": increment.End(F.col("x"), highest=True)}

    def delta(*rows):
        return increment.delta(spark.createDataFrame(list(rows), f"k string, {increment.SIGN} int, x double"), ["k"], {}, ends)

    state = delta(("a", 1, 1.0), ("a", 1, 5.0), ("b", 1, 2.0), ("b", 1, 3.0), ("c", 1, 4.0), ("d", 1, 7.0), ("d", 1, 8.0))
    state = state.drop("_lost_low", "_lost_high")
    more = delta(("a", -1, 1.0), ("a", 1, 0.5), ("b", -1, 3.0), ("c", -1, 4.0), ("d", -1, 7.0), ("d", 1, 7.0), (None, 1, 1.0))
    after = increment.merged(state, more, ["k"], ends)
    found = {r.k: (r.low, r.high, r[increment.OPEN]) for r in after.collect()}
    assert found["a"] == (0.5, 5.0, False) and found["d"] == (7.0, 8.0, False) and found[None] == (1.0, 1.0, False)
    assert found["b"][2] and "c" not in found
    rows = spark.createDataFrame([("a", 0.1), ("b", 2.0)], "k string, x double")
    whole = {r.k: (r.low, r.high) for r in increment.settled(after, rows, ["k"], ends).collect()}
    assert whole == {"a": (0.5, 5.0), "b": (2.0, 2.0), "d": (7.0, 8.0), None: (1.0, 1.0)}


def test_states_merge_in_any_order(spark):
    changes = spark.createDataFrame(
        [("a", 1, 10.25), ("a", -1, 10.25), ("a", 1, 0.5), ("b", 1, None), (None, 1, 2.0)], f"k string, {increment.SIGN} int, x double"
    )

    def delta(rows):
        return increment.delta(rows, ["k"], {"total": increment.summed("x")})

    whole = delta(changes)
    assert bag(whole, "*") == bag(increment.merged(delta(changes.filter("x > 1")), delta(changes.filter("x <= 1 or x is null")), ["k"]), "*")
    taken_back = increment.merged(whole, delta(changes.withColumn(increment.SIGN, -changes[increment.SIGN])), ["k"])
    assert taken_back.count() == 0


def test_new_names_are_numbered_behind_the_last(spark):
    known = spark.createDataFrame([(1, "b", None), (2, "a", True)], "k long, n string, f boolean")
    names = spark.createDataFrame([("b", None), ("b", True), ("a", True), ("b", True), (None, None)], "n string, f boolean")
    found = increment.new_keys(names, known, "k", 2)
    assert sorted(map(tuple, found.collect())) == [(3, None, None), (4, "b", True)]
