"""Job postings projected from the order tables.

The test data holds no postings, so each order becomes one: the customer is the employer, the
nation the city, the brands on its lines the skills. Some rows are made untidy on purpose (blank
ids, padded or missing text, repeats, unparsable dates) by rules on the order key. Everything is a
projection and grows with the orders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens import schemas

# Titles, pay periods, and price factors that bring each period near a real salary.
TITLES = (
    "Senior Data Engineer",
    "Machine Learning Scientist",
    "BI Developer Analytics",
    "DevOps Lead",
    "Backend Developer",
    "Frontend Dev",
    "Product Manager",
    "Security Analyst",
    "Nurse",
    "Junior Python Dev",
    "Staff Spark Engineer",
    "Internal Auditor",
)
PERIODS = ("year", "HOUR", "month", "week", "day")
PRICE_FACTORS = ("1.0000", "0.0005", "0.0800", "0.0200", "0.0040")
CURRENCIES = ("usd", " EUR ", None, "GBP")
FIRST_INGESTION = 1_009_843_200  # 2002-01-01 in epoch seconds
SYSTEMS = ("greenhouse", "lever", " workday ")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: tuple[str | None, ...], index: Column) -> Column:
    listed = F.array(*[F.lit(value).cast("string") for value in values])
    return F.get(listed, F.pmod(index, F.lit(len(values))).cast("int"))


def _every(key: Column, n: int, remainder: int = 0) -> Column:
    return key % n == remainder


def _unless(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


def brands_per_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct brands of each order, sorted. The set per order is bounded by the brand list."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    joined = lines.join(parts, lines.l_partkey == parts.p_partkey)
    return joined.groupBy("l_orderkey").agg(
        F.sort_array(F.collect_set("p_brand")).alias("brands")
    )


def _skills(k: Column) -> Column:
    padded = F.transform("brands", lambda b: F.concat(F.lit(" "), F.upper(b), F.lit(" ")))
    shown = F.when(_every(k, 10), padded).otherwise(F.col("brands"))
    extra = F.array(F.lit("  "), F.lower(F.get("brands", 0)))
    return F.when(_every(k, 60), F.concat(shown, extra)).otherwise(shown)


def _iso(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed event rows in the layout of ``schemas.EVENT``."""
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    brands = brands_per_order(spark, sf_dir)
    base = (
        orders.join(customers, orders.o_custkey == customers.c_custkey)
        .join(nations, customers.c_nationkey == nations.n_nationkey)
        .join(regions, nations.n_regionkey == regions.r_regionkey)
        .join(brands, orders.o_orderkey == brands.l_orderkey, "left")
    )
    k = F.col("o_orderkey")
    # Copy 1 repeats the row exactly; copy 2 is a later post of the same id under another title.
    versions = F.concat(
        F.array(F.lit(0)),
        F.when(_every(k, 50), F.array(F.lit(1))).otherwise(F.array().cast("array<int>")),
        F.when(_every(k, 75), F.array(F.lit(2))).otherwise(F.array().cast("array<int>")),
    )
    copies = base.withColumn("copy", F.explode(versions))
    later = F.when(F.col("copy") == 2, 1).otherwise(0)

    plain_id = F.concat(F.lit("J"), k.cast("string"))
    job_id = (
        F.when(_every(k, 1009, 5), "  ")
        .when(_every(k, 1009, 6), F.lit(None))
        .when(_every(k, 97, 3), F.concat(F.lit(" "), plain_id, F.lit(" ")))
        .otherwise(plain_id)
    )
    factor = _pick(PRICE_FACTORS, k).cast("decimal(6,4)")
    price = F.col("o_totalprice").cast("decimal(18,2)")
    balance = F.abs("c_acctbal").cast("decimal(18,2)")
    low = F.round(price * factor, 2).cast("double")
    high = F.round((price + balance).cast("decimal(18,2)") * factor, 2).cast("double")
    # Ingested one posting per second, in key order; a later post comes six hours after.
    ingested = F.timestamp_seconds(FIRST_INGESTION + k + later * 6 * 3600)
    order_time = F.col("o_orderdate").cast("timestamp")

    columns = {
        "job_id": job_id,
        "company_name": _unless(
            _every(k, 53),
            F.when(_every(k, 31), F.concat(F.lit("  "), "c_name")).otherwise(F.col("c_name")),
        ),
        "company_domain": _unless(
            _every(k, 13),
            F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit(".example.com")),
        ),
        "company_industry": _unless(_every(F.col("c_custkey"), 29), F.col("c_mktsegment")),
        "ats": _pick(SYSTEMS, k),
        "ats_token": F.concat(F.lit("tok-"), F.col("c_custkey").cast("string")),
        "title": F.when(_every(k, 1013, 7), " ").otherwise(_pick(TITLES, k + later)),
        "department": F.lit(None).cast("string"),
        "location_raw": F.when(
            _every(k, 17), F.concat(F.lit("REMOTE - "), F.col("r_name"))
        ).otherwise(F.concat("n_name", F.lit(", "), "r_name")),
        "country": _unless(_every(k, 23), F.col("r_name")),
        "city": _unless(_every(k, 19), F.concat(F.lit(" "), F.lower("n_name"), F.lit(" "))),
        "is_remote": _unless(_every(k, 41), F.col("o_orderstatus") == "O"),
        "employment_type": _unless(_every(k, 37), F.col("o_orderpriority")),
        "salary_min": _unless(_every(k, 7), low),
        "salary_max": _unless(_every(k, 11), high),
        "salary_currency": _pick(CURRENCIES, k),
        "salary_period": _unless(_every(k, 43), _pick(PERIODS, k)),
        "salary_from_text": _every(k, 2),
        "skills": _skills(k),
        "posted_at": _unless(
            _every(k, 101), F.when(_every(k, 211), "soon").otherwise(_iso(order_time))
        ),
        "scraped_at": _iso(order_time + F.make_interval(days=F.lit(1))),
        "url": F.concat(F.lit("https://jobs.example.com/"), k.cast("string")),
        "ingestion_timestamp": _unless(
            _every(k, 103), _iso(ingested)
        ),
    }
    typed = schemas.EVENT
    return copies.select(
        *[columns[f.name].cast(f.dataType).alias(f.name) for f in typed.fields]
    )


def postings_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as a CSV export would hold them: text only, skills joined by bars."""
    rows = postings(spark, sf_dir)
    as_text = {
        "skills": F.array_join("skills", "|"),
        "is_remote": F.when(F.col("is_remote"), " Yes ").when(~F.col("is_remote"), "0"),
        "salary_min": F.coalesce(F.format_string("%.2f", F.col("salary_min")), F.lit("NaN")),
        "salary_max": F.coalesce(F.format_string(" %.2f ", F.col("salary_max")), F.lit("none")),
    }
    return rows.select(
        *[
            as_text.get(name, F.col(name).cast("string")).alias(name)
            for name in schemas.RAW_FIELDS
        ]
    )


def postings_as_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as stream messages, and one broken message for every 500th order."""
    rows = postings(spark, sf_dir)
    good = rows.select(
        F.to_json(F.struct(*rows.columns)).alias("value"),
        F.coalesce(
            F.col("ingestion_timestamp").try_cast("timestamp"), F.lit("2002-01-01").cast("timestamp")
        ).alias("timestamp"),
    )
    orders = table(spark, sf_dir, "orders")
    broken = orders.filter(_every(F.col("o_orderkey"), 500)).select(
        F.concat(F.lit('{"job_id": "B'), F.col("o_orderkey").cast("string")).alias("value"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
    )
    return good.unionByName(broken)
