"""The same results in DuckDB SQL, for comparison.

Each statement starts from the driver's tables and repeats the adapter, the Silver rules and the
star schema as common table expressions; only those a query uses are evaluated.
"""

from __future__ import annotations

import re

from hirelens import schemas
from hirelens.functions import rules
from hirelens.plans import mart, silver
from hirelens.sources import driver_tables as adapter

# --- snippets ---------------------------------------------------------------------------------


def quoted(value) -> str:
    return "NULL" if value is None else "'" + str(value).replace("'", "''") + "'"


def listed(values) -> str:
    return "[" + ", ".join(quoted(value) for value in values) + "]"


def rounded(total: str, count: str, unit: int, digits: int) -> str:
    """total / (count * unit), half up, from exact integers."""
    scale, whole = 10**digits, f"(NULLIF({count}, 0) * {unit})"
    return f"CAST((2 * {total} * {scale} + {whole}) // (2 * {whole}) AS DOUBLE) / {scale}"


def cents(column: str) -> str:
    return f"CAST(CAST({column} AS DECIMAL(18,2)) * 100 AS HUGEINT)"


def mean(column: str, digits: int = 2) -> str:
    return rounded(f"SUM({cents(column)})", f"COUNT({column})", 100, digits)


def mean_int(column: str, digits: int) -> str:
    return rounded(f"SUM(CAST({column} AS HUGEINT))", f"COUNT({column})", 1, digits)


def percent(condition: str, digits: int = 2) -> str:
    hits = f"CAST(100 * COUNT(CASE WHEN {condition} THEN 1 END) AS HUGEINT)"
    return rounded(hits, "COUNT(*)", 1, digits)


def proper_case(text: str) -> str:
    words = f"string_split(lower({text}), ' ')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1:1]) || w[2:]), ' ')"


def labelled(text: str, rule_set: rules.RuleSet) -> str:
    cases = " ".join(
        f"WHEN regexp_matches({text}, "
        + quoted("|".join(re.sub(r"\+", "[+]", part) for part in rule.fragments))
        + f") THEN {quoted(rule.label)}"
        for rule in rule_set.rules
    )
    return f"CASE {cases} ELSE {quoted(rule_set.default)} END"


def or_default(text: str, field: str) -> str:
    return f"coalesce({text}, {quoted(silver.DEFAULTS[field])})"


# --- common table expressions -----------------------------------------------------------------

K = "o_orderkey"
ISO = "%Y-%m-%dT%H:%M:%SZ"
FACTOR = (
    "CAST(list_extract(" + listed(adapter.PRICE_FACTORS) + f", {K} % 5 + 1) AS DECIMAL(6,4))"
)
PRICE = "CAST(o_totalprice AS DECIMAL(18,2))"
BALANCE = "CAST(abs(c_acctbal) AS DECIMAL(18,2))"


def picked(values, index: str) -> str:
    return f"list_extract({listed(values)}, ({index}) % {len(values)} + 1)"


BRANDS = """
SELECT l_orderkey, list_sort(list(DISTINCT p_brand)) AS brands
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey"""

POSTINGS = f"""
SELECT
  CASE WHEN {K} % 1009 = 5 THEN '  ' WHEN {K} % 1009 = 6 THEN NULL
       WHEN {K} % 97 = 3 THEN ' J' || {K} || ' ' ELSE 'J' || {K} END AS job_id,
  CASE WHEN {K} % 53 <> 0
       THEN CASE WHEN {K} % 31 = 0 THEN '  ' ELSE '' END || c_name END AS company_name,
  CASE WHEN {K} % 13 <> 0 THEN 'c' || c_custkey || '.example.com' END AS company_domain,
  CASE WHEN c_custkey % 29 <> 0 THEN c_mktsegment END AS company_industry,
  {picked(adapter.SYSTEMS, K)} AS ats,
  'tok-' || c_custkey AS ats_token,
  CASE WHEN {K} % 1013 = 7 THEN ' ' ELSE
       {picked(adapter.TITLES, f"{K} + CASE WHEN copy = 2 THEN 1 ELSE 0 END")} END AS title,
  CAST(NULL AS VARCHAR) AS department,
  CASE WHEN {K} % 17 = 0 THEN 'REMOTE - ' || r_name ELSE n_name || ', ' || r_name END
       AS location_raw,
  CASE WHEN {K} % 23 <> 0 THEN r_name END AS country,
  CASE WHEN {K} % 19 <> 0 THEN ' ' || lower(n_name) || ' ' END AS city,
  CASE WHEN {K} % 41 <> 0 THEN o_orderstatus = 'O' END AS is_remote,
  CASE WHEN {K} % 37 <> 0 THEN o_orderpriority END AS employment_type,
  CASE WHEN {K} % 7 <> 0 THEN CAST(round({PRICE} * {FACTOR}, 2) AS DOUBLE) END AS salary_min,
  CASE WHEN {K} % 11 <> 0 THEN
       CAST(round(CAST({PRICE} + {BALANCE} AS DECIMAL(18,2)) * {FACTOR}, 2) AS DOUBLE) END
       AS salary_max,
  {picked(adapter.CURRENCIES, K)} AS salary_currency,
  CASE WHEN {K} % 43 <> 0 THEN {picked(adapter.PERIODS, K)} END AS salary_period,
  {K} % 2 = 0 AS salary_from_text,
  CASE WHEN brands IS NULL THEN NULL
       ELSE list_concat(
         CASE WHEN {K} % 10 = 0
              THEN list_transform(brands, lambda b: ' ' || upper(b) || ' ') ELSE brands END,
         CASE WHEN {K} % 60 = 0 THEN ['  ', lower(brands[1])]
              ELSE CAST([] AS VARCHAR[]) END) END AS skills,
  CASE WHEN {K} % 101 = 0 THEN NULL WHEN {K} % 211 = 0 THEN 'soon'
       ELSE strftime(o_orderdate, '{ISO}') END AS posted_at,
  strftime(o_orderdate + INTERVAL 1 DAY, '{ISO}') AS scraped_at,
  'https://jobs.example.com/' || {K} AS url,
  CASE WHEN {K} % 103 <> 0 THEN strftime(
       TIMESTAMP '2002-01-01' + to_seconds({K} + CASE WHEN copy = 2 THEN 21600 ELSE 0 END),
       '{ISO}') END
       AS ingestion_timestamp
FROM orders
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
LEFT JOIN brands ON {K} = l_orderkey
JOIN (VALUES (0), (1), (2)) copies(copy)
  ON copy = 0 OR (copy = 1 AND {K} % 50 = 0) OR (copy = 2 AND {K} % 75 = 0)"""

_TIES = ", ".join(f"{name} ASC NULLS FIRST" for name in silver.USED_FIELDS if name != "job_id")
LATEST = f"""
SELECT * EXCLUDE (job_id, place), trim(job_id) AS job_id FROM (
  SELECT *, row_number() OVER (PARTITION BY trim(job_id)
    ORDER BY ingestion_timestamp DESC NULLS LAST, {_TIES}) AS place
  FROM postings WHERE trim(job_id) <> '') WHERE place = 1"""

CITY = (
    "CASE WHEN is_remote OR lower(location_raw) LIKE '%remote%' THEN 'Remote' "
    f"ELSE coalesce({proper_case('trim(city)')}, {proper_case('trim(country)')}, 'Remote') END"
)


def annual(low: str = "salary_min", high: str = "salary_max") -> str:
    lo, hi = f"CAST({low} AS DECIMAL(20,6))", f"CAST({high} AS DECIMAL(20,6))"
    unit = "lower(salary_period)"
    full = "CASE " + " ".join(
        f"WHEN {unit} = '{name}' THEN CAST({n} AS DECIMAL(4,0))"
        for name, n in {"hour": 2080, "month": 12, "week": 52, "day": 260}.items()
    )
    single = (
        f"CASE WHEN {unit} = 'hour' THEN CAST(2080 AS DECIMAL(4,0)) "
        f"WHEN {unit} = 'month' THEN CAST(12 AS DECIMAL(4,0)) ELSE CAST(1 AS DECIMAL(4,0)) END"
    )
    return (
        f"CAST(CASE WHEN {low} IS NOT NULL AND {high} IS NOT NULL "
        f"THEN round(({lo} + {hi}) * CAST(0.5 AS DECIMAL(2,1)) "
        f"* {full} ELSE CAST(1 AS DECIMAL(4,0)) END, 2) "
        f"ELSE round(coalesce({lo}, {hi}) * {single}, 2) END AS DOUBLE)"
    )


def in_band(value: str) -> str:
    return f"CASE WHEN {value} BETWEEN 10000 AND 1500000 THEN {value} END"


POSTED_RAW = "coalesce(posted_at, ingestion_timestamp)"
POSTED_DATE = f"TRY_CAST(substr({POSTED_RAW}, 1, 10) AS DATE)"

SILVER = f"""
SELECT job_id,
  trim({or_default("company_name", "company_name")}) AS company_name,
  trim(company_domain) AS company_domain,
  trim({or_default("company_industry", "company_industry")}) AS company_industry,
  trim(ats) AS ats,
  trim(title) AS title,
  {labelled("lower(title)", rules.ROLES)} AS role_category,
  {labelled("lower(title)", rules.LEVELS)} AS experience_level,
  trim(department) AS department,
  {CITY} AS city_normalized,
  {or_default(proper_case("trim(country)"), "country")} AS country_normalized,
  coalesce(is_remote, false) AS is_remote,
  {or_default("lower(trim(employment_type))", "employment_type")} AS employment_type,
  salary_min, salary_max,
  {or_default("upper(trim(salary_currency))", "salary_currency")} AS salary_currency,
  {or_default("lower(trim(salary_period))", "salary_period")} AS salary_period,
  {in_band(annual())} AS annual_salary_usd,
  skills,
  CAST(coalesce(len(skills), 0) AS INTEGER) AS skills_count,
  {POSTED_DATE} AS posted_date,
  {POSTED_RAW} AS posted_at_raw,
  url
FROM latest"""

TEXT_FIELDS = [
    name
    for name in schemas.RAW_FIELDS
    if name not in ("is_remote", "salary_from_text", "salary_min", "salary_max", "skills")
]


def _blank(name: str) -> str:
    cleaned = f"nullif(trim({name}), '')"
    if name == "employment_type":
        cleaned = f"coalesce({cleaned}, 'full_time')"
    return f"{cleaned} AS {name}"


NORMALIZED = (
    "SELECT " + ", ".join(_blank(name) for name in TEXT_FIELDS) + ", "
    "coalesce(is_remote, false) AS is_remote, salary_from_text, salary_min, salary_max, "
    "CASE WHEN skills IS NULL THEN CAST([] AS VARCHAR[]) ELSE list_filter(list_transform(skills, "
    "lambda s: trim(s)), lambda s: s <> '') END AS skills FROM postings"
)

CSV_POSTINGS = f"SELECT *, scraped_at AS ingestion_timestamp FROM ({NORMALIZED})"
CSV_LATEST = LATEST.replace("FROM postings", "FROM csv_postings")
CSV_SILVER = SILVER.replace("FROM latest", "FROM csv_latest")

MENTIONS = """
SELECT * FROM (
  SELECT job_id, annual_salary_usd, is_remote, role_category,
         lower(trim(unnest(skills))) AS skill_name FROM silver) WHERE skill_name <> ''"""

DIM_COMPANY = """
SELECT CAST(row_number() OVER (ORDER BY company_name) AS BIGINT) AS company_key, *
FROM (SELECT company_name,
        arg_min_null(company_domain, job_id) AS company_domain,
        arg_min_null(company_industry, job_id) AS company_industry,
        count(*) AS total_jobs_posted
      FROM silver GROUP BY company_name)"""

DIM_JOB_ROLE = """
SELECT CAST(row_number() OVER (ORDER BY role_category, experience_level) AS BIGINT) AS role_key, *
FROM (SELECT DISTINCT role_category, experience_level FROM silver)"""

DIM_LOCATION = """
SELECT CAST(row_number() OVER (ORDER BY city, country, is_remote) AS BIGINT) AS location_key, *
FROM (SELECT DISTINCT city_normalized AS city, country_normalized AS country, is_remote
      FROM silver)"""

DIM_DATE = """
SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key, full_date,
  CAST(year(full_date) AS INTEGER) AS year, CAST(month(full_date) AS INTEGER) AS month,
  CAST(day(full_date) AS INTEGER) AS day, CAST(quarter(full_date) AS INTEGER) AS quarter,
  dayname(full_date) AS day_name, monthname(full_date) AS month_name
FROM (SELECT DISTINCT posted_date AS full_date FROM silver WHERE posted_date IS NOT NULL)"""

DIM_SKILL = """
SELECT CAST(row_number() OVER (ORDER BY skill_name) AS BIGINT) AS skill_key, skill_name
FROM (SELECT DISTINCT skill_name FROM mentions)"""

FACT = """
SELECT CAST(row_number() OVER (ORDER BY posted_date NULLS FIRST, job_id) AS BIGINT) AS fact_key,
  CAST(coalesce(strftime(posted_date, '%Y%m%d'), '19700101') AS INTEGER) AS date_key,
  job_id, company_key, role_key, location_key, title, annual_salary_usd, salary_min, salary_max,
  salary_currency, employment_type, is_remote, skills_count, url
FROM (SELECT *, city_normalized AS city, country_normalized AS country FROM silver)
LEFT JOIN (SELECT location_key, city, country, is_remote FROM dim_location)
  USING (city, country, is_remote)
LEFT JOIN dim_job_role USING (experience_level, role_category)
LEFT JOIN (SELECT company_key, company_name FROM dim_company) USING (company_name)"""

BRIDGE = "SELECT job_id, skill_key FROM mentions JOIN dim_skill USING (skill_name)"


def _shown(source: str, name: str) -> str:
    return f"coalesce(nullif({source}, ''), {quoted(mart.SHOWN_WHEN_EMPTY[name])}) AS {name}"


MART = f"""
SELECT coalesce(job_id, '') AS job_id, {_shown("company_name", "company_name")},
  {_shown("title", "title")}, {_shown("role_category", "role_category")},
  {_shown("experience_level", "experience_level")}, {_shown("city_normalized", "city")},
  {_shown("country_normalized", "country")}, is_remote,
  {_shown("employment_type", "employment_type")}, annual_salary_usd,
  CASE WHEN skills_count = 0 THEN 1 ELSE skills_count END AS skills_count,
  coalesce(array_to_string(skills, ', '), '') AS skills_list,
  {_shown("skills[1]", "primary_skill")}, posted_date
FROM silver"""

FEATURES = """
SELECT job_id, coalesce(role_category, 'Other Tech Roles') AS role_category,
  coalesce(experience_level, 'Mid-Level') AS experience_level,
  coalesce(city_normalized, 'Remote') AS city_normalized,
  coalesce(lower(trim(employment_type)), 'full_time') AS employment_type,
  coalesce(lower(trim(skills[1])), 'general') AS primary_skill,
  CASE WHEN is_remote THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_remote_double,
  CAST(skills_count AS DOUBLE) AS skills_count_double,
  annual_salary_usd AS label
FROM silver"""

#: Postings arrive in four batches, by the hour of their stamp; those without one in the first.
BATCHES = 4
BATCH = f"coalesce(CAST(substr(ingestion_timestamp, 12, 2) AS INTEGER) % {BATCHES}, 0)"


def silver_of(condition: str) -> str:
    """Silver as built from the postings that meet a condition."""
    some = LATEST.replace("FROM postings", f"FROM (SELECT * FROM postings WHERE {condition})")
    return SILVER.replace("FROM latest", f"FROM ({some})")


def keys_by_arrival(key: str, names: dict[str, str], source: str = "{silver}") -> str:
    """Keys numbered by the batch that first brought a name, then by the name."""
    columns = ", ".join(f"{column} AS {name}" for column, name in names.items())
    seen = " UNION ALL ".join(
        f"SELECT {columns}, {b} AS batch FROM ({source.format(silver=silver_of(f'{BATCH} <= {b}'))})"
        for b in range(BATCHES)
    )
    listed_names = ", ".join(names.values())
    return (
        f"SELECT CAST(row_number() OVER (ORDER BY first_batch, {listed_names}) AS BIGINT) AS {key}, "
        f"{listed_names} FROM (SELECT {listed_names}, min(batch) AS first_batch FROM ({seen}) GROUP BY ALL)"
    )


CTES = {
    "brands": BRANDS,
    "postings": POSTINGS,
    "latest": LATEST,
    "silver": SILVER,
    "csv_postings": CSV_POSTINGS,
    "csv_latest": CSV_LATEST,
    "csv_silver": CSV_SILVER,
    "mentions": MENTIONS,
    "dim_company": DIM_COMPANY,
    "dim_job_role": DIM_JOB_ROLE,
    "dim_location": DIM_LOCATION,
    "dim_date": DIM_DATE,
    "dim_skill": DIM_SKILL,
    "fact": FACT,
    "bridge": BRIDGE,
    "mart": MART,
    "features": FEATURES,
}


def _needed(select: str) -> list[str]:
    """The expressions a statement uses, directly or through others."""
    found: set[str] = set()
    open_texts = [select]
    while open_texts:
        words = set(re.findall(r"[a-z_]+", open_texts.pop()))
        for name in words & CTES.keys() - found:
            found.add(name)
            open_texts.append(CTES[name])
    return [name for name in CTES if name in found]


def statement(select: str) -> str:
    parts = [f"{name} AS MATERIALIZED ({CTES[name]})" for name in _needed(select)]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + select
