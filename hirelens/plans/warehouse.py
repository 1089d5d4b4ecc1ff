"""Twenty business questions over the Gold tables.

Two habits keep these cheap on a large fact table. Facts are grouped by a dimension's key first and
joined to the dimension afterwards, so a join sees one row per key and a busy employer or skill is
already combined in the map tasks. And top lists break ties by the surrogate key: keys number the
names in order, so the limit can come before the join and only its k rows are looked up.

``role`` is the exception: its dimension has a few dozen rows, fixed by the rule labels, and is
broadcast.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.functions import aggregates as A
from hirelens.operators.topk import top

Tables = Callable[[str], DataFrame]

# Thresholds, list lengths and labels of the questions.
PAYING_SKILL_MENTIONS = 50
REMOTE_SKILL_MENTIONS = 30
HIGH_SALARY = 150_000.0
FIRST_YEAR_AFTER = 2000
DATA_ROLES = ("Data Engineering", "Data Science & AI")
LEADERS = "Lead / Principal"
PLACELESS = ("Remote", "Unspecified")
BREADTH_TIERS = (
    (0, 0, "0 Skills Listed"),
    (1, 2, "1-2 Skills (Low)"),
    (3, 5, "3-5 Skills (Medium)"),
    (6, 10, "6-10 Skills (High)"),
)
BREADTH_REST = "10+ Skills (Extensive)"

PAY = "annual_salary_usd"


def breadth_tier(skills_count: Column) -> Column:
    tier = F.lit(BREADTH_REST)
    for low, high, label in reversed(BREADTH_TIERS):
        tier = F.when(skills_count.between(low, high), label).otherwise(tier)
    return tier


def _fact(t: Tables) -> DataFrame:
    return t("fact_job_postings")


def _paid(t: Tables) -> DataFrame:
    return _fact(t).filter(F.col(PAY).isNotNull())


def _with_role(rows: DataFrame, t: Tables) -> DataFrame:
    return rows.join(F.broadcast(t("dim_job_role")), "role_key")


def _skill_facts(t: Tables, *columns: str) -> DataFrame:
    """Bridge and fact side by side; both are bucketed by job id, so neither moves."""
    return t("bridge_job_skills").join(_fact(t).select("job_id", *columns), "job_id")


def _parts() -> list[Column]:
    """Mergeable pieces of a count, an average and a remote share."""
    return [
        F.count("*").alias("n"),
        A.total(PAY).alias("pay"),
        F.count(PAY).alias("paid"),
        F.count_if("is_remote").alias("remote"),
    ]


def _average() -> Column:
    return A.ratio(F.col("pay"), F.col("paid"), 2)


def _remote_share() -> Column:
    return A.percent(F.col("remote"), F.col("n"))


def q01_kpi(t: Tables) -> DataFrame:
    return _fact(t).agg(
        F.count("*").alias("total_job_postings"),
        A.mean(PAY).alias("avg_annual_salary_usd"),
        F.count_distinct("company_key").alias("total_hiring_companies"),
        A.percent_if(F.col("is_remote")).alias("overall_remote_pct"),
    )


def q02_top_skills(t: Tables) -> DataFrame:
    by_key = _skill_facts(t, PAY, "is_remote").groupBy("skill_key").agg(*_parts())
    leaders = top(by_key, 15, [F.col("n").desc(), F.col("skill_key")])
    return (
        t("dim_skill")
        .join(F.broadcast(leaders), "skill_key")
        .select(
            "skill_name",
            F.col("n").alias("total_mentions"),
            _average().alias("avg_salary_with_skill"),
            _remote_share().alias("remote_pct"),
        )
        .orderBy(F.col("total_mentions").desc(), "skill_name")
    )


def q03_paying_skills(t: Tables) -> DataFrame:
    paid = _paid(t).select("job_id", PAY)
    by_key = (
        t("bridge_job_skills")
        .join(paid, "job_id")
        .groupBy("skill_key")
        .agg(
            F.count("*").alias("sample_size"),
            A.mean(PAY).alias("avg_salary_usd"),
            A.lowest(PAY).alias("min_salary_usd"),
            A.highest(PAY).alias("max_salary_usd"),
        )
        .filter(F.col("sample_size") >= PAYING_SKILL_MENTIONS)
    )
    leaders = top(by_key, 15, [F.col("avg_salary_usd").desc(), F.col("skill_key")])
    named = t("dim_skill").join(F.broadcast(leaders), "skill_key").drop("skill_key")
    return named.orderBy(F.col("avg_salary_usd").desc(), "skill_name")


def q04_role_benchmark(t: Tables) -> DataFrame:
    return (
        _with_role(_paid(t), t)
        .groupBy("role_category")
        .agg(
            F.count("*").alias("total_openings"),
            A.mean(PAY).alias("avg_salary_usd"),
            A.lowest(PAY).alias("min_salary_usd"),
            A.highest(PAY).alias("max_salary_usd"),
        )
        .orderBy(F.col("avg_salary_usd").desc(), "role_category")
    )


def q05_seniority(t: Tables) -> DataFrame:
    return (
        _with_role(_paid(t), t)
        .groupBy("experience_level")
        .agg(
            F.count("*").alias("role_count"),
            A.mean(PAY).alias("avg_salary_usd"),
            A.mean_int("skills_count", 1).alias("avg_skills_required"),
        )
        .orderBy("avg_salary_usd", "experience_level")
    )


def q06_hubs(t: Tables) -> DataFrame:
    by_key = _fact(t).groupBy("location_key").agg(*_parts())
    places = t("dim_location").filter(~F.col("city").isin(*PLACELESS))
    merged = (
        by_key.join(places, "location_key")
        .groupBy("city", "country")
        .agg(*[F.sum(name).alias(name) for name in ("n", "pay", "paid", "remote")])
    )
    hubs = merged.select(
        "city",
        "country",
        F.col("n").alias("total_jobs"),
        _average().alias("avg_salary_usd"),
        _remote_share().alias("remote_pct"),
    )
    return top(hubs, 10, [F.col("total_jobs").desc(), F.col("city"), F.col("country")])


def q07_remote_by_role(t: Tables) -> DataFrame:
    remote = F.col("is_remote")
    return (
        _with_role(_fact(t), t)
        .groupBy("role_category")
        .agg(
            F.count_if(remote).alias("remote_jobs"),
            F.count_if(~remote).alias("onsite_jobs"),
            A.percent_if(remote).alias("remote_pct"),
        )
        .orderBy(F.col("remote_pct").desc(), "role_category")
    )


def q08_companies(t: Tables) -> DataFrame:
    by_key = _fact(t).groupBy("company_key").agg(*_parts())
    leaders = top(by_key, 20, [F.col("n").desc(), F.col("company_key")])
    return (
        t("dim_company")
        .join(F.broadcast(leaders), "company_key")
        .select(
            "company_name",
            "company_industry",
            F.col("n").alias("active_postings"),
            _average().alias("avg_salary_usd"),
            _remote_share().alias("remote_friendly_pct"),
        )
        .orderBy(F.col("active_postings").desc(), "company_name")
    )


def q09_remote_premium(t: Tables) -> DataFrame:
    remote = F.col("is_remote")

    def exact(condition: Column) -> Column:
        pay = F.when(condition, F.col(PAY))
        return F.try_divide(A.total(pay), F.count(pay))

    return (
        _with_role(_paid(t), t)
        .groupBy("role_category")
        .agg(exact(remote).alias("remote"), exact(~remote).alias("onsite"))
        .select(
            "role_category",
            F.round("remote", 2).cast("double").alias("avg_remote_salary"),
            F.round("onsite", 2).cast("double").alias("avg_onsite_salary"),
            F.round(F.col("remote") - F.col("onsite"), 2)
            .cast("double")
            .alias("remote_salary_delta"),
        )
        .orderBy(F.col("remote_salary_delta").desc(), "role_category")
    )


def _dated(t: Tables, *columns: str) -> DataFrame:
    """Facts after the first year, with date columns.

    Date keys read yyyymmdd, so the year condition is also one on the fact's own key, where it
    reaches the scan. The date dimension has one row per calendar day.
    """
    recent = _fact(t).filter(F.col("date_key") > FIRST_YEAR_AFTER * 10_000 + 1231)
    days = t("dim_date").filter(F.col("year") > FIRST_YEAR_AFTER).select("date_key", *columns)
    return recent.join(days, "date_key")


def q10_monthly(t: Tables) -> DataFrame:
    return (
        _dated(t, "year", "month", "month_name")
        .groupBy("year", "month", "month_name")
        .agg(F.count("*").alias("total_postings"), A.mean(PAY).alias("avg_salary_usd"))
        .orderBy("year", "month")
    )


def q11_data_skills(t: Tables) -> DataFrame:
    roles = t("dim_job_role").filter(F.col("role_category").isin(*DATA_ROLES))
    by_key = (
        _skill_facts(t, PAY, "role_key")
        .join(F.broadcast(roles.select("role_key", "role_category")), "role_key")
        .groupBy("role_category", "skill_key")
        .agg(F.count("*").alias("skill_demand_count"), A.mean(PAY).alias("avg_salary"))
    )
    first = top(
        by_key,
        20,
        [F.col("role_category"), F.col("skill_demand_count").desc(), F.col("skill_key")],
    )
    named = t("dim_skill").join(F.broadcast(first), "skill_key")
    return named.select("role_category", "skill_name", "skill_demand_count", "avg_salary").orderBy(
        "role_category", F.col("skill_demand_count").desc(), "skill_name"
    )


def q12_high_remote(t: Tables) -> DataFrame:
    wanted = _fact(t).filter(F.col("is_remote") & (F.col(PAY) >= HIGH_SALARY))
    return (
        _with_role(wanted, t)
        .groupBy("role_category")
        .agg(F.count("*").alias("high_paying_remote_jobs"), A.mean(PAY).alias("avg_salary_usd"))
        .orderBy(F.col("high_paying_remote_jobs").desc(), "role_category")
    )


def q13_top5_levels(t: Tables) -> DataFrame:
    """One pass over the fact: a company's counts by role, of which there are few, stay with its total."""
    counts = _fact(t).groupBy("company_key", "role_key").agg(F.count("*").alias("n"))
    companies = counts.groupBy("company_key").agg(
        F.sum("n").alias("total"), F.collect_list(F.struct("role_key", "n")).alias("roles")
    )
    leaders = top(companies, 5, [F.col("total").desc(), F.col("company_key")])
    levels = (
        _with_role(leaders.select("company_key", F.inline("roles")), t)
        .groupBy("company_key", "experience_level")
        .agg(F.sum("n").alias("total_jobs"))
    )
    # five companies by a handful of levels
    named = t("dim_company").select("company_key", "company_name")
    return named.join(F.broadcast(levels), "company_key").drop("company_key").orderBy(
        "company_name", F.col("total_jobs").desc(), "experience_level"
    )


def q14_remote_skills(t: Tables) -> DataFrame:
    by_key = (
        _skill_facts(t, "is_remote")
        .groupBy("skill_key")
        .agg(
            F.count("*").alias("total_postings"),
            A.percent_if(F.col("is_remote")).alias("remote_percentage"),
        )
        .filter(F.col("total_postings") >= REMOTE_SKILL_MENTIONS)
    )
    leaders = top(by_key, 15, [F.col("remote_percentage").desc(), F.col("skill_key")])
    named = t("dim_skill").join(F.broadcast(leaders), "skill_key").drop("skill_key")
    return named.orderBy(F.col("remote_percentage").desc(), "skill_name")


def q15_quarterly(t: Tables) -> DataFrame:
    return (
        _with_role(_dated(t, "year", "quarter"), t)
        .groupBy("year", "quarter", "role_category")
        .agg(F.count("*").alias("quarterly_openings"))
        .orderBy("year", "quarter", F.col("quarterly_openings").desc(), "role_category")
    )


def q16_skill_breadth(t: Tables) -> DataFrame:
    return (
        _paid(t)
        .groupBy(breadth_tier(F.col("skills_count")).alias("skill_breadth_tier"))
        .agg(F.count("*").alias("job_count"), A.mean(PAY).alias("avg_annual_salary"))
        .orderBy(F.col("avg_annual_salary").desc(), "skill_breadth_tier")
    )


def q17_industry(t: Tables) -> DataFrame:
    by_key = _paid(t).groupBy("company_key").agg(F.count("*").alias("n"), A.total(PAY).alias("pay"))
    industries = t("dim_company").select("company_key", "company_industry")
    merged = (
        by_key.join(industries.filter(F.col("company_industry").isNotNull()), "company_key")
        .groupBy("company_industry")
        .agg(
            F.sum("n").alias("total_jobs"),
            A.ratio(F.sum("pay"), F.sum("n"), 2).alias("avg_salary_usd"),
        )
    )
    return top(merged, 15, [F.col("avg_salary_usd").desc(), F.col("company_industry")])


def q18_dispersion(t: Tables, deviation: str = "population") -> DataFrame:
    return (
        _with_role(_paid(t), t)
        .groupBy("role_category")
        .agg(
            A.mean(PAY).alias("avg_salary"),
            A.spread(PAY).alias("salary_spread"),
            A.deviation(PAY, deviation).alias("salary_std_dev"),
        )
        .orderBy(F.col("salary_std_dev").desc(), "role_category")
    )


def q19_employment(t: Tables) -> DataFrame:
    return (
        _fact(t)
        .groupBy("employment_type")
        .agg(
            F.count("*").alias("posting_count"),
            A.mean(PAY).alias("avg_salary_usd"),
            A.percent_if(F.col("is_remote")).alias("remote_pct"),
        )
        .orderBy(F.col("posting_count").desc(), "employment_type")
    )


def q20_leadership(t: Tables) -> DataFrame:
    roles = t("dim_job_role").filter(F.col("experience_level") == LEADERS)
    by_key = (
        _fact(t)
        .join(F.broadcast(roles), "role_key")
        .groupBy("location_key", "role_category")
        .agg(*_parts())
    )
    places = t("dim_location").filter(F.col("city") != PLACELESS[0])
    merged = (
        by_key.join(places, "location_key")
        .groupBy("city", "role_category")
        .agg(*[F.sum(name).alias(name) for name in ("n", "pay", "paid")])
        .select(
            "city",
            "role_category",
            F.col("n").alias("leadership_openings"),
            _average().alias("avg_leadership_salary"),
        )
    )
    order = [F.col("leadership_openings").desc(), F.col("city"), F.col("role_category")]
    return top(merged, 15, order)


QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    query.__name__: query
    for query in (
        q01_kpi, q02_top_skills, q03_paying_skills, q04_role_benchmark, q05_seniority,
        q06_hubs, q07_remote_by_role, q08_companies, q09_remote_premium, q10_monthly,
        q11_data_skills, q12_high_remote, q13_top5_levels, q14_remote_skills, q15_quarterly,
        q16_skill_breadth, q17_industry, q18_dispersion, q19_employment, q20_leadership,
    )
}
