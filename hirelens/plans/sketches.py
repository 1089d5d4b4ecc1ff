"""Distinct employers for any choice of filters, from stored sketches instead of the postings.

A HyperLogLog sketch of the employers is kept for every month, role, city and workplace. Sketches
merge, so a panel unions the few that its filters choose, and an increment appends its own; a
posting that is taken back stays counted until its month is sketched anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.operators.wildcard import where_selected
from hirelens.plans.dashboards import Choices

#: log2 of the registers; the relative standard error of an estimate is about 1.04 / sqrt(2 ^ LG).
LG = 12
KEYS = ("month", "role_category", "city", "is_remote")


def error() -> float:
    """Three standard errors."""
    return 3 * 1.04 / 2 ** (LG / 2)


def sketched(mart: DataFrame) -> DataFrame:
    """One sketch of company names per month, role, city and workplace; combined before the shuffle."""
    month = F.date_trunc("month", "posted_date").cast("date").alias("month")
    rows = mart.select(month, *KEYS[1:], "company_name")
    return rows.groupBy(*KEYS).agg(F.hll_sketch_agg("company_name", F.lit(LG)).alias("companies"))


def merged() -> Column:
    """The estimate over all sketches of a group."""
    return F.hll_sketch_estimate(F.hll_union_agg("companies"))


def distinct_companies(sketches: DataFrame, choices: Choices = {}) -> DataFrame:
    """The number of employers among the postings that the filters choose; zero without any."""
    chosen = where_selected(sketches, choices)
    return chosen.agg(F.coalesce(merged(), F.lit(0)).cast("double").alias("value"))
