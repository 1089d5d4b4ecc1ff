"""Annual pay from a pay range and a pay period.

The arithmetic runs in DECIMAL, so that rounding at half a cent is exact and a result never
depends on the order in which doubles were added.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(20,6)"

# Periods per year, and the band of salaries taken to be real.
PERIODS_PER_YEAR = {"hour": 2080, "month": 12, "week": 52, "day": 260}
SINGLE_BOUND_PERIODS = ("hour", "month")
LOWEST_SALARY, HIGHEST_SALARY = 10_000.0, 1_500_000.0


def _factor(period: Column, names: tuple[str, ...]) -> Column:
    chain = F.lit(1)
    for name in names:
        chain = F.when(period == name, F.lit(PERIODS_PER_YEAR[name])).otherwise(chain)
    return chain.cast("decimal(4,0)")


def annualized(low: str, high: str, unit: Column) -> Column:
    """Mid-point of the range, or its only bound, times the periods per year.

    ``unit`` is the lower-cased period. With one bound missing only hourly and monthly pay is
    scaled. A value too large for the decimal type becomes null, which is what the outlier rule
    makes of it anyway.
    """
    lo, hi = F.col(low), F.col(high)
    lo_money, hi_money = lo.try_cast(MONEY), hi.try_cast(MONEY)
    middle = (lo_money + hi_money) * F.lit(0.5).cast("decimal(2,1)")
    both = middle * _factor(unit, tuple(PERIODS_PER_YEAR))
    one = F.when(lo.isNotNull(), lo_money).otherwise(hi_money) * _factor(unit, SINGLE_BOUND_PERIODS)
    amount = F.when(lo.isNotNull() & hi.isNotNull(), F.round(both, 2)).otherwise(F.round(one, 2))
    return amount.cast("double")


def within_band(salary: Column) -> Column:
    """The salary if it lies in the band, else null. The row itself is kept."""
    return F.when(salary.between(LOWEST_SALARY, HIGHEST_SALARY), salary)
