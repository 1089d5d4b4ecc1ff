"""Every query with a DuckDB counterpart returns the same bag of rows."""

import compare
import pytest
from helpers import SMALL

import __spark_entry__ as contract

ORACLE = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return compare.oracle(SMALL)


@pytest.mark.parametrize("name", list(ORACLE))
def test_same_rows(spark, duck, name):
    spark_rows = compare.spark_bag(contract.queries()[name](spark, SMALL))
    assert compare.difference(spark_rows, compare.duck_bag(duck, ORACLE[name])) is None


@pytest.mark.parametrize("name", [n for n in contract.queries() if n not in ORACLE])
def test_others_return_rows(spark, name):
    assert not contract.queries()[name](spark, SMALL).isEmpty()


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns[0] == "role_category"
    assert result.count() > 0


def test_oracle_names_are_queries():
    assert set(ORACLE) <= set(contract.queries())
