import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
ROOT = os.path.dirname(os.path.dirname(HERE))
sys.path[:0] = [ROOT, os.path.dirname(HERE), HERE]


@pytest.fixture(autouse=True, scope="session")
def code_for_workers(spark):
    """Python workers find the repository wherever the tests were started."""
    spark.sparkContext.environment["PYTHONPATH"] = ROOT


@pytest.fixture
def docs(spark):
    """documents from (doc_id, text, lang, source) or shorter tuples, with a column that clashes with helpers."""

    def build(*rows):
        full = [(r + (None,) * 4)[:4] for r in rows]
        table = spark.createDataFrame(full, "doc_id long, text string, lang string, source string")
        return table.selectExpr("*", "length(text) AS n_chars", "1 AS node", "2 AS value", "'x' AS doc", "3 AS slot", "'y' AS tie", "4 AS __at0")

    return build
