"""Dashboard filters in which one word switches a condition off."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the choice that means "no condition".
ANY = "All"


def where_selected(df: DataFrame, choices: Mapping[str, str]) -> DataFrame:
    """Keep rows equal to every choice except ``All``. Booleans compare as ``true``/``false``.

    Conditions that are switched off never enter the plan; the others are plain equalities, which
    reach the parquet scan.
    """
    types = dict(df.dtypes)
    for column, choice in choices.items():
        if choice == ANY:
            continue
        if types[column] == "boolean":
            wanted = {"true": True, "false": False}.get(choice)
            df = df.filter(F.lit(False) if wanted is None else F.col(column) == wanted)
        else:
            df = df.filter(F.col(column) == choice)
    return df
