"""One display city per posting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens.functions.text import blank_to_null

REMOTE = "Remote"


def city_or_remote(is_remote: Column, location_raw: str, city: str, country: str) -> Column:
    says_remote = F.lower(location_raw).contains("remote")
    onsite = F.initcap(F.coalesce(blank_to_null(city), blank_to_null(country)))
    return F.when(is_remote | says_remote, REMOTE).otherwise(F.coalesce(onsite, F.lit(REMOTE)))
