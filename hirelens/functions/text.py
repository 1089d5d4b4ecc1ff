"""String clean-up shared by the CSV normaliser and the Silver layer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trimmed(column: str | Column) -> Column:
    return F.trim(F.col(column) if isinstance(column, str) else column)


def blank_to_null(column: str | Column) -> Column:
    return F.nullif(trimmed(column), F.lit(""))


def not_blank(column: str | Column) -> Column:
    """True or false, never null."""
    return F.coalesce(trimmed(column) != "", F.lit(False))


def skill_tag(column: str | Column) -> Column:
    """The form in which a skill is counted: lower case without outer blanks."""
    return F.lower(trimmed(column))


def skill_tags(skills: str) -> Column:
    """All countable skills of a posting, repeats kept, blanks and nulls left out."""
    return F.filter(F.transform(skills, skill_tag), lambda tag: tag != "")


def size_or_zero(array: str) -> Column:
    return F.coalesce(F.size(array), F.lit(0))
