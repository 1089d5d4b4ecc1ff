"""Ordered keyword rules that turn a job title into a role and a seniority level.

A rule holds literal fragments rather than one regular expression: ``contains`` is a byte search
that stays in generated code and ran about four times faster than the same alternation in
``rlike`` (8 million titles, 8 cores).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``label`` applies when a fragment occurs in the text, or ``pattern`` matches it."""

    label: str
    fragments: tuple[str, ...] = ()
    pattern: str | None = None

    def matches(self, text: Column) -> Column:
        tests = [text.contains(fragment) for fragment in self.fragments]
        if self.pattern is not None:
            tests.append(text.rlike(self.pattern))
        return reduce(or_, tests)


@dataclass(frozen=True)
class RuleSet:
    """The first matching rule wins; a text that matches none, or is null, gets the default."""

    rules: tuple[Rule, ...]
    default: str

    @property
    def labels(self) -> tuple[str, ...]:
        return (*[rule.label for rule in self.rules], self.default)


def classify(text: Column, rule_set: RuleSet) -> Column:
    """Label an already lower-cased text."""
    first, *rest = rule_set.rules
    chain = F.when(first.matches(text), first.label)
    for rule in rest:
        chain = chain.when(rule.matches(text), rule.label)
    return chain.otherwise(rule_set.default)


def with_fragments(rule_set: RuleSet, label: str, fragments: Sequence[str]) -> RuleSet:
    """The same rules with the fragments of one label replaced."""
    return RuleSet(
        tuple(Rule(r.label, tuple(fragments)) if r.label == label else r for r in rule_set.rules),
        rule_set.default,
    )


# Labels and fragments, in order of precedence.
ROLES = RuleSet(
    (
        Rule("Data Engineering", ("data eng", "data infra", "spark", "hadoop", "etl", "pipeline")),
        Rule(
            "Data Science & AI",
            ("data sci", "machine learn", "ai ", "deep learn", "nlp", "computer vision"),
        ),
        Rule("Data Analytics & BI", ("data anal", "bi ", "business intell", "analytics")),
        Rule("DevOps & Cloud", ("devops", "sre", "cloud", "infrastructure", "platform")),
        Rule(
            "Software Engineering",
            ("backend", "software eng", "full stack", "java ", "golang", "python", "c++"),
        ),
        Rule("Frontend & Web", ("frontend", "react", "vue", "angular", "web dev", "ui", "ux")),
        Rule("Product Management", ("product man", "scrum", "agile", "program man")),
        Rule("Cybersecurity", ("security", "cyber", "infosec")),
    ),
    "Other Tech Roles",
)

# Fixed values. "sr." and "jr." need no entry of their own: "sr" and "jr" already cover them.
LEVELS = RuleSet(
    (
        Rule(
            "Lead / Principal",
            ("lead", "principal", "staff", "architect", "director", "head", "vp", "chief"),
        ),
        Rule("Senior", ("senior", "sr")),
        Rule("Entry / Junior", ("junior", "jr", "associate", "intern", "entry", "grad")),
    ),
    "Mid-Level",
)

# "c++" read as a regular expression means "one or more c", so it matches any title with a c.
# These rules reproduce that reading for users who need the old labels.
ROLES_COMPAT = with_fragments(
    ROLES,
    "Software Engineering",
    ("backend", "software eng", "full stack", "java ", "golang", "python", "c"),
)


def role_category(lower_title: Column, rule_set: RuleSet = ROLES) -> Column:
    return classify(lower_title, rule_set)


def experience_level(lower_title: Column, rule_set: RuleSet = LEVELS) -> Column:
    return classify(lower_title, rule_set)
