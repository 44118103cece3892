"""Ordered rules: the first one that fails decides.

The verdict on all rows is only the number of the failing rule. Its wording is
built later, for the rejected rows alone: inside the main pass it would bloat the
generated code past what the JVM compiles.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    rule_id: str
    failed: Column
    description: Column


def first_failure(rules: list[Rule]) -> Column:
    """Position of the first failing rule, NULL if all hold."""
    out = F.when(rules[0].failed, F.lit(0))
    for i, r in enumerate(rules[1:], start=1):
        out = out.when(r.failed, F.lit(i))
    return out


def explanation(rules: list[Rule], position: Column) -> tuple[Column, Column]:
    """Rule id and message of a position given by ``first_failure``."""
    rule_id = message = None
    for i, r in enumerate(rules):
        hit = position == i
        rule_id = F.when(hit, r.rule_id) if rule_id is None else rule_id.when(hit, r.rule_id)
        message = (F.when(hit, r.description) if message is None
                   else message.when(hit, r.description))
    return rule_id.alias("rule_id"), message.alias("rule_description")


def quote(before: str, value: Column, after: str) -> Column:
    """Message with the offending value in it."""
    return F.concat(F.lit(before), F.coalesce(value.cast("string"), F.lit("None")), F.lit(after))


def split_by_verdict(df: DataFrame, verdict: str) -> tuple[DataFrame, DataFrame]:
    """Valid rows and rejected rows."""
    return df.filter(F.col(verdict).isNull()), df.filter(F.col(verdict).isNotNull())
