"""Conditional counters from a rule table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def indicator(test: Column) -> Column:
    """0/1 flag; an unknown test counts as 0."""
    return F.coalesce(test, F.lit(False)).cast("int")


def count_combinations(rows: DataFrame, by: Iterable[str], weight: Column | None = None) -> DataFrame:
    """Rows per combination of group key, rule arm and flags, as ``n``.

    Combinations are few, so partial aggregation shrinks the input to a handful
    of rows per group before anything is shuffled, however hot a group is.
    """
    counted = F.count("*") if weight is None else F.sum(weight)
    return rows.groupBy(*by).agg(counted.alias("n"))


def apply_rules(
    combinations: DataFrame, key: str, metrics: Iterable[str], rules: Mapping[str, list[str]]
) -> DataFrame:
    """One weighted conditional sum per metric; a metric without a rule stays 0.

    Rules are SQL tests over the combination columns, so that a rule table reads as data.
    """
    sums = [
        F.expr(f"sum(if({' or '.join(rules.get(metric, ['false']))}, n, 0)) as `{metric}`") for metric in metrics
    ]
    return combinations.groupBy(key).agg(*sums)
