"""Expressions over the nested fields of one record."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.functions.text import is_space
from daybook.functions.times import real_instant

# Spellings of a true flag, the status span of failed orders, the
# status of an expired certificate and the pricing code given to blank ones.
TRUE_FLAGS = ("True", "true", "1")
FAILED_FROM, FAILED_TO = 50, 98
EXPIRED_STATUS, EXPIRED_DESC = "4", "EXPIRED"
DEFAULT_PRICING_CODE = "17187"


def last_item(items: Column) -> Column:
    """Last array element; null for a null or empty array."""
    return F.try_element_at(items, F.lit(-1))


def last_item_where(items: Column, test: Callable[[Column], Column]) -> Column:
    return last_item(F.filter(items, test))


def is_true_flag(column: Column) -> Column:
    return column.isin(*TRUE_FLAGS)


def is_failed_status(status: Column) -> Column:
    """False, not an error, for blank or non-numeric text."""
    return F.coalesce(status.try_cast("int").between(FAILED_FROM, FAILED_TO), F.lit(False))


def failure_log(status: Column, updated: Column, logs: Column) -> Column:
    """The last error entry of a failed order that has a real update time, else null."""
    entry = last_item_where(logs, lambda log: is_true_flag(log["IsError"]))
    return F.when(real_instant(updated).isNotNull() & is_failed_status(status), entry)


def expire(valid_to: Column, cut: Column, value: Column, expired: str) -> Column:
    """``expired`` once the validity ends before ``cut``."""
    return F.when(valid_to < cut, F.lit(expired)).otherwise(value)


def default_pricing(code: Column, name: Column, names: Iterable[str]) -> Column:
    """A white-space code of one of the personal packages becomes the default code."""
    return F.when(is_space(code) & name.isin(*names), F.lit(DEFAULT_PRICING_CODE)).otherwise(code)
