"""Time-window predicates. They stay bare comparisons so that they reach the scan."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def touched_in(created: Column, updated: Column, start: Column, end: Column) -> Column:
    """Created or updated since ``start``, and created before ``end``."""
    return ((created >= start) | (updated >= start)) & (created < end)


def half_open(column: Column, start: Column, end: Column, null_passes: bool = False) -> Column:
    inside = (column >= start) & (column < end)
    return column.isNull() | inside if null_passes else inside


def overlaps(
    from_time: Column, to_time: Column, start: Column | None = None, end: Column | None = None
) -> Column:
    """``[from_time, to_time]`` meets ``[start, end]``; a bound that is None is open."""
    test = F.lit(True)
    if start is not None:
        test = test & (to_time >= start)
    if end is not None:
        test = test & (from_time <= end)
    return test
