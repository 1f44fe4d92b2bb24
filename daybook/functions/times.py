"""Instants, their encodings and the date bounds of a run.

All instants are UTC. The business day is UTC+7, so it closes at 17:00 UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The "no date" instant, the business time zone and the output formats.
NO_DATE = "0001-01-01 00:00:00"
BUSINESS_ZONE = "Asia/Bangkok"
MONTH_FORMAT = "yyyy-MM"
LOCAL_FORMAT = "yyyy/MM/dd HH:mm:ss"
DAY_FORMAT = "dd/MM/yyyy"
COMPACT_FORMAT = "yyyyMMddHHmmss"
MICRO_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
BUSINESS_SHIFT = "INTERVAL 7 HOURS"
INGEST_DAYS = 365


def instant(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def real_instant(column: Column) -> Column:
    """The year-1 sentinel means "no date"."""
    return F.nullif(column.cast("timestamp"), instant(NO_DATE))


def real_instant_or(column: Column, run_ts: Column) -> Column:
    """A fixed run time stands in for a missing date, so that re-runs agree."""
    return F.coalesce(real_instant(column), run_ts)


def to_epoch_ms(column: Column) -> Column:
    return F.unix_millis(column)


def from_epoch_ms(column: Column) -> Column:
    """Epoch milliseconds, possibly as text; blanks and other text give null."""
    return F.timestamp_millis(column.try_cast("bigint"))


def month_label(column: Column) -> Column:
    return F.date_format(column, MONTH_FORMAT)


def local_label(column: Column) -> Column:
    return F.date_format(column + F.expr(BUSINESS_SHIFT), LOCAL_FORMAT)


def day_label(column: Column) -> Column:
    return F.date_format(column, DAY_FORMAT)


def compact_label(column: Column) -> Column:
    return F.date_format(column, COMPACT_FORMAT)


def micro_label(column: Column) -> Column:
    return F.date_format(column, MICRO_FORMAT)


def business_time(column: Column) -> Column:
    return F.from_utc_timestamp(column, BUSINESS_ZONE)


def business_day(column: Column) -> Column:
    return (column + F.expr(BUSINESS_SHIFT)).cast("date")


def day_close(run_date: Column) -> Column:
    """17:00 UTC of the day before ``run_date``."""
    return run_date.cast("timestamp") - F.expr(BUSINESS_SHIFT)


def month_close(run_date: Column) -> Column:
    """17:00 UTC of the day before the first of the month."""
    return F.trunc(run_date, "month").cast("timestamp") - F.expr(BUSINESS_SHIFT)


def monthly_window(run_date: Column, calendar_month: bool = False) -> tuple[Column, Column]:
    """The month before ``run_date``.

    Stepping a month back from a shorter month starts early (a March run starts
    on 28 January); ``calendar_month`` starts at the business month instead.
    """
    end = month_close(run_date)
    if calendar_month:
        return month_close(F.add_months(run_date, -1)), end
    return end - F.expr("INTERVAL 1 MONTH"), end


def ingest_window(run_date: Column) -> tuple[Column, Column]:
    end = day_close(run_date)
    return end - F.expr(f"INTERVAL {INGEST_DAYS} DAYS"), end


def cumulative_bounds(run_date: Column) -> dict[str, Column]:
    """Bounds of the cumulative report: the day, month and year that ``run_date`` closes."""
    end = day_close(run_date)
    start_month = month_close(run_date)
    start_year = F.trunc(run_date, "year").cast("timestamp") - F.expr(BUSINESS_SHIFT)
    return {
        "end": end,
        "start_date": end - F.expr("INTERVAL 1 DAY"),
        "start_month": start_month,
        "end_month": start_month + F.expr("INTERVAL 1 MONTH"),
        "start_year": start_year,
        "end_year": start_year + F.expr("INTERVAL 1 YEAR"),
    }
