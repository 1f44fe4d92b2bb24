"""What identifies a run. Nothing inside a plan asks the clock."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.functions.times import cumulative_bounds, day_close, ingest_window, instant, monthly_window


@dataclass(frozen=True)
class Run:
    """A run date and, for stamps, a run time (UTC)."""

    run_date: date
    run_time: datetime | None = None
    calendar_month: bool = False

    @classmethod
    def on(cls, text: str, **options) -> Run:
        return cls(date.fromisoformat(text), **options)

    @property
    def date_column(self) -> Column:
        return F.lit(self.run_date.isoformat()).cast("date")

    @property
    def time(self) -> datetime:
        return self.run_time or datetime.combine(self.run_date, datetime.min.time())

    @property
    def time_column(self) -> Column:
        return instant(self.time.isoformat(" "))

    @property
    def day_close(self) -> Column:
        return day_close(self.date_column)

    @property
    def ingest_window(self) -> tuple[Column, Column]:
        return ingest_window(self.date_column)

    @property
    def monthly_window(self) -> tuple[Column, Column]:
        return monthly_window(self.date_column, self.calendar_month)

    @property
    def cumulative_bounds(self) -> dict[str, Column]:
        return cumulative_bounds(self.date_column)

    @property
    def closed_day(self) -> date:
        """The calendar day (UTC) the daily bounds end on."""
        return self.run_date - timedelta(days=1)

    @property
    def closed_month_end(self) -> date:
        return self.run_date.replace(day=1) - timedelta(days=1)
