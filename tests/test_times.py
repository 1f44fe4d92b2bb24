from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from daybook.functions import times
from daybook.operators.windows import half_open, overlaps, touched_in
from daybook.plans.run import Run

V = F.col("v")
NORMAL = datetime(2024, 3, 5, 6, 7, 8, 9000)


def text(column):
    return column.cast("string")


def test_sentinel_is_no_date(values):
    # The year-1 instant goes in as text: the driver's own conversion may not hold it.
    stored = F.when(F.col("i") == 0, times.instant(times.NO_DATE)).otherwise(V)
    assert values([None, None, NORMAL], "timestamp", text(times.real_instant(stored))) == [
        None, None, "2024-03-05 06:07:08.009",
    ]


def test_sentinel_or_run_time(values):
    now = times.instant("2024-01-01 00:00:00")
    assert values([None, NORMAL], "timestamp", text(times.real_instant_or(V, now))) == [
        "2024-01-01 00:00:00", "2024-03-05 06:07:08.009",
    ]


def test_epoch_text(values):
    assert values(["1709618828009", "", "None", None], "string", text(times.from_epoch_ms(V))) == [
        "2024-03-05 06:07:08.009", None, None, None,
    ]


def test_labels(values):
    late = datetime(2024, 12, 31, 17, 0, 0, 123456)
    assert values([late], "timestamp", times.month_label(V)) == ["2024-12"]
    assert values([late], "timestamp", times.local_label(V)) == ["2025/01/01 00:00:00"]
    assert values([late], "timestamp", times.day_label(V)) == ["31/12/2024"]
    assert values([late], "timestamp", times.compact_label(V)) == ["20241231170000"]
    assert values([late], "timestamp", times.micro_label(V)) == ["2024-12-31 17:00:00.123456"]
    assert values([late], "timestamp", times.business_day(V).cast("string")) == ["2025-01-01"]


# run date -> monthly window, daily close, start_month, end_month, start_year, end_year
BOUNDS = {
    "2025-05-01": ("2025-03-30", "2025-04-30", "2025-04-30", "2025-04-30", "2025-05-30", "2024-12-31", "2025-12-31"),
    "2025-03-01": ("2025-01-28", "2025-02-28", "2025-02-28", "2025-02-28", "2025-03-28", "2024-12-31", "2025-12-31"),
    "2025-03-31": ("2025-01-28", "2025-02-28", "2025-03-30", "2025-02-28", "2025-03-28", "2024-12-31", "2025-12-31"),
    "2025-01-01": ("2024-11-30", "2024-12-31", "2024-12-31", "2024-12-31", "2025-01-31", "2024-12-31", "2025-12-31"),
}


@pytest.mark.parametrize("day", BOUNDS)
def test_bounds(spark, day):
    run = Run.on(day)
    b = run.cumulative_bounds
    columns = [*run.monthly_window, b["end"], b["start_month"], b["end_month"], b["start_year"], b["end_year"]]
    row = spark.range(1).select([text(c).alias(str(i)) for i, c in enumerate(columns)]).first()
    assert tuple(row) == tuple(f"{d} 17:00:00" for d in BOUNDS[day])


def test_calendar_month_option_and_days(spark):
    start, end = Run.on("2025-03-10", calendar_month=True).monthly_window
    assert tuple(spark.range(1).select(text(start), text(end)).first()) == (
        "2025-01-31 17:00:00", "2025-02-28 17:00:00",
    )
    run = Run.on("2025-03-01")
    assert (run.closed_day, run.closed_month_end) == (date(2025, 2, 28), date(2025, 2, 28))
    start, end = run.ingest_window
    assert tuple(spark.range(1).select(text(start), text(end)).first()) == (
        "2024-02-29 17:00:00", "2025-02-28 17:00:00",
    )


START, END = times.instant("2024-01-01 17:00:00"), times.instant("2024-01-31 17:00:00")
AT_START, BEFORE_START = datetime(2024, 1, 1, 17), datetime(2024, 1, 1, 16, 59, 59, 999000)
AT_END, BEFORE_END = datetime(2024, 1, 31, 17), datetime(2024, 1, 31, 16, 59, 59, 999000)


def test_half_open(values):
    items = [BEFORE_START, AT_START, BEFORE_END, AT_END, None]
    kept = [False, True, True, False]
    assert values(items, "timestamp", F.coalesce(half_open(V, START, END), F.lit(False))) == [*kept, False]
    assert values(items, "timestamp", half_open(V, START, END, null_passes=True)) == [*kept, True]


def test_touched(spark):
    rows = [
        (BEFORE_START, None, False),
        (BEFORE_START, AT_START, True),
        (BEFORE_START, BEFORE_START, False),
        (AT_START, None, True),
        (BEFORE_END, AT_END, True),
        (AT_END, AT_END, False),
        (None, AT_START, False),
    ]
    frame = spark.createDataFrame(rows, "c timestamp, u timestamp, kept boolean")
    test = F.coalesce(touched_in(F.col("c"), F.col("u"), START, END), F.lit(False))
    assert frame.filter(test != F.col("kept")).count() == 0


def test_overlap_with_open_bounds(spark):
    spans = spark.createDataFrame(
        [("ends at start", BEFORE_START, AT_START), ("starts at end", AT_END, AT_END), ("before", BEFORE_START, BEFORE_START)],
        "name string, f timestamp, t timestamp",
    )

    def names(start, end):
        return {r.name for r in spans.filter(overlaps(F.col("f"), F.col("t"), start, end)).collect()}

    assert names(START, END) == {"ends at start", "starts at end"}
    assert names(START, None) == {"ends at start", "starts at end"}
    assert names(None, START) == {"ends at start", "before"}
    assert names(None, None) == {"ends at start", "starts at end", "before"}
