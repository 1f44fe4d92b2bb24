from datetime import datetime

from pyspark.sql import functions as F

from daybook.functions import records
from daybook.functions.times import NO_DATE, instant

V = F.col("v")
DAY = datetime(2024, 1, 1)
LOGS = "array<struct<IsError:string,Content:string,CreatedDate:timestamp>>"


def test_last_item(values):
    assert values([["a", "b"], ["a"], [], None], "array<string>", records.last_item(V)) == ["b", "a", None, None]


def test_failed_status(values):
    items = ["49", "50", "98", "99", None, "", "x"]
    expected = [False, True, True, False, False, False, False]
    assert values(items, "string", records.is_failed_status(V)) == expected


def test_true_flags(values):
    assert values(["True", "true", "1", "TRUE", "0"], "string", records.is_true_flag(V)) == [
        True, True, True, False, False,
    ]


def test_failure_log(values):
    logs = [
        [("True", "a", DAY), ("1", "b", DAY), ("0", "c", DAY)],
        [("0", "c", DAY)],
        [],
        None,
    ]
    found = records.failure_log(F.lit(60), instant("2024-01-01 00:00:00"), V)["Content"]
    assert values(logs, LOGS, found) == ["b", None, None, None]
    not_failed = records.failure_log(F.lit(99), instant("2024-01-01 00:00:00"), V)["Content"]
    assert values(logs[:1], LOGS, not_failed) == [None]
    no_update = records.failure_log(F.lit(60), instant(NO_DATE), V)["Content"]
    assert values(logs[:1], LOGS, no_update) == [None]


def test_expiry(values):
    cut = instant("2024-01-02 17:00:00")
    items = [datetime(2024, 1, 2, 16, 59, 59), datetime(2024, 1, 2, 17), None]
    assert values(items, "timestamp", records.expire(V, cut, F.lit("0"), "4")) == ["4", "0", "0"]


def test_default_pricing(values):
    names = ("P",)
    assert values([" ", "", None, "1"], "string", records.default_pricing(V, F.lit("P"), names)) == [
        "17187", "", None, "1",
    ]
    assert values([" "], "string", records.default_pricing(V, F.lit("Q"), names)) == [" "]
