from datetime import datetime

from daybook.plans.labels import Labels
from daybook.plans.reports import (
    METRICS,
    cumulative_headers,
    cumulative_report,
    display_cumulative,
    display_order_state,
    order_state_report,
    signing_report,
)
from daybook.plans.run import Run

RUN = Run.on("2025-05-15")
END = datetime(2025, 5, 14, 17)
START_DATE = datetime(2025, 5, 13, 17)
START_MONTH = datetime(2025, 4, 30, 17)
START_YEAR = datetime(2024, 12, 31, 17)
MS = "2025-05-14 16:59:59.999"

CREDENTIAL = (
    "row_key string, info struct<locality_code:string,valid_from:timestamp,valid_to:timestamp,"
    "status:string,pricing_code:string,source:string>"
)
CERT = (
    "row_key string, info struct<credential_id:string,locality_code:string,pricing_code:string,"
    "created_date:timestamp,status:string,request_type:string>"
)


def cumulative(spark, credentials=(), certs=()):
    credentials = [(f"c{i}", c) for i, c in enumerate(credentials)]
    certs = [(f"r{i}", c) for i, c in enumerate(certs)]
    report = cumulative_report(spark.createDataFrame(credentials, CREDENTIAL), spark.createDataFrame(certs, CERT), RUN)
    return {
        r["locality_code"]: {m: r[m] for m in METRICS if r[m]} for r in report.collect()
    }


LATER = datetime(2026, 1, 1)


def test_names_and_number_of_counters():
    assert len(METRICS) == 37
    assert METRICS[:6] == ["total", "total_pm", "total_ps", "total_year", "total_pm_year", "total_ps_year"]
    assert METRICS[12:15] == ["total_extend", "total_pm_extend", "total_ps_extend"]
    assert METRICS[24:27] == ["total_year_expired", "total_pm_year_expired", "total_ps_year_expired"]
    assert METRICS[-4:] == ["total_vneid", "total_vneid_date", "total_online", "total_online_date"]


def test_valid_pm_by_age(spark):
    got = cumulative(
        spark,
        [
            ("today", START_DATE, LATER, "0", "1", "3"),
            ("month", START_MONTH, LATER, "0", "1", "3"),
            ("year", START_YEAR, LATER, "0", "1", "3"),
            ("older", datetime(2024, 12, 31, 16, 59, 59, 999000), LATER, "0", "1", "3"),
            ("tomorrow", END, LATER, "0", "1", "3"),
        ],
    )
    total = {"total": 1, "total_pm": 1}
    year = {"total_year": 1, "total_pm_year": 1}
    month = {"total_month": 1, "total_pm_month": 1}
    day = {"total_date": 1, "total_pm_date": 1}
    assert got == {
        "today": total | year | month | day,
        "month": total | year | month,
        "year": total | year,
        "older": total,
        "tomorrow": total,
    }


def test_expired(spark):
    got = cumulative(
        spark,
        [
            # A validity that ends with the day is over; one that ends later is not.
            ("pm at end", START_YEAR, END, "0", "1", "3"),
            ("pm today", START_YEAR, START_DATE, "0", "1", "3"),
            ("pm before", START_YEAR, datetime(2024, 12, 1), "0", "1", "3"),
            # Personal packages are dated by their creation.
            ("ps", START_MONTH, datetime(2025, 5, 1), "0", "17187", "3"),
            ("inactive", START_YEAR, START_DATE, "1", "1", "3"),
        ],
    )
    year = {"total_year_expired": 1, "total_pm_year_expired": 1}
    month = {"total_month_expired": 1, "total_pm_month_expired": 1}
    day = {"total_date_expired": 1, "total_pm_date_expired": 1}
    assert got == {
        "pm at end": year | month,
        "pm today": year | month | day,
        "pm before": {},
        "ps": {
            "total_year_expired": 1, "total_ps_year_expired": 1, "total_month_expired": 1, "total_ps_month_expired": 1,
        },
        "inactive": {},
    }


def test_origin_and_required_dates(spark):
    got = cumulative(
        spark,
        [
            ("eid", START_DATE, LATER, "1", "1", "4"),
            ("agent", START_DATE, LATER, "1", "1", "3"),
            ("online", START_YEAR, LATER, "1", "1", None),
            ("undated", None, LATER, "0", "1", "4"),
            ("undated", START_DATE, None, "0", "1", "4"),
            (None, START_DATE, LATER, "0", "1", "4"),
            ("", START_DATE, LATER, "0", "1", "3"),
        ],
    )
    assert got.pop("")["total"] == 1
    assert got == {"eid": {"total_vneid": 1, "total_vneid_date": 1}, "agent": {}, "online": {"total_online": 1}}


def test_certs(spark):
    credentials = [
        ("home", START_YEAR, LATER, "0", "17187", "3"),  # c0, valid PS
        ("home", START_YEAR, LATER, "0", "1", "3"),  # c1, PM
        ("home", START_YEAR, LATER, "1", "18046", "3"),  # c2, inactive
        ("home", START_YEAR, END, "0", "18046", "3"),  # c3, expired
    ]
    certs = [
        ("c0", "new", "17187", START_DATE, "5", "0"),
        ("c0", "new", "18046", START_YEAR, "5", "0"),
        ("c1", "not held", "17187", START_DATE, "5", "0"),
        ("c2", "not held", "17187", START_DATE, "5", "0"),
        ("c3", "not held", "17187", START_DATE, "5", "0"),
        (None, "not held", "17187", START_DATE, "5", "0"),
        ("c9", "extended", "17187", START_MONTH, "5", "1"),
        ("c9", "extended", "1", START_DATE, "5", "0"),
        ("c9", "extended", None, END, "5", "1"),
        ("c0", "skipped", "17187", None, "5", "0"),
        ("c0", "skipped", "17187", START_DATE, "4", "0"),
        ("c0", "skipped", "17187", START_DATE, "5", "2"),
    ]
    got = cumulative(spark, credentials, certs)
    assert set(got) == {"home", "new", "not held", "extended"}
    assert got["not held"] == {}
    assert got["new"] == {
        "total": 2, "total_ps": 2, "total_year": 2, "total_ps_year": 2, "total_month": 1, "total_ps_month": 1,
        "total_date": 1, "total_ps_date": 1,
    }
    assert got["extended"] == {
        "total_extend": 3, "total_ps_extend": 1, "total_pm_extend": 2,
        "total_year_extend": 2, "total_ps_year_extend": 1, "total_pm_year_extend": 1,
        "total_month_extend": 2, "total_ps_month_extend": 1, "total_pm_month_extend": 1,
        "total_date_extend": 1, "total_pm_date_extend": 1,
    }


def test_class_totals_add_up(spark):
    credentials = [
        ("x", START_YEAR, LATER, "0", code, "3") for code in ("17187", "18046", "1", "2", None)
    ]
    certs = [(f"c{i % 5}", "x", code, START_DATE, "5", kind) for i, code in enumerate(("17187", "1")) for kind in "01"]
    got = cumulative(spark, credentials, certs)["x"]
    for suffix in ("", "_extend", "_year", "_date_extend"):
        assert got.get(f"total{suffix}", 0) == got.get(f"total_pm{suffix}", 0) + got.get(f"total_ps{suffix}", 0)


def test_headers_follow_the_columns(spark):
    labels = Labels("Acme", "Pen")
    headers = cumulative_headers(RUN, labels)
    assert list(headers) == ["locality_code", *METRICS]
    assert headers["total_date_extend"] == "Sản lượng CTS GH trong ngày 14/05/2025"
    assert "Acme Pen" in headers["total"]
    empty = cumulative_report(spark.createDataFrame([], CREDENTIAL), spark.createDataFrame([], CERT), RUN)
    shown = display_cumulative(empty, RUN, labels)
    assert shown.columns == list(headers.values()) and shown.count() == 0


TRANSACTION = "row_key string, info struct<app_id:string,app_name:string,req_time:timestamp,status:string>"


def test_signing(spark):
    inside, edge = datetime(2025, 3, 30, 17), datetime(2025, 4, 30, 17)
    rows = [
        ("2", ("a", "second", inside, "1")),
        ("1", ("a", None, inside, "0")),
        ("10", ("a", "first", inside, "1")),
        ("3", ("b", None, datetime(2025, 4, 30, 16, 59, 59, 999000), None)),
        ("4", ("a", "edge", edge, "1")),
        ("5", (None, "no client", inside, "1")),
        ("6", ("a", "april", datetime(2025, 4, 1), "1")),
    ]
    got = {tuple(r) for r in signing_report(spark.createDataFrame(rows, TRANSACTION), RUN).collect()}
    stamp = "2025/05/15 00:00:00"
    assert got == {
        (stamp, "a", "first", "2025-03", 2, 1),
        (stamp, "a", "april", "2025-04", 1, 0),
        (stamp, "b", None, "2025-04", 0, 1),
    }


ORDER = (
    "row_key string, info struct<identity_id:string,locality_code:string,phone:string,full_name:string,uid:string,"
    "ma_tb:string,ma_gd:string,address:string,created_date:timestamp,updated_date:timestamp,log_content:string,"
    "log_created_date:timestamp,client_name:string,type_desc:string,status:string,status_desc:string,"
    "pricing_code:string,pricing_name:string,pricing_price:string>"
)
USER = (
    "row_key string, info struct<create_date:timestamp>, register struct<province_id:string,phone:string,"
    "full_name:string,uid:string,address:string,create_date:timestamp,modified_date:timestamp,status:string,"
    "status_desc:string>"
)


def test_order_state(spark):
    inside, outside = datetime(2025, 4, 10, 18), datetime(2025, 3, 1)

    def order(key, identity, created, updated, log=None):
        return (key, (identity, "HN", "None", "n", "u", "tb", "gd", None, created, updated, log, inside if log else None,
                      "web", "t", "52", "own", "17187", "p", "1.00"))

    orders = [
        order("created", "u1", inside, None),
        order("updated", "u2", outside, inside, "boom"),
        order("neither", "u3", outside, outside),
    ]
    register = ("7", "1", "n", "u", "a", inside, None, "3", "own")
    users = [
        ("u1", (inside,), register),
        ("u2", (inside,), register),
        ("u3", (inside,), register),
        ("u4", None, register),
        ("u5", (outside,), register),
        ("u6", (inside,), None),
        ("u7", (inside,), ("x", None, "None", "u", "a", inside, outside, "", "own")),
    ]
    dictionary = spark.createDataFrame(
        [("status", "CertOrder", 52, "failed", 0), ("status", "Register", 3, "done", 1)],
        "type string, table string, code int, description_vi string, position int",
    )
    localities = spark.createDataFrame([(7, "P7", 1)], "province_id int, province_code string, ward_id int")
    report = order_state_report(
        spark.createDataFrame(orders, ORDER), spark.createDataFrame(users, USER), dictionary, localities, RUN
    )
    rows = sorted(map(tuple, report.collect()))
    day, local = "30/04/2025", "2025/04/11 01:00:00"
    head = ("HN", "", "n", "u", "tb", "gd", "")
    tail = ("failed", "", "17187", "p", "1.00", "")
    placed = (day, "P7", "1", "n", "u", "", "", "a", local, local, "", "", "done", "done", "", "", "", "done")
    assert rows == sorted(
        [
            (day, *head, local, "", "web", "t", *tail),
            (day, *head, "2025/03/01 07:00:00", local, "web", "t", "failed", "boom", *tail[2:]),
            placed,
            placed,
            (day, "x", "", "", "u", "", "", "a", local, "2025/03/01 07:00:00", "", "", "own", "own", "", "", "", "own"),
        ]
    )
    assert len(display_order_state(report).columns) == 18
