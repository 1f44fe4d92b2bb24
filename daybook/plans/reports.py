"""The three periodic reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.text import blank_if_absent
from daybook.functions.times import local_label, month_label
from daybook.operators.counters import apply_rules, count_combinations, indicator
from daybook.operators.lookups import decode_province, decode_status, status_entries
from daybook.operators.windows import half_open
from daybook.plans.labels import Labels
from daybook.plans.run import Run
from daybook.sources.parquet import typed

# Codes the reports test for, and the packages counted as personal (PS).
SIGNED = "1"
PS_CODES = ("17187", "18046")
ACTIVE = "0"
ISSUED, NEW, EXTENSION = "5", "0", "1"
SOURCE_EID, SOURCE_AGENT = "4", "3"

# Report columns.
SIGNING_DDL = "data_report string, client_id string, client_name string, month string, success int, un_success int"
ORDER_STATE_COLUMNS = (
    "ngay_lay_dl ma_tinh sdt_lh ten_kh so_gt ma_tb ma_don_hang dia_chi_ct ngay_tao_don "
    "ngay_thuc_hien kenh_ban loai_yeu_cau ly_do_gd nguyen_nhan toc_do_id ten_goi_cuoc "
    "gia_goi_cuoc trang_thai_tk"
).split()
ORDER_STATE_DDL = ", ".join(f"{name} string" for name in ORDER_STATE_COLUMNS)


# --- signing by client and month -------------------------------------------------


def signing_report(transactions: DataFrame, run: Run) -> DataFrame:
    """Successful and other signings of the month, per client and month.

    Sums per client, month and name run as one hash aggregate that does not read the
    keys. Which name came first is asked only for the few clients and months that
    have several, in a scan of names and keys alone.
    """
    start, end = run.monthly_window
    in_month = (
        transactions.select("row_key", "info.app_id", "info.app_name", "info.req_time", "info.status")
        .filter(half_open(F.col("req_time"), start, end) & F.col("app_id").isNotNull())
        .select("row_key", F.col("app_id").alias("client_id"), month_label(F.col("req_time")).alias("month"), "app_name", "status")
    )
    signed = F.coalesce(F.col("status") == SIGNED, F.lit(False))
    totals = (
        in_month.groupBy("client_id", "month", "app_name")
        .agg(F.sum(signed.cast("int")).alias("success"), F.sum((~signed).cast("int")).alias("un_success"))
        .groupBy("client_id", "month")
        .agg(
            F.sum("success").alias("success"),
            F.sum("un_success").alias("un_success"),
            F.count("app_name").alias("names"),
            F.max("app_name").alias("some_name"),
        )
    )
    several = totals.filter("names > 1").select("client_id", "month")
    first = (
        in_month.filter(F.col("app_name").isNotNull())
        .join(several, ["client_id", "month"], "left_semi")
        .groupBy("client_id", "month")
        .agg(F.min_by("app_name", "row_key").alias("first_name"))
    )
    report = totals.join(first, ["client_id", "month"], "left").select(
        F.lit(f"{run.time:%Y/%m/%d %H:%M:%S}").alias("data_report"),
        "client_id",
        F.coalesce("first_name", "some_name").alias("client_name"),
        "month",
        "success",
        "un_success",
    )
    return typed(report, SIGNING_DDL)


# --- cumulative certificates by locality -----------------------------------------

PERIODS = ("year", "month", "date")
CLASSES = ("", "_pm", "_ps")


def _metric_names() -> list[str]:
    names = []
    for suffix in ("", "_extend"):
        for period in ("", *(f"_{p}" for p in PERIODS)):
            names += [f"total{c}{period}{suffix}" for c in CLASSES]
    for period in PERIODS:
        names += [f"total{c}_{period}_expired" for c in CLASSES]
    return names + ["total_vneid", "total_vneid_date", "total_online", "total_online_date"]


METRICS = _metric_names()
CUMULATIVE_DDL = "date_report date, locality_code string, " + ", ".join(f"{m} int" for m in METRICS)


def _rules() -> dict[str, list[str]]:
    """Metric -> tests over (arm, origin, created_*, expired_*)."""
    rules: dict[str, list[str]] = {}

    def rule(metric: str, test: str, flag: str | None = None) -> None:
        rules.setdefault(metric, []).append(test if flag is None else f"({test} and {flag} = 1)")

    # (arm, class, metric suffix, flag that dates it)
    dated = [
        ("pm_valid", "_pm", "", "created"),
        ("ps_new", "_ps", "", "created"),
        ("pm_extend", "_pm", "_extend", "created"),
        ("ps_extend", "_ps", "_extend", "created"),
        ("pm_expired", "_pm", "_expired", "expired"),
        # Expired personal packages are dated by their creation.
        ("ps_expired", "_ps", "_expired", "created"),
    ]
    for arm, kind, suffix, flag in dated:
        for c in ("", kind):
            if suffix != "_expired":
                rule(f"total{c}{suffix}", f"arm = '{arm}'")
            for period in PERIODS:
                rule(f"total{c}_{period}{suffix}", f"arm = '{arm}'", f"{flag}_{period}")
    for origin in ("vneid", "online"):
        rule(f"total_{origin}", f"origin = '{origin}'")
        rule(f"total_{origin}_date", f"origin = '{origin}'", "created_date")
    return rules


CREATED = [f"created_{p}" for p in PERIODS]
EXPIRED = [f"expired_{p}" for p in PERIODS]
COMBINATION = ["locality_code", "arm", "origin", *CREATED, *EXPIRED]


def _created_flags(at: Column, bounds: dict[str, Column]) -> list[Column]:
    return [
        indicator(half_open(at, bounds[f"start_{p}"], bounds["end"])).alias(f"created_{p}") for p in PERIODS
    ]


def _expired_flags(at: Column, bounds: dict[str, Column]) -> list[Column]:
    ends = {"year": bounds["end_year"], "month": bounds["end_month"], "date": bounds["end"]}
    return [indicator(half_open(at, bounds[f"start_{p}"], ends[p])).alias(f"expired_{p}") for p in PERIODS]


def _is_ps(code: Column) -> Column:
    return F.coalesce(code.isin(*PS_CODES), F.lit(False))


def dated_credentials(credentials: DataFrame) -> DataFrame:
    """Credentials with both validity dates."""
    return credentials.select(
        "row_key",
        "info.locality_code",
        "info.valid_from",
        "info.valid_to",
        "info.status",
        "info.pricing_code",
        "info.source",
    ).filter(F.col("valid_from").isNotNull() & F.col("valid_to").isNotNull())


def valid_ps_keys(credentials: DataFrame, run: Run) -> DataFrame:
    """Keys of active personal credentials that are still valid."""
    return (
        dated_credentials(credentials)
        .filter((F.col("status") == ACTIVE) & F.col("pricing_code").isin(*PS_CODES))
        .filter(F.col("valid_to") > run.cumulative_bounds["end"])
        .select("row_key")
        .distinct()
    )


def issued_certs(certs: DataFrame) -> DataFrame:
    """Issued certificate requests, new or extending, that have a creation date."""
    return certs.select(
        "info.credential_id",
        "info.locality_code",
        "info.pricing_code",
        "info.created_date",
        "info.status",
        "info.request_type",
    ).filter(
        (F.col("status") == ISSUED)
        & F.col("request_type").isin(NEW, EXTENSION)
        & F.col("created_date").isNotNull()
    )


def _credential_combinations(credentials: DataFrame, run: Run) -> DataFrame:
    bounds = run.cumulative_bounds
    active = F.coalesce(F.col("status") == ACTIVE, F.lit(False))
    ps = _is_ps(F.col("pricing_code"))
    valid = F.col("valid_to") > bounds["end"]
    arm = (
        F.when(active & ~ps & valid, "pm_valid")
        .when(active & ~ps, "pm_expired")
        .when(active & ~valid, "ps_expired")
        .otherwise("none")
    )
    origin = (
        F.when(F.col("source") == SOURCE_EID, "vneid")
        .when(F.col("source") == SOURCE_AGENT, "agent")
        .otherwise("online")
    )
    rows = dated_credentials(credentials).select(
        "locality_code",
        arm.alias("arm"),
        origin.alias("origin"),
        *_created_flags(F.col("valid_from"), bounds),
        *_expired_flags(F.col("valid_to"), bounds),
    )
    return count_combinations(rows.filter(F.col("locality_code").isNotNull()), COMBINATION)


def _cert_combinations(certs: DataFrame, credentials: DataFrame, run: Run) -> DataFrame:
    """Only new personal certificates need the join, and they reach it already counted."""
    ps = _is_ps(F.col("pricing_code"))
    arm = (
        F.when(~ps, "pm_extend").when(F.col("request_type") == EXTENSION, "ps_extend").otherwise("ps_new")
    )
    rows = (
        issued_certs(certs)
        .filter(F.col("locality_code").isNotNull())
        .select(
            "locality_code",
            arm.alias("arm"),
            F.when(arm == "ps_new", F.col("credential_id")).alias("credential_id"),
            *_created_flags(F.col("created_date"), run.cumulative_bounds),
        )
    )
    counted = count_combinations(rows, ["credential_id", "locality_code", "arm", *CREATED])
    keys = valid_ps_keys(credentials, run).select(F.col("row_key").alias("credential_id"), F.lit(1).alias("held"))
    return counted.join(keys, "credential_id", "left").select(
        "locality_code",
        F.when((F.col("arm") == "ps_new") & F.col("held").isNull(), "none").otherwise(F.col("arm")).alias("arm"),
        F.lit("cert").alias("origin"),
        *CREATED,
        *[F.lit(0).alias(c) for c in EXPIRED],
        "n",
    )


def cumulative_report(credentials: DataFrame, certs: DataFrame, run: Run) -> DataFrame:
    """37 counters per locality; a locality with zeros only still appears."""
    combinations = _credential_combinations(credentials, run).unionByName(
        _cert_combinations(certs, credentials, run)
    )
    report = apply_rules(combinations, "locality_code", METRICS, _rules()).withColumn(
        "date_report", F.lit(run.time.date().isoformat()).cast("date")
    )
    return typed(report, CUMULATIVE_DDL)


# --- state of orders and registrations -------------------------------------------


def _blank_columns(given: dict[str, Column]) -> list[Column]:
    return [given.get(name, F.lit("")).alias(name) for name in ORDER_STATE_COLUMNS]


def orders_in_window(orders: DataFrame, run: Run) -> DataFrame:
    """Orders created or updated in the month."""
    start, end = run.monthly_window
    return orders.filter(
        half_open(F.col("info.created_date"), start, end) | half_open(F.col("info.updated_date"), start, end)
    )


def unmatched_registrations(users: DataFrame, window_orders: DataFrame, run: Run) -> DataFrame:
    """Registrations of users created in the month, or of no known date, without an order.

    A user without the creation cell passes the window; rows of the other
    source only, without a registration, are left out.
    """
    start, end = run.monthly_window
    ordered = window_orders.select(F.col("info.identity_id").alias("row_key")).distinct()
    return (
        users.filter(F.col("register").isNotNull())
        .filter(half_open(F.col("info.create_date"), start, end, null_passes=True))
        .select("row_key", "register")
        .join(ordered, "row_key", "left_anti")
    )


def order_state_report(
    orders: DataFrame, users: DataFrame, dictionary: DataFrame, localities: DataFrame, run: Run
) -> DataFrame:
    """Orders of the month and registrations without an order, as text."""
    extracted = F.lit(f"{run.closed_month_end:%d/%m/%Y}")
    chosen = orders_in_window(orders, run)

    def info(name: str) -> Column:
        return blank_if_absent(F.col(f"info.{name}"))

    failed = F.col("info.log_created_date").isNotNull()
    decoded_orders = decode_status(
        chosen.select("info"),
        status_entries(dictionary, "CertOrder"),
        F.col("info.status"),
        F.col("info.status_desc"),
        "reason",
    )
    order_rows = decoded_orders.select(
        _blank_columns(
            {
                "ngay_lay_dl": extracted,
                "ma_tinh": info("locality_code"),
                "sdt_lh": info("phone"),
                "ten_kh": info("full_name"),
                "so_gt": info("uid"),
                "ma_tb": info("ma_tb"),
                "ma_don_hang": info("ma_gd"),
                "dia_chi_ct": info("address"),
                "ngay_tao_don": F.coalesce(local_label(F.col("info.created_date")), F.lit("")),
                "ngay_thuc_hien": F.when(failed, local_label(F.col("info.log_created_date"))).otherwise(""),
                "kenh_ban": info("client_name"),
                "loai_yeu_cau": info("type_desc"),
                "ly_do_gd": F.col("reason"),
                "nguyen_nhan": F.when(failed, info("log_content")).otherwise(""),
                "toc_do_id": info("pricing_code"),
                "ten_goi_cuoc": info("pricing_name"),
                "gia_goi_cuoc": info("pricing_price"),
            }
        )
    )

    def register(name: str) -> Column:
        return blank_if_absent(F.col(f"register.{name}"))

    registrations = unmatched_registrations(users, chosen, run).select("register")
    placed = decode_province(registrations, localities, F.col("register.province_id"), "province")
    decoded = decode_status(
        placed,
        status_entries(dictionary, "Register"),
        F.col("register.status"),
        F.col("register.status_desc"),
        "reason",
    )
    created = F.coalesce(local_label(F.col("register.create_date")), F.lit(""))
    registration_rows = decoded.select(
        _blank_columns(
            {
                "ngay_lay_dl": extracted,
                "ma_tinh": F.col("province"),
                "sdt_lh": register("phone"),
                "ten_kh": register("full_name"),
                "so_gt": register("uid"),
                "dia_chi_ct": register("address"),
                "ngay_tao_don": created,
                "ngay_thuc_hien": F.coalesce(local_label(F.col("register.modified_date")), created),
                "ly_do_gd": F.col("reason"),
                "nguyen_nhan": F.col("reason"),
                "trang_thai_tk": F.col("reason"),
            }
        )
    )
    return typed(order_rows.unionByName(registration_rows), ORDER_STATE_DDL)


# --- display ---------------------------------------------------------------------


def cumulative_headers(run: Run, labels: Labels) -> dict[str, str]:
    """Header of each column of the cumulative report, by column name."""
    end = run.closed_day
    day, month, year = f"{end:%d/%m/%Y}", end.month, end.year
    s = labels.service
    # Presentation headers.
    return {
        "locality_code": f"TTKD {labels.operator} T/TP",
        "total": f"Tổng sản lượng CTS đang hoạt động dịch vụ {labels.operator} {s}",
        "total_pm": f"Tổng sản lượng CTS đang hoạt động gói thuê bao hết ngày {day}",
        "total_ps": f"Tổng sản lượng CTS đang hoạt động gói {s} PS hết ngày  {day}",
        "total_year": f"Sản lượng CTS PTM năm {year}",
        "total_pm_year": f"Sản lượng CTS gói thuê bao PTM năm {year}",
        "total_ps_year": f"Sản lượng CTS Gói {s} PS PTM năm {year}",
        "total_month": f"Sản lượng CTS PTM tháng {month}",
        "total_pm_month": f"Sản lượng CTS gói thuê bao PTM tháng {month}",
        "total_ps_month": f"Sản lượng CTS Gói {s} PS PTM tháng {month}",
        "total_date": f"Sản lượng CTS PTM trong ngày {day}",
        "total_pm_date": f"Sản lượng CTS gói thuê bao PTM trong ngày {day}",
        "total_ps_date": f"Sản lượng CTS gói {s} PS PTM trong ngày {day}",
        "total_extend": f"Tổng sản lượng CTS gia hạn dịch vụ {labels.operator} {s}",
        "total_pm_extend": f"Tổng sản lượng CTS gia hạn gói thuê bao hết ngày {day}",
        "total_ps_extend": f"Tổng sản lượng CTS gia hạn gói {s} PS hết ngày {day}",
        "total_year_extend": f"Sản lượng CTS GH năm {year}",
        "total_pm_year_extend": f"Sản lượng CTS gói thuê bao GH năm {year}",
        "total_ps_year_extend": f"Sản lượng CTS Gói {s} PS GH năm {year}",
        "total_month_extend": f"Sản lượng CTS GH tháng {month}",
        "total_pm_month_extend": f"Sản lượng CTS gói thuê bao GH tháng {month}",
        "total_ps_month_extend": f"Sản lượng CTS Gói {s} PS GH tháng {month}",
        "total_date_extend": f"Sản lượng CTS GH trong ngày {day}",
        "total_pm_date_extend": f"Sản lượng CTS gói thuê bao GH trong ngày {day}",
        "total_ps_date_extend": f"Sản lượng CTS gói {s} PS GH trong ngày {day}",
        "total_year_expired": f"Sản lượng CTS hết hạn trong năm {year}",
        "total_pm_year_expired": f"Sản lượng CTS gói thuê bao hết hạn trong năm {year}",
        "total_ps_year_expired": f"Sản lượng CTS Gói {s} PS hết hạn trong năm {year}",
        "total_month_expired": f"Sản lượng CTS hết hạn trong tháng {month}",
        "total_pm_month_expired": f"Sản lượng CTS gói thuê bao hết hạn trong tháng {month}",
        "total_ps_month_expired": f"Sản lượng CTS Gói {s} PS hết hạn trong tháng {month}",
        "total_date_expired": f"Sản lượng CTS hết hạn trong ngày {day}",
        "total_pm_date_expired": f"Sản lượng CTS gói thuê bao hết hạn trong ngày {day}",
        "total_ps_date_expired": f"Sản lượng CTS Gói {s} PS hết hạn trong ngày {day}",
        "total_vneid": "Sản lượng CTS được đăng ký và khởi tạo từ nguồn VneId",
        "total_vneid_date": f"Sản lượng CTS được đăng ký và khởi tạo từ nguồn VneId trong ngày {day}",
        "total_online": "Sản lượng CTS được đăng ký và khởi tạo online toàn trình",
        "total_online_date": f"Sản lượng CTS được đăng ký và khởi tạo online toàn trình trong ngày {day}",
    }


# Presentation headers, in column order.
ORDER_STATE_HEADERS = (
    "Ngày lấy dữ liệu",
    "Mã tỉnh",
    "Số điện thoại",
    "Họ và tên",
    "Số giấy tờ",
    "Mã thuê bao",
    "Mã đơn hàng",
    "Địa chỉ chi tiết",
    "Ngày tạo đơn",
    "Ngày thực hiện",
    "Kênh bán",
    "Loại yêu cầu",
    "Lý do giao dịch",
    "Nguyên nhân",
    "Tốc độ ID",
    "Tên gói cước",
    "Giá gói cước",
    "Trạng thái tài khoản",
)


def display_signing(report: DataFrame) -> DataFrame:
    """The report in client and month order, its stamp last."""
    return report.orderBy("client_id", "month").select(
        "client_id", "month", "client_name", "success", "un_success", "data_report"
    )


def display_cumulative(report: DataFrame, run: Run, labels: Labels) -> DataFrame:
    """The report without its date, under presentation headers, in locality order."""
    headers = cumulative_headers(run, labels)
    return report.drop("date_report").orderBy("locality_code").toDF(*headers.values())


def display_order_state(report: DataFrame) -> DataFrame:
    return report.toDF(*ORDER_STATE_HEADERS)
