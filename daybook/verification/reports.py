"""The reports over the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.times import instant
from daybook.plans.reports import (
    METRICS,
    ORDER_STATE_COLUMNS,
    ORDER_STATE_HEADERS,
    PERIODS,
    cumulative_headers,
    cumulative_report,
    display_cumulative,
    display_order_state,
    display_signing,
    issued_certs,
    order_state_report,
    orders_in_window,
    signing_report,
    unmatched_registrations,
    valid_ps_keys,
)
from daybook.plans.labels import Labels
from daybook.plans.run import Run
from daybook.session import work_folder
from daybook.sources.parquet import read_where, write_report
from daybook.verification.lookups import dictionary, wards
from daybook.verification.registry import query
from daybook.verification.scans import dated_orders
from daybook.verification.tables import table

SIGNING_RUN = Run.on("2024-02-15")
CUMULATIVE_RUN = Run.on("1998-06-15")
STATE_RUN = Run.on("1998-07-15")


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Events as signing transactions; purchases are the successful ones."""
    return table(spark, folder, "events").select(
        F.col("event_id").alias("row_key"),
        F.struct(
            F.col("user_id").cast("string").alias("app_id"),
            F.when(F.col("event_type") != "error", F.col("event_type")).alias("app_name"),
            F.col("ts").alias("req_time"),
            F.when(F.col("event_type") == "purchase", "1").otherwise("0").alias("status"),
        ).alias("info"),
    )


SIGNING_SQL = """
select '2024/02/15 00:00:00' as data_report, cast(user_id as varchar) as client_id,
       arg_min(event_type, event_id) filter (where event_type <> 'error') as client_name,
       strftime(ts, '%Y-%m') as month,
       cast(count(*) filter (where event_type = 'purchase') as integer) as success,
       cast(count(*) filter (where event_type <> 'purchase') as integer) as un_success
from events
where ts >= timestamp '2023-12-31 17:00:00' and ts < timestamp '2024-01-31 17:00:00'
group by user_id, strftime(ts, '%Y-%m')
"""


@query(SIGNING_SQL)
def signing_by_client_month(spark: SparkSession, folder: str) -> DataFrame:
    return signing_report(transactions(spark, folder), SIGNING_RUN)


@query(SIGNING_SQL)
def signing_display(spark: SparkSession, folder: str) -> DataFrame:
    return display_signing(signing_by_client_month(spark, folder))


# --- cumulative report -----------------------------------------------------------

PRICING = (("4-NOT SPECIFIED", "17187"), ("5-LOW", "18046"))


def _pricing(priority: Column) -> Column:
    return F.when(priority == PRICING[0][0], PRICING[0][1]).when(priority == PRICING[1][0], PRICING[1][1]).otherwise("11111")


def located_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the nation of their customer."""
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    places = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    return table(spark, folder, "orders").join(places, F.col("o_custkey") == F.col("c_custkey"))


def credentials(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as credentials, localities are the nations of their customers."""
    shipped = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"))
    status = F.col("o_orderstatus")
    source = F.col("o_orderkey") % 5
    return (
        located_orders(spark, folder)
        .join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select(
            F.col("o_orderkey").cast("string").alias("row_key"),
            F.struct(
                F.col("n_name").alias("locality_code"),
                F.col("o_orderdate").alias("valid_from"),
                F.col("last_ship").alias("valid_to"),
                F.when(status == "F", "0").when(status == "O", "1").otherwise("").alias("status"),
                _pricing(F.col("o_orderpriority")).alias("pricing_code"),
                F.when(source > 0, source.cast("string")).alias("source"),
            ).alias("info"),
        )
    )


def certs(spark: SparkSession, folder: str) -> DataFrame:
    """Lineitems as certificate requests for the credential of their order."""
    flag = F.col("l_returnflag")
    return (
        table(spark, folder, "lineitem")
        .join(located_orders(spark, folder), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.struct(
                F.col("l_orderkey").cast("string").alias("credential_id"),
                F.col("n_name").alias("locality_code"),
                _pricing(F.col("o_orderpriority")).alias("pricing_code"),
                F.col("l_shipdate").alias("created_date"),
                F.when(F.col("l_linestatus") == "F", "5").otherwise("1").alias("status"),
                F.when(flag == "N", "0").when(flag == "R", "1").otherwise("2").alias("request_type"),
            ).alias("info")
        )
    )


CERTIFICATES = """
shipped as (select l_orderkey, max(l_shipdate) as valid_to from lineitem group by l_orderkey),
located as (
  select o.*, n_name as locality, o_orderpriority in ('4-NOT SPECIFIED', '5-LOW') as ps
  from orders o join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey),
cred as (
  select locality, o_orderkey as k, o_orderstatus = 'F' as active, ps, o_orderkey % 5 as source,
         o_orderdate as valid_from, valid_to, valid_to > timestamp '1998-06-14 17:00:00' as valid
  from located join shipped on l_orderkey = o_orderkey),
cert as (
  select locality, l_orderkey as k, ps, l_returnflag = 'R' as extends, l_shipdate as made,
         exists (select 1 from cred where cred.k = l_orderkey and active and cred.ps and valid) as held
  from lineitem join located on o_orderkey = l_orderkey
  where l_linestatus = 'F' and l_returnflag in ('N', 'R'))
"""


def _cumulative_sql() -> str:
    """One branch per rule: (source rows, condition, classes, suffix, date column, window ends)."""
    start = {"year": "1997-12-31 17:00:00", "month": "1998-05-31 17:00:00", "date": "1998-06-13 17:00:00"}
    now = dict.fromkeys(PERIODS, "1998-06-14 17:00:00")
    later = {"year": "1998-12-31 17:00:00", "month": "1998-06-30 17:00:00", "date": "1998-06-14 17:00:00"}
    branches = [
        ("cred", "active and not ps and valid", ("", "_pm"), "", "valid_from", now, True),
        ("cred", "active and not ps and not valid", ("", "_pm"), "_expired", "valid_to", later, False),
        ("cred", "active and ps and not valid", ("", "_ps"), "_expired", "valid_from", now, False),
        ("cert", "ps and not extends and held", ("", "_ps"), "", "made", now, True),
        ("cert", "ps and extends", ("", "_ps"), "_extend", "made", now, True),
        ("cert", "not ps", ("", "_pm"), "_extend", "made", now, True),
        ("cred", "source = 4", ("_vneid",), "", "valid_from", now, True),
        ("cred", "source <> 3 and source <> 4", ("_online",), "", "valid_from", now, True),
    ]
    parts = ["select locality, '' as metric, 0 as n from cred union all select locality, '', 0 from cert"]
    for rows, test, classes, suffix, at, ends, plain in branches:
        for c in classes:
            if plain:
                parts.append(f"select locality, 'total{c}{suffix}', 1 from {rows} where {test}")
            for p in ("date",) if c in ("_vneid", "_online") else PERIODS:
                parts.append(
                    f"select locality, 'total{c}_{p}{suffix}', 1 from {rows} where {test} "
                    f"and {at} >= timestamp '{start[p]}' and {at} < timestamp '{ends[p]}'"
                )
    sums = ", ".join(f"cast(sum(n) filter (where metric = '{m}') as integer) as {m}" for m in METRICS)
    zero = ", ".join(f"coalesce({m}, 0) as {m}" for m in METRICS)
    return (
        f"with {CERTIFICATES}, hits as ({' union all '.join(parts)}), "
        f"sums as (select locality as locality_code, {sums} from hits group by locality) "
        f"select '1998-06-15' as date_report, locality_code, {zero} from sums"
    )


CUMULATIVE_SQL = _cumulative_sql()


@query(CUMULATIVE_SQL)
def accumulated_by_locality(spark: SparkSession, folder: str) -> DataFrame:
    report = cumulative_report(credentials(spark, folder), certs(spark, folder), CUMULATIVE_RUN)
    return report.withColumn("date_report", F.date_format("date_report", "yyyy-MM-dd"))


def _display_sql() -> str:
    headers = cumulative_headers(CUMULATIVE_RUN, Labels("Operator", "Service"))
    named = ", ".join(f'{column} as "{header}"' for column, header in headers.items())
    return f"select {named} from ({CUMULATIVE_SQL})"


@query(_display_sql())
def accumulated_display(spark: SparkSession, folder: str) -> DataFrame:
    return display_cumulative(accumulated_by_locality(spark, folder), CUMULATIVE_RUN, Labels("Operator", "Service"))


@query(f"""
with {CERTIFICATES}
select cast(k as varchar) as credential_id, count(*) as n from cert
where ps and not extends and held group by k
""")
def valid_ps_semi_join(spark: SparkSession, folder: str) -> DataFrame:
    keys = valid_ps_keys(credentials(spark, folder), CUMULATIVE_RUN).withColumnRenamed("row_key", "credential_id")
    new_ps = issued_certs(certs(spark, folder)).filter(
        F.col("pricing_code").isin(*[code for _, code in PRICING]) & (F.col("request_type") == "0")
    )
    return new_ps.groupBy("credential_id").agg(F.count("*").alias("n")).join(keys, "credential_id", "left_semi")


# --- state of orders and registrations -------------------------------------------


def state_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with contact data of their customer; urgent ones failed when last shipped."""
    customer = table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    failed = F.col("o_orderpriority") == "1-URGENT"
    return (
        dated_orders(spark, folder)
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_orderkey").cast("string").alias("row_key"),
            F.struct(
                F.col("o_custkey").cast("string").alias("identity_id"),
                F.format_string("P%02d", "c_nationkey").alias("locality_code"),
                F.when(F.col("o_orderstatus") == "F", "None").otherwise(F.col("o_orderstatus")).alias("phone"),
                F.col("c_name").alias("full_name"),
                F.concat(F.lit("uid-"), F.col("o_custkey").cast("string")).alias("uid"),
                F.col("o_orderpriority").alias("ma_tb"),
                F.col("o_orderkey").cast("string").alias("ma_gd"),
                F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("address"),
                F.col("o_orderdate").alias("created_date"),
                F.col("last_ship").alias("updated_date"),
                F.when(failed, F.col("last_ship")).alias("log_created_date"),
                F.when(failed, F.concat(F.lit("failed "), "o_orderstatus")).alias("log_content"),
                F.col("c_mktsegment").alias("client_name"),
                F.lit("").alias("type_desc"),
                (F.col("o_custkey") % 30).cast("string").alias("status"),
                F.col("o_orderpriority").alias("status_desc"),
                _pricing(F.col("o_orderpriority")).alias("pricing_code"),
                F.col("o_orderstatus").alias("pricing_name"),
                F.col("o_totalprice").cast("decimal(15,2)").cast("string").alias("pricing_price"),
            ).alias("info"),
        )
    )


def state_users(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as users: machinery has no registration, furniture came in July, building has no date."""
    segment = F.col("c_mktsegment")
    created = F.when(segment == "FURNITURE", instant("1998-07-10 00:00:00")).when(
        segment != "BUILDING", instant("1998-06-30 16:59:59.999")
    )
    register = F.struct(
        F.when(segment == "HOUSEHOLD", "abc").otherwise((F.col("c_nationkey") + 5).cast("string")).alias("province_id"),
        F.lit("None").alias("phone"),
        F.col("c_name").alias("full_name"),
        F.col("c_custkey").cast("string").alias("uid"),
        segment.alias("address"),
        instant("1998-06-01 20:30:00").alias("create_date"),
        F.when(segment == "BUILDING", instant("1998-06-02 17:00:00")).alias("modified_date"),
        (F.col("c_nationkey") % 7).cast("string").alias("status"),
        F.concat(F.lit("own "), segment).alias("status_desc"),
    )
    return table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("row_key"),
        F.struct(created.alias("create_date")).alias("info"),
        F.when(segment != "MACHINERY", register).alias("register"),
    )


STATE = """
shipped as (select l_orderkey, max(l_shipdate) as last_ship from lineitem group by l_orderkey),
chosen as (
  select o.*, last_ship, c_name, c_mktsegment, c_nationkey
  from orders o join customer on c_custkey = o_custkey left join shipped on l_orderkey = o_orderkey
  where (o_orderdate >= timestamp '1998-05-30 17:00:00' and o_orderdate < timestamp '1998-06-30 17:00:00')
     or (last_ship >= timestamp '1998-05-30 17:00:00' and last_ship < timestamp '1998-06-30 17:00:00')),
unmatched as (
  select * from customer
  where c_mktsegment not in ('MACHINERY', 'FURNITURE')
    and not exists (select 1 from chosen where o_custkey = c_custkey)),
code as (select n_nationkey % 20 as code, arg_min(n_name, n_nationkey) as description from nation group by 1)
"""


STATE_SQL = f"""
with {STATE}
select '30/06/1998' as ngay_lay_dl, printf('P%02d', c_nationkey) as ma_tinh,
       case o_orderstatus when 'F' then '' else o_orderstatus end as sdt_lh, c_name as ten_kh,
       'uid-' || cast(o_custkey as varchar) as so_gt, o_orderpriority as ma_tb, cast(o_orderkey as varchar) as ma_don_hang,
       case c_mktsegment when 'BUILDING' then '' else c_mktsegment end as dia_chi_ct,
       strftime(o_orderdate + interval 7 hour, '%Y/%m/%d %H:%M:%S') as ngay_tao_don,
       case when o_orderpriority = '1-URGENT' and last_ship is not null
            then strftime(last_ship + interval 7 hour, '%Y/%m/%d %H:%M:%S') else '' end as ngay_thuc_hien,
       c_mktsegment as kenh_ban, '' as loai_yeu_cau, coalesce(description, o_orderpriority) as ly_do_gd,
       case when o_orderpriority = '1-URGENT' and last_ship is not null then 'failed ' || o_orderstatus else '' end as nguyen_nhan,
       case o_orderpriority when '4-NOT SPECIFIED' then '17187' when '5-LOW' then '18046' else '11111' end as toc_do_id,
       o_orderstatus as ten_goi_cuoc, cast(cast(o_totalprice as decimal(15, 2)) as varchar) as gia_goi_cuoc,
       '' as trang_thai_tk
from chosen left join code on code = o_custkey % 30
union all
select '30/06/1998', case when c_mktsegment = 'HOUSEHOLD' then 'abc'
                          when c_nationkey + 5 in (select s_nationkey from supplier) then printf('P%02d', c_nationkey + 5)
                          else '' end,
       '', c_name, cast(c_custkey as varchar), '', '', c_mktsegment, '1998/06/02 03:30:00',
       case c_mktsegment when 'BUILDING' then '1998/06/03 00:00:00' else '1998/06/02 03:30:00' end,
       '', '', coalesce(r_name, 'own ' || c_mktsegment), coalesce(r_name, 'own ' || c_mktsegment), '', '', '',
       coalesce(r_name, 'own ' || c_mktsegment)
from unmatched left join region on r_regionkey = c_nationkey % 7
"""


@query(STATE_SQL)
def order_registration_state(spark: SparkSession, folder: str) -> DataFrame:
    return order_state_report(
        state_orders(spark, folder),
        state_users(spark, folder),
        dictionary(spark, folder),
        wards(spark, folder),
        STATE_RUN,
    )


def _state_display_sql() -> str:
    named = ", ".join(f'{c} as "{h}"' for c, h in zip(ORDER_STATE_COLUMNS, ORDER_STATE_HEADERS))
    return f"select {named} from ({STATE_SQL})"


@query(_state_display_sql())
def order_registration_display(spark: SparkSession, folder: str) -> DataFrame:
    return display_order_state(order_registration_state(spark, folder))


@query(f"with {STATE} select cast(c_custkey as varchar) as row_key, c_name as full_name from unmatched")
def unmatched_registration_anti_join(spark: SparkSession, folder: str) -> DataFrame:
    chosen = orders_in_window(state_orders(spark, folder), STATE_RUN)
    rows = unmatched_registrations(state_users(spark, folder), chosen, STATE_RUN)
    return rows.select("row_key", "register.full_name")


# --- sink ------------------------------------------------------------------------


@query("""
with d as (select unnest([date '1998-06-15', date '1998-07-15', date '1999-01-15']) as run_date)
select strftime(run_date, '%Y/%m/%d') || ' 00:00:00' as data_report, 1998 as report_year, o_orderpriority as client_id,
       strftime(o_orderdate, '%Y-%m') as month,
       cast(count(*) filter (where o_orderstatus = 'F') as integer) as success,
       cast(count(*) filter (where o_orderstatus <> 'F') as integer) as un_success
from orders join d on o_orderdate < date_trunc('month', run_date) + interval 17 hour - interval 1 day
                  and o_orderdate >= date_trunc('month', run_date) + interval 17 hour - interval 1 day - interval 1 month
group by all
""")
def report_append(spark: SparkSession, folder: str) -> DataFrame:
    """Three runs appended, the first of them twice: each is kept once, that of January under the year it closes."""
    path = work_folder(spark, "signing")
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("row_key"),
        F.struct(
            F.col("o_orderpriority").alias("app_id"),
            F.col("o_orderpriority").alias("app_name"),
            F.col("o_orderdate").alias("req_time"),
            F.when(F.col("o_orderstatus") == "F", "1").otherwise("0").alias("status"),
        ).alias("info"),
    )
    for day in ("1998-06-15", "1998-07-15", "1998-06-15", "1999-01-15"):
        write_report(signing_report(orders, run := Run.on(day)), path, "data_report", run.closed_month_end.year)
    return read_where(spark, path).select("data_report", "report_year", "client_id", "month", "success", "un_success")
