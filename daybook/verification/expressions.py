"""Column functions over the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions import times
from daybook.functions.cells import cell
from daybook.functions.records import (
    EXPIRED_DESC,
    EXPIRED_STATUS,
    default_pricing,
    expire,
    failure_log,
    last_item,
)
from daybook.functions.text import blank_if_absent, is_space, joined_names, locality_from_username
from daybook.functions.times import instant, to_epoch_ms
from daybook.verification.registry import query
from daybook.verification.scans import DATED_ORDERS, dated_orders
from daybook.verification.tables import table


def lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


# The lines of a document are its log entries, those with the word "the" its errors.
@query("""
with l as (
  select doc_id, n_chars, unnest(string_split(text, chr(10))) as line,
         generate_subscripts(string_split(text, chr(10)), 1) as pos
  from documents),
last_error as (
  select doc_id, arg_max(line, pos) as content, max(pos) as pos from l
  where contains(line, ' the ') and n_chars % 100 >= 50 and n_chars % 100 < 99
  group by doc_id)
select d.doc_id, e.content,
       epoch_ms(timestamp '2024-01-01 00:00:00') + 60000 * e.pos as at_ms
from documents d left join last_error e on e.doc_id = d.doc_id
""", text="at_ms")
def last_error_log(spark: SparkSession, folder: str) -> DataFrame:
    logs = F.transform(
        lines(F.col("text")),
        lambda line, i: F.struct(
            F.when(line.contains(" the "), F.lit("true")).otherwise("0").alias("IsError"),
            line.alias("Content"),
            F.timestamp_millis(F.lit(1704067200000) + F.lit(60000) * (i + 1)).alias("CreatedDate"),
        ),
    )
    status = (F.col("n_chars") % 100).cast("int")
    rows = table(spark, folder, "documents").withColumn("log", failure_log(status, instant("2024-01-01 00:00:00"), logs))
    return rows.select(
        "doc_id", F.col("log.Content").alias("content"), to_epoch_ms(F.col("log.CreatedDate")).alias("at_ms")
    )


# Links of a page; pages of one site have none, an empty array. A field the last link lacks is
# blank, as without any link.
@query("""
with p as (
  select page_id, case when contains(url, 'spam-farm') then []
                       else regexp_extract_all(html, '<a href="([^"]*)">', 1) end as links
  from pages)
select page_id, coalesce(links[-1], '') as last_link,
       coalesce(case when length(links[-1]) > 4 then links[-1] end, '') as long_link
from p
""")
def last_element_fields(spark: SparkSession, folder: str) -> DataFrame:
    links = F.when(F.col("url").contains("spam-farm"), F.array().cast("array<string>")).otherwise(
        F.regexp_extract_all("html", F.lit('<a href="([^"]*)">'), F.lit(1))
    )
    pricings = F.transform(
        links,
        lambda link: F.struct(
            link.alias("Name"), F.when(F.length(link) > 4, link).alias("Code")
        ),
    )
    rows = table(spark, folder, "pages").select("page_id", last_item(pricings).alias("last"))
    return rows.select(
        "page_id",
        F.expr(cell("last.Name", "blank")).alias("last_link"),
        F.expr(cell("last.Code", "blank")).alias("long_link"),
    )


# Line starts of a document as names; an empty line is an entry without a name,
# a line that starts in lower case no entry at all.
@query("""
with l as (
  select doc_id, unnest(string_split(text, chr(10))) as line,
         generate_subscripts(string_split(text, chr(10)), 1) as pos
  from documents),
n as (
  select doc_id, pos, case when line = '' then '' else split_part(line, ' ', 1) end as name
  from l where line = '' or not regexp_matches(line, '^[a-z]'))
select d.doc_id, coalesce(j.names, '') as names
from documents d
left join (select doc_id, string_agg(name, ', ' order by pos) as names from n group by doc_id) j
  on j.doc_id = d.doc_id
""")
def joined_line_starts(spark: SparkSession, folder: str) -> DataFrame:
    roles = F.transform(
        lines(F.col("text")),
        lambda line: F.when(
            ~line.rlike("^[a-z]"),
            F.struct(F.when(line != "", F.split_part(line, F.lit(" "), F.lit(1))).alias("name")),
        ),
    )
    return table(spark, folder, "documents").select("doc_id", joined_names(roles).alias("names"))


# Sign-ups carry the year-1 date, which means no date.
@query("""
select event_id,
       case when event_type <> 'signup' then epoch_us(ts) // 1000 end as at_ms,
       case when event_type <> 'signup' then strftime(date_trunc('millisecond', ts), '%Y-%m-%d %H:%M:%S.%f') end as at_text
from events
""", text="at_ms")
def epoch_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    stored = F.when(F.col("event_type") == "signup", instant(times.NO_DATE)).otherwise(F.col("ts"))
    text = to_epoch_ms(times.real_instant(stored)).cast("string")
    back = times.from_epoch_ms(text)
    return table(spark, folder, "events").select(
        "event_id", to_epoch_ms(back).alias("at_ms"), times.micro_label(back).alias("at_text")
    )


@query("""
select event_id,
       strftime(ts, '%Y-%m') as month,
       strftime(ts + interval 7 hour, '%Y/%m/%d %H:%M:%S') as local_time,
       strftime(ts + interval 7 hour, '%d/%m/%Y') as local_day,
       strftime(ts, '%Y%m%d%H%M%S') as compact,
       strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as micros,
       strftime(ts + interval 7 hour, '%Y%m%d%H%M%S') as zone_time
from events
""")
def business_time_labels(spark: SparkSession, folder: str) -> DataFrame:
    ts = F.col("ts")
    return table(spark, folder, "events").select(
        "event_id",
        times.month_label(ts).alias("month"),
        times.local_label(ts).alias("local_time"),
        times.day_label(ts + F.expr(times.BUSINESS_SHIFT)).alias("local_day"),
        times.compact_label(ts).alias("compact"),
        times.micro_label(ts).alias("micros"),
        times.compact_label(times.business_time(ts)).alias("zone_time"),
    )


@query("""
with d as (select distinct cast(o_orderdate as date) as run_date from orders),
b as (
  select run_date,
         run_date + interval 17 hour - interval 1 day as "end",
         date_trunc('month', run_date) + interval 17 hour - interval 1 day as start_month,
         date_trunc('year', run_date) + interval 17 hour - interval 1 day as start_year
  from d)
select strftime(run_date, '%Y-%m-%d') as run_date,
       epoch_ms("end") as "end",
       epoch_ms("end" - interval 1 day) as start_date,
       epoch_ms(start_month) as start_month,
       epoch_ms(start_month + interval 1 month) as end_month,
       epoch_ms(start_year) as start_year,
       epoch_ms(start_year + interval 1 year) as end_year,
       epoch_ms("end" - interval 365 day) as ingest_start,
       epoch_ms(start_month - interval 1 month) as month_from,
       epoch_ms(start_month) as month_to,
       epoch_ms(date_trunc('month', run_date - interval 1 month) + interval 17 hour - interval 1 day) as calendar_from
from b
""")
def report_bounds(spark: SparkSession, folder: str) -> DataFrame:
    days = table(spark, folder, "orders").select(F.col("o_orderdate").cast("date").alias("run_date")).distinct()
    day = F.col("run_date")
    bounds = times.cumulative_bounds(day)
    bounds["ingest_start"] = times.ingest_window(day)[0]
    bounds["month_from"], bounds["month_to"] = times.monthly_window(day)
    bounds["calendar_from"] = times.monthly_window(day, calendar_month=True)[0]
    return days.select(
        F.date_format(day, "yyyy-MM-dd").alias("run_date"),
        *[to_epoch_ms(bound).alias(name) for name, bound in bounds.items()],
    )


@query(f"""
with {DATED_ORDERS}
select o_orderkey,
       case when last_ship < timestamp '1998-06-14 17:00:00' then '4' else o_orderstatus end as cert_status,
       case when last_ship < timestamp '1998-06-14 17:00:00' then 'EXPIRED' else o_orderpriority end as cert_status_desc
from dated
""")
def expiry_override(spark: SparkSession, folder: str) -> DataFrame:
    valid_to, cut = F.col("last_ship"), instant("1998-06-14 17:00:00")
    return dated_orders(spark, folder).select(
        "o_orderkey",
        expire(valid_to, cut, F.col("o_orderstatus"), EXPIRED_STATUS).alias("cert_status"),
        expire(valid_to, cut, F.col("o_orderpriority"), EXPIRED_DESC).alias("cert_status_desc"),
    )


# Codes: white space for medium parts, empty for small ones, else the type.
@query("""
with p as (
  select *, case p_type when 'MEDIUM' then '  ' when 'SMALL' then '' else p_type end as code from part)
select p_partkey, case when code = '  ' and p_name in ('red plate', 'small widget', 'hot ring') then '17187' else code end as code,
       cast(code = '  ' as integer) as space_only
from p
""")
def default_pricing_code(spark: SparkSession, folder: str) -> DataFrame:
    code = F.when(F.col("p_type") == "MEDIUM", "  ").when(F.col("p_type") == "SMALL", "").otherwise(F.col("p_type"))
    rows = table(spark, folder, "part").withColumn("code", code)
    names = ("red plate", "small widget", "hot ring")
    return rows.select(
        "p_partkey",
        default_pricing(F.col("code"), F.col("p_name"), names).alias("code"),
        is_space(F.col("code")).cast("int").alias("space_only"),
    )


# User names with the marker at the start, later, too late, or not at all.
@query("""
with u as (
  select c_custkey, case c_mktsegment when 'BUILDING' then 'OPER' || c_name
                                      when 'MACHINERY' then 'xOPER' || c_name
                                      when 'HOUSEHOLD' then c_name || 'OPER'
                                      when 'FURNITURE' then 'éOPER'
                                      else c_name end as username
  from customer)
select c_custkey, username,
       case when instr(username, 'OPER') > 0
            then substr(username, instr(username, 'OPER'), greatest(3 - (instr(username, 'OPER') - 1), 0))
            else '' end as locality
from u
""")
def locality_slice(spark: SparkSession, folder: str) -> DataFrame:
    segment, name = F.col("c_mktsegment"), F.col("c_name")
    username = (
        F.when(segment == "BUILDING", F.concat(F.lit("OPER"), name))
        .when(segment == "MACHINERY", F.concat(F.lit("xOPER"), name))
        .when(segment == "HOUSEHOLD", F.concat(name, F.lit("OPER")))
        .when(segment == "FURNITURE", F.lit("éOPER"))
        .otherwise(name)
    )
    rows = table(spark, folder, "customer").select("c_custkey", username.alias("username"))
    return rows.withColumn("locality", locality_from_username(F.col("username")))


@query("""
with t as (
  select event_id, case event_type when 'signup' then null when 'view' then 'None' when 'error' then '' else props end as cell
  from events)
select event_id, case when cell is null or cell = 'None' then '' else cell end as cell from t
""")
def blank_normalisation(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    cell = (
        F.when(kind == "signup", F.lit(None).cast("string"))
        .when(kind == "view", "None")
        .when(kind == "error", "")
        .otherwise(F.col("props"))
    )
    return table(spark, folder, "events").select("event_id", blank_if_absent(cell).alias("cell"))
