"""Keyed merges and status history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.times import business_day, instant, to_epoch_ms
from daybook.operators.merge import daily_status, insert_or_patch, latest_per_key, put_columns, replace_rows
from daybook.verification.registry import query
from daybook.verification.scans import DATED_ORDERS, dated_orders
from daybook.verification.tables import table


# Copies of a line are versions of one record; the latest shipped is kept.
@query("""
select cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as row_key,
       epoch_ms(l_shipdate) as updated_ms, l_partkey, l_suppkey
from lineitem
qualify row_number() over (partition by l_orderkey, l_linenumber
                           order by l_shipdate desc, l_partkey desc, l_suppkey desc) = 1
""")
def latest_version_per_key(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("row_key"),
        "l_shipdate",
        "l_partkey",
        "l_suppkey",
    )
    kept = latest_per_key(rows, ["l_shipdate"])
    return kept.select("row_key", to_epoch_ms(F.col("l_shipdate")).alias("updated_ms"), "l_partkey", "l_suppkey")


# Target: orders before 2000; batch: orders shipped since November 1999, with a
# lower-case status. Old statuses F are blank, P absent, O filled; the note is
# absent for O and a column that may be filled.
@query(f"""
with {DATED_ORDERS},
t as (
  select o_orderkey as k, case o_orderstatus when 'F' then '' when 'P' then null else o_orderstatus end as status,
         case o_orderstatus when 'F' then '' when 'O' then null else 'old' end as note,
         o_orderpriority as priority, o_orderdate as updated
  from dated where o_orderdate < timestamp '2000-01-01 00:00:00'),
b as (
  select o_orderkey as k, lower(o_orderstatus) as status, 'new' as note, 'batch' as priority, last_ship as updated
  from dated where last_ship >= timestamp '1999-11-01 00:00:00')
select cast(coalesce(t.k, b.k) as varchar) as row_key,
       case when t.k is null then b.status
            when b.k is not null and t.status <> '' and t.status <> b.status then b.status else t.status end as status,
       case when t.k is null then b.note
            when b.k is not null and (t.note is null or (t.note <> '' and t.note <> b.note)) then b.note
            else t.note end as note,
       case when t.k is null then b.priority else t.priority end as priority,
       epoch_ms(coalesce(b.updated, t.updated)) as updated_ms,
       cast(b.k is not null as integer) as in_batch, cast(t.k is not null as integer) as in_target
from t full outer join b on t.k = b.k
""")
def keyed_merge(spark: SparkSession, folder: str) -> DataFrame:
    dated = dated_orders(spark, folder)
    status, key = F.col("o_orderstatus"), F.col("o_orderkey").cast("string").alias("row_key")
    target = dated.filter(F.col("o_orderdate") < instant("2000-01-01 00:00:00")).select(
        key,
        F.struct(
            F.when(status == "F", "").when(status == "O", status).alias("status"),
            F.when(status == "F", "").when(status == "P", "old").alias("note"),
            F.col("o_orderpriority").alias("priority"),
            F.col("o_orderdate").alias("updated"),
        ).alias("info"),
        F.struct(F.lit(None).cast("int").alias("in_batch"), F.lit(1).alias("in_target")).alias("seen"),
    )
    batch = dated.filter(F.col("last_ship") >= instant("1999-11-01 00:00:00")).select(
        key,
        F.struct(
            F.lower(status).alias("status"),
            F.lit("new").alias("note"),
            F.lit("batch").alias("priority"),
            F.col("last_ship").alias("updated"),
        ).alias("info"),
    )
    merged = insert_or_patch(target, batch, "info", ["status", "note", "updated"], fill=["note"])
    marked = merged.join(batch.select("row_key", F.lit(1).alias("in_batch")), "row_key", "left")
    return marked.select(
        "row_key",
        "info.status",
        "info.note",
        "info.priority",
        to_epoch_ms(F.col("info.updated")).alias("updated_ms"),
        F.coalesce("in_batch", F.lit(0)).alias("in_batch"),
        F.coalesce("seen.in_target", F.lit(0)).alias("in_target"),
    )


# Customers take the totals of their orders of June 1998 as a second family.
@query("""
with b as (
  select o_custkey as k, count(*) as n, max(o_orderkey) as last_order from orders
  where o_orderdate >= timestamp '1998-05-31 17:00:00' and o_orderdate < timestamp '1998-06-30 17:00:00'
  group by 1)
select cast(c_custkey as varchar) as row_key, c_name as name, case when b.k is not null then b.n
       when c_nationkey = 0 then -1 end as n, b.last_order
from customer left join b on b.k = c_custkey
""", text="n last_order")
def family_merge(spark: SparkSession, folder: str) -> DataFrame:
    window = (F.col("o_orderdate") >= instant("1998-05-31 17:00:00")) & (
        F.col("o_orderdate") < instant("1998-06-30 17:00:00")
    )
    batch = (
        table(spark, folder, "orders")
        .filter(window)
        .groupBy(F.col("o_custkey").cast("string").alias("row_key"))
        .agg(F.struct(F.count("*").alias("n"), F.max("o_orderkey").alias("last_order")).alias("orders"))
    )
    # Customers of nation 0 already have the family, from an earlier run.
    earlier = F.struct(F.lit(-1).cast("bigint").alias("n"), F.lit(None).cast("bigint").alias("last_order"))
    target = table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("row_key"),
        F.struct(F.col("c_name").alias("name")).alias("info"),
        F.when(F.col("c_nationkey") == 0, earlier).alias("orders"),
    )
    return put_columns(target, batch, "orders").select("row_key", "info.name", "orders.n", "orders.last_order")


@query("""
select cast(event_id as varchar) as row_key,
       case when ts >= timestamp '2024-01-20 00:00:00' then 'put ' || event_type else event_type end as kind
from events
""")
def replace_by_key(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    key = F.col("event_id").cast("string").alias("row_key")
    target = events.filter(F.col("ts") < instant("2024-01-25 00:00:00")).select(key, F.col("event_type").alias("kind"))
    batch = events.filter(F.col("ts") >= instant("2024-01-20 00:00:00")).select(
        key, F.concat(F.lit("put "), "event_type").alias("kind")
    )
    return replace_rows(target, batch)


@query("""
select user_id, strftime(ts + interval 7 hour, '%Y-%m-%d') as log_date, arg_max(event_type, ts) as status
from events group by 1, 2
""")
def status_history(spark: SparkSession, folder: str) -> DataFrame:
    history = daily_status(
        table(spark, folder, "events"), "user_id", business_day(F.col("ts")), "event_type", ["ts", "event_id"]
    )
    return history.withColumn("log_date", F.date_format("log_date", "yyyy-MM-dd"))


# Two runs log into a date map: the first inserts every order, the second changes
# the status of the orders shipped since November 1999.
@query(f"""
with {DATED_ORDERS},
s as (
  select o_orderkey, o_orderstatus as before,
         case when last_ship >= timestamp '1999-11-01 00:00:00' and o_orderstatus <> 'O' then 'O' end as after
  from dated)
select cast(o_orderkey as varchar) as row_key, '1999-10-31' as log_date, before as status from s
union all
select cast(o_orderkey as varchar), '1999-11-30', after from s where after is not null
""")
def status_map_history(spark: SparkSession, folder: str) -> DataFrame:
    dated = dated_orders(spark, folder).select(F.col("o_orderkey").cast("string").alias("row_key"), "o_orderstatus", "last_ship")
    first = dated.select("row_key", F.struct(F.col("o_orderstatus").alias("status")).alias("info"))
    second = dated.filter(F.col("last_ship") >= instant("1999-11-01 00:00:00")).select(
        "row_key", F.struct(F.lit("O").alias("status")).alias("info")
    )
    rows = spark.createDataFrame([], "row_key string, info struct<status:string>, status_log map<date,string>")
    for batch, day in ((first, "1999-10-31"), (second, "1999-11-30")):
        log = ("status_log", "status", day)
        rows = insert_or_patch(rows, batch, "info", ["status"], history=log)
    return rows.select("row_key", F.explode("status_log").alias("log_date", "status")).withColumn(
        "log_date", F.date_format("log_date", "yyyy-MM-dd")
    )
