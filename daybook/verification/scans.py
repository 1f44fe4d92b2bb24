"""Window scans, filters and exclusions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.records import is_failed_status
from daybook.functions.text import mentions, mentions_test, subject_mentions_test
from daybook.functions.times import instant, to_epoch_ms
from daybook.operators.windows import half_open, touched_in
from daybook.session import work_folder
from daybook.sources.archives import scan_with_archives
from daybook.sources.parquet import read_where
from daybook.verification.registry import query
from daybook.verification.tables import table

START, END = "1998-06-30 17:00:00", "1998-12-30 17:00:00"


def dated_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with their last ship date; an order without lineitems has none."""
    shipped = (
        table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"))
    )
    return table(spark, folder, "orders").join(shipped, F.col("l_orderkey") == F.col("o_orderkey"), "left").drop("l_orderkey")


DATED_ORDERS = """
dated as (
  select o.*, s.last_ship from orders o
  left join (select l_orderkey, max(l_shipdate) as last_ship from lineitem group by l_orderkey) s
    on s.l_orderkey = o.o_orderkey)
"""


def _dates(rows: DataFrame) -> DataFrame:
    return rows.select(
        "o_orderkey",
        to_epoch_ms(F.col("o_orderdate")).alias("created_ms"),
        to_epoch_ms(F.col("last_ship")).alias("updated_ms"),
    )


@query(f"""
with {DATED_ORDERS}
select o_orderkey, epoch_ms(o_orderdate) as created_ms, epoch_ms(last_ship) as updated_ms from dated
where (o_orderdate >= timestamp '{START}' or last_ship >= timestamp '{START}')
  and o_orderdate < timestamp '{END}'
""", text="updated_ms")
def incremental_window_scan(spark: SparkSession, folder: str) -> DataFrame:
    window = touched_in(F.col("o_orderdate"), F.col("last_ship"), instant(START), instant(END))
    return _dates(dated_orders(spark, folder).filter(window))


@query(f"""
select l_orderkey, l_partkey, l_suppkey, l_linenumber, epoch_ms(l_shipdate) as created_ms from lineitem
where l_shipdate >= timestamp '{START}' and l_shipdate < timestamp '{END}'
""")
def created_window_scan(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").filter(half_open(F.col("l_shipdate"), instant(START), instant(END)))
    return rows.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", to_epoch_ms(F.col("l_shipdate")).alias("created_ms")
    )


@query(f"""
with {DATED_ORDERS}
select o_orderkey, epoch_ms(o_orderdate) as created_ms, epoch_ms(last_ship) as updated_ms from dated
where last_ship is null or (last_ship >= timestamp '{START}' and last_ship < timestamp '{END}')
""", text="updated_ms")
def null_passing_filter(spark: SparkSession, folder: str) -> DataFrame:
    window = half_open(F.col("last_ship"), instant(START), instant(END), null_passes=True)
    return _dates(dated_orders(spark, folder).filter(window))


@query(f"""
with {DATED_ORDERS}
select o_orderkey, epoch_ms(o_orderdate) as created_ms, epoch_ms(last_ship) as updated_ms from dated
where (o_orderdate >= timestamp '{START}' and o_orderdate < timestamp '{END}')
   or (last_ship >= timestamp '{START}' and last_ship < timestamp '{END}')
""", text="updated_ms")
def two_range_scan(spark: SparkSession, folder: str) -> DataFrame:
    start, end = instant(START), instant(END)
    window = half_open(F.col("o_orderdate"), start, end) | half_open(F.col("last_ship"), start, end)
    return _dates(dated_orders(spark, folder).filter(window))


@query("""
select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag from lineitem
where l_linestatus = 'F' and (l_returnflag = 'N' or l_returnflag = 'R')
""")
def equality_scan(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").filter(
        (F.col("l_linestatus") == "F") & F.col("l_returnflag").isin("N", "R")
    )
    return rows.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")


# The SQL compares the epoch texts byte by byte, the query the instants.
@query("""
select event_id, user_id from events
where cast(epoch_us(ts) // 1000 as varchar) >= '1704646800000' and cast(epoch_us(ts) // 1000 as varchar) < '1705251600000'
""")
def epoch_text_window(spark: SparkSession, folder: str) -> DataFrame:
    window = half_open(F.col("ts"), instant("2024-01-07 17:00:00"), instant("2024-01-14 17:00:00"))
    return table(spark, folder, "events").filter(window).select("event_id", "user_id")


@query("select o_orderkey, o_custkey, o_orderstatus from orders where o_orderstatus = 'F'")
def parquet_equality_read(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_where(spark, f"{folder}/orders.parquet", "o_orderstatus", "F")
    return rows.select("o_orderkey", "o_custkey", "o_orderstatus")


@query("""
select p_partkey, p_name, p_type from part
where not (contains(p_name, 'red') or contains(p_name, 'Red') or contains(p_name, 'RED'))
""")
def test_row_exclusion(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "part").filter(~mentions(F.col("p_name"), "red|Red|RED"))
    return rows.select("p_partkey", "p_name", "p_type")


@query("""
select doc_id, source from documents
where not (contains(text, 'test') or contains(text, 'Test') or contains(text, 'TEST'))
""")
def test_text_exclusion(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").filter(~mentions_test(F.col("text"))).select("doc_id", "source")


@query("""
select doc_id, source from documents where not regexp_matches(text, '[A-Z][^,]+ the,')
""")
def regex_exclusion(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").filter(~mentions(F.col("text"), "[A-Z][^,]+ the,"))
    return rows.select("doc_id", "source")


# Part names become subjects; widgets are the test ones.
@query("""
select p_partkey, 'CN=' || p_brand || ' ' || replace(p_name, ' widget', ' Test') || ',O=' || p_type as subject
from part
where not regexp_matches('CN=' || p_brand || ' ' || replace(p_name, ' widget', ' Test') || ',O=' || p_type,
                         'CN=[^,]+ (Test|TEST|test),')
""")
def subject_exclusion(spark: SparkSession, folder: str) -> DataFrame:
    subject = F.concat(
        F.lit("CN="),
        "p_brand",
        F.lit(" "),
        F.replace("p_name", F.lit(" widget"), F.lit(" Test")),
        F.lit(",O="),
        "p_type",
    )
    rows = table(spark, folder, "part").select("p_partkey", subject.alias("subject"))
    return rows.filter(~subject_mentions_test(F.col("subject")))


@query("""
with s as (
  select event_id, case event_type when 'signup' then '' when 'view' then null
                   else json_extract_string(props, '$.k') end as status
  from events)
select event_id, status,
       cast(coalesce(try_cast(status as integer) >= 50 and try_cast(status as integer) < 99, false) as integer) as failed
from s
""")
def failed_status_range(spark: SparkSession, folder: str) -> DataFrame:
    status = (
        F.when(F.col("event_type") == "signup", F.lit(""))
        .when(F.col("event_type") == "view", F.lit(None).cast("string"))
        .otherwise(F.get_json_object("props", "$.k"))
    )
    rows = table(spark, folder, "events").select("event_id", status.alias("status"))
    return rows.withColumn("failed", is_failed_status(F.col("status")).cast("int"))


# The newest month is the live table, every earlier month an archive of its own.
@query("""
select o_orderkey, o_custkey, epoch_ms(o_orderdate) as created_ms from orders
where o_orderdate >= timestamp '1998-06-15 00:00:00' and o_orderdate < timestamp '1998-09-15 00:00:00'
""")
def archive_overlap_scan(spark: SparkSession, folder: str) -> DataFrame:
    root = work_folder(spark, "archives")
    orders = table(spark, folder, "orders").withColumn("month", F.date_format("o_orderdate", "yyyyMM"))
    # Rebalanced, not repartitioned: a month that outweighs the others is split.
    orders.hint("rebalance", "month").write.partitionBy("month").parquet(root)
    months = (
        orders.groupBy("month")
        .agg(F.min("o_orderdate").alias("fromTime"), F.max("o_orderdate").alias("toTime"))
    )
    newest = months.agg(F.max("month")).first()[0]
    catalogue = months.filter(F.col("month") != newest).select(
        F.lit("orders").alias("sourceCollection"),
        F.concat(F.lit("month="), "month").alias("collectionName"),
        "fromTime",
        "toTime",
    )
    schema = orders.drop("month").schema

    def open_months(names: list[str]) -> DataFrame:
        return spark.read.schema(schema).parquet(*[f"{root}/{name}" for name in names])

    start, end = instant("1998-06-15 00:00:00"), instant("1998-09-15 00:00:00")
    rows = scan_with_archives(open_months([f"month={newest}"]), catalogue, "orders", start, end, open_months)
    return rows.filter(half_open(F.col("o_orderdate"), start, end)).select(
        "o_orderkey", "o_custkey", to_epoch_ms(F.col("o_orderdate")).alias("created_ms")
    )
