"""Locality snapshot, archives and their manifest."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.times import instant, to_epoch_ms
from daybook.operators.merge import KEY
from daybook.plans.archiving import ARCHIVED, archive_transactions, manifest_rows, span
from daybook.plans.flows import SIGNATURE_TRANSACTION
from daybook.plans.locality import publish_localities, read_localities
from daybook.plans.run import Run
from daybook.plans.tables import ingest_into, table_schema
from daybook.session import work_folder
from daybook.sources.archives import latest_entry, overlapping, read_manifest
from daybook.sources.keyed import current
from daybook.verification.flows import LABELS, TRANSACTION_TAGS, flat, tag_sql, transaction_documents
from daybook.verification.lookups import areas, fold_sql
from daybook.verification.registry import query
from daybook.verification.tables import table


def ward_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as wards of the province their nation stands for."""
    return table(spark, folder, "supplier").select(
        (F.col("s_nationkey") + 100).alias("ProvinceId"),
        F.concat(F.lit("province "), F.col("s_nationkey").cast("string")).alias("ProvinceName"),
        F.col("s_nationkey").cast("string").alias("ProvinceCode"),
        F.col("s_nationkey").alias("DistrictId"),
        F.when(F.col("s_acctbal") > 0, F.col("s_name")).alias("DistrictName"),
        (F.col("s_nationkey") + 1).alias("DistrictIdMyOperator"),
        F.col("s_suppkey").cast("int").alias("WardId"),
        F.col("s_name").alias("WardName"),
        (F.col("s_suppkey") + 7).cast("int").alias("WardIdMyOperator"),
        F.when(F.col("s_acctbal") > 0, F.col("s_acctbal") > 5000).alias("CoTuyenThu"),
    )


# Region 0 is left out; the others are folded in the order of region and nation.
@query(f"""
with recursive ranked as (
  select *, cast(row_number() over (order by n_regionkey, n_nationkey) - 1 as integer) as rank
  from nation where n_regionkey <> 0),
{fold_sql("ranked", "rank")},
area as (
  select r.n_nationkey as code, o.n_nationkey as other, r.n_regionkey, r_name
  from folded join ranked r on r.rank = k left join ranked o on o.rank = last_taken
  join region on r_regionkey = r.n_regionkey)
select lpad(cast(coalesce(d.n_regionkey, x.n_regionkey) as varchar), 2, '0') as area_local_code,
       coalesce(d.r_name, x.r_name) as area_local_name, s_nationkey + 100 as province_id,
       'province ' || s_nationkey as province_name, cast(coalesce(d.code, x.code) as varchar) as province_code,
       coalesce(cast(coalesce(d.other, x.other) as varchar), '') as province_other_code,
       s_nationkey as district_id, case when s_acctbal > 0 then s_name else '' end as district_name,
       s_nationkey + 1 as district_id_my_operator, cast(s_suppkey as integer) as ward_id, s_name as ward_name,
       cast(s_suppkey + 7 as integer) as ward_id_my_operator, s_acctbal > 5000 as co_tuyen_thu
from supplier left join area d on d.code = s_nationkey
left join area x on x.other = s_nationkey and d.code is null
where d.code is not null or x.code is not null
""")
def locality_snapshot_by_ward(spark: SparkSession, folder: str) -> DataFrame:
    """Two snapshots published; the newest one is read back through the manifest."""
    root = work_folder(spark, "localities")
    wards, area_documents = ward_documents(spark, folder), areas(spark, folder)
    older = wards.withColumn("WardId", F.col("WardId") + 1)
    publish_localities(spark, root, older, area_documents, Run.on("1998-06-14"), LABELS)
    publish_localities(spark, root, wards, area_documents, Run.on("1998-06-15"), LABELS)
    return read_localities(spark, root, LABELS)


# Months of orders as archives, against a closed window and both half-open ones.
@query("""
with c as (
  select strftime(o_orderdate, '%Y-%m') as month, min(o_orderdate) as f, max(o_orderdate) as t from orders group by 1)
select 'both' as bounds, month from c where t >= timestamp '1998-06-30 00:00:00' and f <= timestamp '1998-09-01 00:00:00'
union all
select 'from', month from c where t >= timestamp '1998-06-30 00:00:00'
union all
select 'to', month from c where f <= timestamp '1998-09-01 00:00:00'
union all
select 'none', month from c
""")
def archive_catalogue_overlap(spark: SparkSession, folder: str) -> DataFrame:
    catalogue = (
        table(spark, folder, "orders")
        .groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("collectionName"))
        .agg(F.min("o_orderdate").alias("fromTime"), F.max("o_orderdate").alias("toTime"))
        .withColumn("sourceCollection", F.lit("orders"))
    )
    start, end = instant("1998-06-30 00:00:00"), instant("1998-09-01 00:00:00")
    windows = {"both": (start, end), "from": (start, None), "to": (None, end), "none": (None, None)}
    found = [
        overlapping(catalogue, "orders", *window).select(F.lit(name).alias("bounds"), F.col("collectionName").alias("month"))
        for name, window in windows.items()
    ]
    return reduce(DataFrame.unionByName, found)


def _archived(spark: SparkSession, folder: str) -> str:
    """Transactions ingested, archived and emptied below a new root."""
    root, run = work_folder(spark, "archiving"), Run.on("2024-01-29")
    documents = transaction_documents(spark, folder, False)
    ingest_into(spark, root, SIGNATURE_TRANSACTION, documents, run, "20240129000000", LABELS, buckets=4)
    if not archive_transactions(spark, root, run):
        raise RuntimeError("there was nothing to archive")
    return root


MANIFEST = """
select '19980615000000' as date_report,
       strftime(arg_min(o_orderdate, o_orderkey), '%Y-%m-%d %H:%M:%S.%f') as start_time,
       strftime(arg_max(o_orderdate, o_orderkey), '%Y-%m-%d %H:%M:%S.%f') as end_time,
       'orders ' || strftime(o_orderdate, '%Y-%m') as table_name,
       'orders/orders_' || strftime(arg_min(o_orderdate, o_orderkey), '%Y%m%d%H%M%S') || '_'
         || strftime(arg_max(o_orderdate, o_orderkey), '%Y%m%d%H%M%S') || '.parquet' as file_name,
       'Cut off data by time' as description, count(*) as count
from orders group by strftime(o_orderdate, '%Y-%m')
"""


def monthly_manifest(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_orderdate", F.date_format("o_orderdate", "yyyy-MM").alias("month")
    )
    spans = span(orders, "o_orderkey", F.col("o_orderdate"), "month")
    rows = manifest_rows(spans, "19980615000000", "orders", "orders", "orders", "month")
    return rows.withColumn("table_name", F.concat_ws(" ", "table_name", "month")).drop("month")


@query(MANIFEST)
def archive_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return monthly_manifest(spark, folder)


# The snapshot of the latest stamp, which is not the one of the last file name.
@query(f"""
select cast(20200101 - cast(substr(end_time, 1, 4) as integer) * 12 - cast(substr(end_time, 6, 2) as integer) as varchar) as date_report,
       start_time, end_time, 'orders' as table_name, file_name, description, count
from ({MANIFEST}) order by 1 desc, file_name desc limit 1
""")
def latest_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    year, month = F.substring("end_time", 1, 4).cast("int"), F.substring("end_time", 6, 2).cast("int")
    manifest = monthly_manifest(spark, folder).withColumns(
        {"table_name": F.lit("orders"), "date_report": (F.lit(20200101) - year * 12 - month).cast("string")}
    )
    return latest_entry(manifest, "orders")


# All cells of an archive, read back by the path that the manifest names.
@query(f"""
with e as (select *, cast(event_id as varchar) as k, date_trunc('second', ts) as second from events)
select k as row_key, {tag_sql("info", TRANSACTION_TAGS)}, event_type as info_status, epoch_ms(second) as info_req_time,
       case when event_type <> 'view' then epoch_ms(second + interval 1 minute) end as info_expired_time,
       cast(null as bigint) as info_finish_date, cast(user_id as varchar) as info_app_id, event_type as info_app_name,
       epoch_ms(timestamp '2024-01-29 00:00:00') as date_report
from e where second < timestamp '2024-01-28 17:00:00'
""", text="info_expired_time info_finish_date")
def archive_contents(spark: SparkSession, folder: str) -> DataFrame:
    entry = latest_entry(read_manifest(spark, f"{_archived(spark, folder)}/manifest"), ARCHIVED).first()
    archive = spark.read.parquet(entry["file_name"])
    cells = F.struct(*[c for c in archive.columns if c not in ("_id", "date_report")]).alias("info")
    report = F.struct(F.col("date_report").alias("report")).alias("date")
    return flat(archive.select(F.col("_id").alias(KEY), cells, report))


# Stored table, archive, manifest and the emptied table, as one list of counts.
@query("""
with e as (
  select cast(event_id as varchar) as k, date_trunc('second', ts) as second from events
  where date_trunc('second', ts) < timestamp '2024-01-28 17:00:00')
select 'archive' as what, count(*) as n, epoch_ms(min(second)) as first_ms, epoch_ms(max(second)) as last_ms from e
union all
select 'manifest', count(*), epoch_ms(arg_min(second, k)), epoch_ms(arg_max(second, k)) from e
union all
select 'live', 0, null, null
""", text="first_ms last_ms")
def archive_and_empty(spark: SparkSession, folder: str) -> DataFrame:
    root = _archived(spark, folder)
    manifest = read_manifest(spark, f"{root}/manifest")
    entry = latest_entry(manifest, ARCHIVED).first()
    archive = spark.read.parquet(entry["file_name"])
    live = current(spark, root, ARCHIVED, table_schema(spark, ARCHIVED))

    def counted(rows: DataFrame, what: str) -> DataFrame:
        return rows.agg(
            F.lit(what).alias("what"),
            F.count("*").alias("n"),
            to_epoch_ms(F.min("req_time")).alias("first_ms"),
            to_epoch_ms(F.max("req_time")).alias("last_ms"),
        )

    recorded = manifest.select(
        F.lit("manifest").alias("what"),
        F.col("count").alias("n"),
        to_epoch_ms(F.col("start_time").cast("timestamp")).alias("first_ms"),
        to_epoch_ms(F.col("end_time").cast("timestamp")).alias("last_ms"),
    )
    return counted(archive, "archive").unionByName(counted(live.select("info.req_time"), "live")).unionByName(recorded)
