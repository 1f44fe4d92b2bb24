"""Dictionary and geography lookups, semi and anti joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.aliases import fold_aliases
from daybook.operators.lookups import decode_province, decode_status, resolve_area, status_entries
from daybook.plans.locality import explode_areas
from daybook.verification.registry import query
from daybook.verification.tables import table


def dictionary(spark: SparkSession, folder: str) -> DataFrame:
    """Status dictionary: nations describe order codes (20 codes, the first five twice), regions register codes."""
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    orders = nation.select(
        F.lit("status").alias("type"),
        F.lit("CertOrder").alias("table"),
        (F.col("n_nationkey") % 20).alias("code"),
        F.col("n_name").alias("description_vi"),
        F.col("n_nationkey").alias("position"),
    )
    registers = region.select(
        F.lit("status").alias("type"),
        F.lit("Register").alias("table"),
        F.col("r_regionkey").alias("code"),
        F.col("r_name").alias("description_vi"),
        F.col("r_regionkey").alias("position"),
    )
    other = registers.withColumn("type", F.lit("label")).withColumn("table", F.lit("CertOrder"))
    return orders.unionByName(registers).unionByName(other)


@query("""
with d as (
  select n_nationkey % 20 as code, arg_min(n_name, n_nationkey) as description from nation group by 1)
select o_orderkey, coalesce(d.description, o_orderpriority) as reason
from orders left join d
  on d.code = case when o_orderstatus = 'P' then null else o_custkey % 30 end
""")
def status_decode(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    # Open orders have a blank code.
    status = F.when(F.col("o_orderstatus") == "P", "").otherwise((F.col("o_custkey") % 30).cast("string"))
    rows = orders.select("o_orderkey", "o_orderpriority", status.alias("status"))
    entries = status_entries(dictionary(spark, folder), "CertOrder")
    return decode_status(rows, entries, F.col("status"), F.col("o_orderpriority"), "reason").select(
        "o_orderkey", "reason"
    )


def wards(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as wards of their nation, the province."""
    return table(spark, folder, "supplier").select(
        F.col("s_nationkey").alias("province_id"),
        F.format_string("P%02d", "s_nationkey").alias("province_code"),
        F.col("s_suppkey").cast("int").alias("ward_id"),
    )


@query("""
with known as (select distinct s_nationkey from supplier),
c as (
  select c_custkey, case c_mktsegment when 'BUILDING' then null when 'MACHINERY' then 'abc' when 'HOUSEHOLD' then 'None'
                                      when 'FURNITURE' then cast(c_nationkey + 10 as varchar)
                                      else cast(c_nationkey as varchar) end as id
  from customer)
select c_custkey,
       case when id is null or id = 'None' then ''
            when not regexp_full_match(id, '[0-9]+') then id
            when k.s_nationkey is null then ''
            else 'P' || lpad(id, 2, '0') end as province
from c left join known k on k.s_nationkey = try_cast(c.id as integer)
""")
def province_code_lookup(spark: SparkSession, folder: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    province_id = (
        F.when(segment == "BUILDING", F.lit(None).cast("string"))
        .when(segment == "MACHINERY", "abc")
        .when(segment == "HOUSEHOLD", "None")
        .when(segment == "FURNITURE", (F.col("c_nationkey") + 10).cast("string"))
        .otherwise(F.col("c_nationkey").cast("string"))
    )
    rows = table(spark, folder, "customer").select("c_custkey", province_id.alias("province_id"))
    return decode_province(rows, wards(spark, folder), F.col("province_id"), "province").select(
        "c_custkey", "province"
    )


def areas(spark: SparkSession, folder: str) -> DataFrame:
    """Regions as areas with their nations nested; the first region stands for the whole country."""
    # Region and nation have a fixed 5 and 25 rows at every scale.
    nested = table(spark, folder, "nation").groupBy("n_regionkey").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))),
            lambda n: F.struct(
                n["n_nationkey"].cast("string").alias("code"),
                n["n_name"].alias("name"),
                F.lit("").alias("otherCode"),
            ),
        ).alias("localities")
    )
    return (
        table(spark, folder, "region")
        .join(nested, F.col("r_regionkey") == F.col("n_regionkey"))
        .select(
            F.format_string("%02d", "r_regionkey").alias("code"), F.col("r_name").alias("name"), "localities"
        )
    )


# Documents as areas of their source, the lines of the text their localities; src0
# stands for the whole country.
@query("""
with l as (
  select source, lang, unnest(string_split(text, chr(10))) as line,
         generate_subscripts(string_split(text, chr(10)), 1) as pos
  from documents where source <> 'src0')
select source as area_code, lang as area_name, cast(pos - 1 as varchar) as code, line as name from l
""")
def hierarchy_explode(spark: SparkSession, folder: str) -> DataFrame:
    localities = F.transform(
        F.split("text", "\n", -1),
        lambda line, i: F.struct(
            i.cast("string").alias("code"), line.alias("name"), F.lit(None).cast("string").alias("otherCode")
        ),
    )
    documents = table(spark, folder, "documents").select(
        F.when(F.col("source") == "src0", "00").otherwise(F.col("source")).alias("code"),
        F.col("lang").alias("name"),
        localities.alias("localities"),
    )
    return explode_areas(documents).select("area_code", "area_name", "code", "name")


def nation_areas(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("position"),
        F.col("n_nationkey").cast("string").alias("code"),
        F.col("n_name").alias("name"),
        F.lit("").alias("other_code"),
        F.col("n_regionkey").cast("string").alias("area_code"),
        F.concat(F.lit("area "), F.col("n_regionkey").cast("string")).alias("area_name"),
    )


def fold_sql(areas: str, rank: str) -> str:
    """SQL of the fold over the names of ``areas``, in the order of ``rank`` from 0.

    ``kept`` is the list of representatives so far and ``taken`` the one that
    absorbed the area of this step.
    """
    hits = "list_filter(w.kept, lambda x: contains(lower(x.n), lower(n_name)) or contains(lower(n_name), lower(x.n)))"
    return f"""
walk as (
  select -1 as pos, cast([] as struct(k integer, n varchar)[]) as kept, cast(null as integer) as taken
  union all
  select w.pos + 1,
         case when len({hits}) > 0 then w.kept else list_append(w.kept, {{'k': {rank}, 'n': n_name}}) end,
         {hits}[1].k
  from walk w join {areas} on {rank} = w.pos + 1),
folded as (
  select r.pos as k, (select max(t.pos) from walk t where t.taken = r.pos) as last_taken
  from walk r where r.pos >= 0 and r.taken is null)
"""


FOLD = fold_sql("nation", "n_nationkey")


# Brands in the order of their first part: Brand#1 is contained in Brand#10 to 19.
@query(f"""
with recursive brands as (
  select p_brand, min(p_partkey) as first_part, arg_min(p_type, p_partkey) as kind from part group by p_brand),
ranked as (
  select *, p_brand as n_name, cast(row_number() over (order by first_part) - 1 as integer) as rank from brands),
{fold_sql("ranked", "rank")}
select r.p_brand as code, coalesce(o.p_brand, '') as other_code, r.kind as area_code, r.first_part as position
from folded join ranked r on r.rank = k left join ranked o on o.rank = last_taken
""")
def alias_fold(spark: SparkSession, folder: str) -> DataFrame:
    brands = (
        table(spark, folder, "part")
        .groupBy(F.col("p_brand").alias("code"))
        .agg(F.min("p_partkey").alias("position"), F.min_by("p_type", "p_partkey").alias("area_code"))
        .select("*", F.col("code").alias("name"), F.lit("").alias("other_code"), F.lit("").alias("area_name"))
    )
    return fold_aliases(brands).select("code", "other_code", "area_code", "position")


@query(f"""
with recursive {FOLD}
select s_suppkey, cast(coalesce(d.k, o.k) as varchar) as code,
       coalesce(cast(coalesce(d.last_taken, o.last_taken) as varchar), '') as other_code
from supplier
left join folded d on d.k = s_nationkey
left join folded o on o.last_taken = s_nationkey and d.k is null
where d.k is not null or o.k is not null
""")
def two_step_lookup(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "supplier").select("s_suppkey", F.col("s_nationkey").cast("string").alias("code"))
    resolved = resolve_area(rows, fold_aliases(nation_areas(spark, folder)), "code")
    return resolved.select("s_suppkey", "code", F.col("area.other_code").alias("other_code"))
