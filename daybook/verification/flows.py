"""Ingest flows end to end: documents made of the given tables, windowed, flattened and merged.

A plain text field of a document holds its own name and the record's key, so
that a column filled from the wrong field shows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType, TimestampType

from daybook.functions.cells import struct_of
from daybook.functions.times import NO_DATE, instant
from daybook.operators.merge import KEY
from daybook.plans import flows
from daybook.plans.labels import Labels
from daybook.plans.run import Run
from daybook.plans.tables import empty_table, ingest_into, table_schema
from daybook.session import work_folder
from daybook.sources.collections import SCHEMAS
from daybook.sources.keyed import current
from daybook.verification.registry import query
from daybook.verification.tables import table

LABELS = Labels("Operator", "BUILDING")
FIRST, SECOND = Run.on("1998-06-15"), Run.on("1999-03-01")
FIRST_WINDOW = ("1997-06-14 17:00:00", "1998-06-14 17:00:00")
SECOND_WINDOW = ("1998-02-28 17:00:00", "1999-02-28 17:00:00")


def tag_text(name: str, key: str) -> str:
    return f"concat('{name}-', {key})"


def tag(name: str, key: str) -> Column:
    return F.expr(tag_text(name, key))


def tags(key: str, names: str) -> Column:
    """Struct of tagged text fields."""
    return F.expr(struct_of({n: tag_text(n, key) for n in names.split()}))


def documents(rows: DataFrame, collection: str, key: str, **given: Column) -> DataFrame:
    """Documents of a collection: the given fields, tags in other text fields, null elsewhere.

    ``key`` is SQL text; it is the record's key unless that is given.
    """
    columns = []
    for f in StructType.fromDDL(SCHEMAS[collection]).fields:
        if f.name in given:
            columns.append(given[f.name].cast(f.dataType).alias(f.name))
        elif f.name in ("_id", "requestId"):
            columns.append(F.expr(f"{key} as {f.name}"))
        elif isinstance(f.dataType, StringType):
            columns.append(F.expr(f"{tag_text(f.name, key)} as {f.name}"))
        else:
            columns.append(F.expr(f"cast(null as {f.dataType.simpleString()}) as {f.name}"))
    return rows.select(*columns)


def flat(rows: DataFrame) -> DataFrame:
    """Families as prefixed columns, instants as epoch milliseconds."""
    columns = [KEY]
    for family in rows.schema.fields:
        if isinstance(family.dataType, StructType):
            for f in family.dataType.fields:
                cell = f"{family.name}.{f.name}"
                if isinstance(f.dataType, TimestampType):
                    cell = f"unix_millis({cell})"
                columns.append(f"{cell} as {family.name}_{f.name}")
    return rows.selectExpr(*columns)


def tag_sql(family: str, pairs: str) -> str:
    """SQL of tagged columns from lines of ``column field``."""
    return ", ".join(
        f"'{source}-' || k as {family}_{name}" for name, source in (line.split() for line in pairs.strip().splitlines())
    )


def merged_sql(columns: str, patch: str, fill: str = "", numbers: str = "") -> str:
    """SQL of a merge of ``b`` into ``a`` by ``k``: patched columns, the rest kept or inserted."""
    out = ["coalesce(a.k, b.k) as row_key"]
    for c in columns.split():
        if c in patch.split():
            blank = "" if c in numbers.split() else f" and a.{c} is distinct from ''"
            absent = "" if c in fill.split() or c not in numbers.split() else f" and a.{c} is not null"
            out.append(
                f"case when a.k is null then b.{c} when b.k is not null and a.{c} is distinct from b.{c}"
                f"{blank}{absent} then b.{c} else a.{c} end as {c}"
            )
        else:
            out.append(f"case when a.k is null then b.{c} else a.{c} end as {c}")
    return f"select {', '.join(out)} from a full outer join b on a.k = b.k"


# --- certificate orders, two runs ------------------------------------------------


def cert_order_documents(spark: SparkSession, folder: str, later: bool) -> DataFrame:
    """Orders as documents; the later state of an order is 300 days on, 7 statuses further."""
    orders, customer = table(spark, folder, "orders"), table(spark, folder, "customer")
    rows = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    key = "cast(o_orderkey as string)"
    segment, priority, state = F.col("c_mktsegment"), F.col("o_orderpriority"), F.col("o_orderstatus")
    name, made = F.col("c_name"), F.col("o_orderdate")
    updated = made + F.expr("INTERVAL 300 DAYS") if later else made + F.expr("INTERVAL 1 HOUR")
    pricing = F.struct(
        tag("PricingCode", key).alias("PricingCode"),
        F.when(priority == "1-URGENT", F.concat(F.lit("TEST "), state)).otherwise(tag("PricingName", key)).alias("PricingName"),
        F.col("o_totalprice").cast("decimal(15,2)").cast("string").alias("Price"),
        *[tag(n, key).alias(n) for n in ("Code", "SignType", "Validity")],
    )

    def log(is_error: Column, content: str, hours: int) -> Column:
        return F.struct(
            is_error.alias("IsError"),
            tag(content, key).alias("Content"),
            (made + F.expr(f"INTERVAL {hours} HOURS")).alias("CreatedDate"),
        )

    logs = F.array(
        log(F.lit("true"), "first", 1),
        log(F.when(priority == "2-HIGH", "1").otherwise("0"), "second", 2),
        log(F.lit("false"), "third", 3),
    )
    signed = F.when(F.lit(later) | (F.col("o_custkey") % 3 != 0), tag("signed", key))
    urls = F.array(*[F.struct(u.alias("UrlSigned")) for u in (tag("draft", key), signed)])
    return documents(
        rows,
        "CertOrder",
        key,
        FullName=F.when(segment == "MACHINERY", F.concat(F.lit("Test "), name))
        .when(segment == "HOUSEHOLD", F.concat(F.lit("tESt "), name))
        .otherwise(name),
        Pricing=F.when(~((priority == "5-LOW") & (state == "P")), pricing),
        DHSXKDCustomerInfo=F.when(F.col("c_acctbal") >= 0, tags(key, "ma_tb ma_gd ma_kh ma_hd ma_hrm")),
        Status=F.lit(52 if later else 45) + F.col("o_custkey") % 50,
        StatusDesc=F.when(priority == "3-MEDIUM", "").otherwise(
            F.concat(F.lit("later " if later else "first "), state)
        ),
        CreatedDate=F.when(F.col("c_nationkey") != 24, made),
        UpdatedDate=F.when(state == "O", instant(NO_DATE)).otherwise(updated),
        Logs=F.when(segment != "FURNITURE", logs).otherwise(F.array()),
        AcceptanceDocuments=F.when(state == "F", urls).when(state == "O", F.array()),
        # Null at first for half of the customers; filled later.
        **{n: F.when(F.lit(later) | (F.col("o_custkey") % 2 == 0), tag(n, key)) for n in ("CredentialId", "Serial", "ContractUrl")},
        Address=F.when(
            F.col("c_nationkey") >= 5,
            tags(key, "provinceId provinceName districtId districtName wardId wardName streetName address"),
        ),
    )


def _cert_order_sql(name: str, later: bool, window: tuple[str, str]) -> str:
    updated = f"o_orderdate + interval {'300 day' if later else '1 hour'}"
    fields = tag_sql(
        "info",
        """
        identity_id IdentityId
        uid Uid
        email Email
        phone Phone
        locality_code LocalityCode
        type Type
        type_desc TypeDesc
        client_name ClientName
        client_id ClientId
        ma_tb ma_tb
        ma_gd ma_gd
        ma_kh ma_kh
        ma_hd ma_hd
        ma_hrm ma_hrm
        source Source
        request_cert_id RequestCertId
        pricing_code PricingCode
        pricing_name PricingName
        code Code
        sign_type SignType
        validity Validity
        ma_gt MaGt
        previous_serial PreviousSerial
        """,
    )
    filled = ", ".join(
        f"case when {later} or o_custkey % 2 = 0 then '{s}-' || k end as info_{t}"
        for t, s in (("credential_id", "CredentialId"), ("serial", "Serial"), ("contract_url", "ContractUrl"))
    )
    address = ", ".join(
        f"case when c_nationkey >= 5 then '{s}-' || k else '' end as {t}"
        for t, s in (
            ("info_address", "address"),
            ("address_province_id", "provinceId"),
            ("address_province_name", "provinceName"),
            ("address_district_id", "districtId"),
            ("address_district_name", "districtName"),
            ("address_ward_id", "wardId"),
            ("address_ward_name", "wardName"),
            ("address_street_name", "streetName"),
            ("address_address_detail", "address"),
        )
    )
    return f"""
{name}_docs as (
  select *, cast(o_orderkey as varchar) as k, {52 if later else 45} + o_custkey % 50 as status,
         case when o_orderstatus <> 'O' then {updated} end as updated
  from orders join customer on c_custkey = o_custkey
  where (o_orderdate >= timestamp '{window[0]}' or (o_orderstatus <> 'O' and {updated} >= timestamp '{window[0]}'))
    and o_orderdate < timestamp '{window[1]}'
    and c_mktsegment <> 'MACHINERY' and o_orderpriority <> '1-URGENT' and c_acctbal >= 0
    and not (o_orderpriority = '5-LOW' and o_orderstatus = 'P') and c_nationkey <> 24),
{name}_log as (
  select *, updated is not null and status between 50 and 98 and c_mktsegment <> 'FURNITURE' as failed,
         o_orderpriority = '2-HIGH' as second
  from {name}_docs),
{name} as (
  select k, {fields}, {filled}, {address},
         case c_mktsegment when 'HOUSEHOLD' then 'tESt ' || c_name else c_name end as info_full_name,
         cast(status as varchar) as info_status,
         case o_orderpriority when '3-MEDIUM' then '' else '{'later' if later else 'first'} ' || o_orderstatus end as info_status_desc,
         epoch_ms(o_orderdate) as info_created_date, epoch_ms(updated) as info_updated_date,
         cast(cast(o_totalprice as decimal(15, 2)) as varchar) as info_pricing_price,
         case when o_orderstatus <> 'F' then '' when {later} or o_custkey % 3 <> 0 then 'signed-' || k end as info_acceptance_url,
         case when failed then case when second then 'second-' else 'first-' end || k end as info_log_content,
         case when failed then epoch_ms(o_orderdate + case when second then interval 2 hour else interval 1 hour end)
              end as info_log_created_date
  from {name}_log)
"""


CERT_ORDER_COLUMNS = (
    "info_identity_id info_uid info_full_name info_email info_phone info_locality_code info_type info_type_desc "
    "info_status info_status_desc info_client_name info_client_id info_created_date info_updated_date info_ma_tb "
    "info_ma_gd info_ma_kh info_ma_hd info_ma_hrm info_address info_source info_request_cert_id info_serial "
    "info_credential_id info_pricing_code info_pricing_name info_pricing_price info_code info_sign_type "
    "info_validity info_ma_gt info_previous_serial info_contract_url info_acceptance_url info_log_content "
    "info_log_created_date address_province_id address_province_name address_district_id address_district_name "
    "address_ward_id address_ward_name address_street_name address_address_detail"
)


@query(
    "with "
    + _cert_order_sql("a", False, FIRST_WINDOW)
    + ","
    + _cert_order_sql("b", True, SECOND_WINDOW)
    + merged_sql(
        CERT_ORDER_COLUMNS,
        "info_status info_status_desc info_updated_date info_request_cert_id info_credential_id info_contract_url "
        "info_acceptance_url info_log_content info_log_created_date info_serial",
        fill="info_log_content info_log_created_date",
        numbers="info_updated_date info_log_created_date",
    ),
    text="info_updated_date info_log_created_date",
)
def cert_order_two_runs(spark: SparkSession, folder: str) -> DataFrame:
    first = flows.CERT_ORDER.ingest(empty_table(spark, "CertOrder"), cert_order_documents(spark, folder, False), FIRST, LABELS)
    return flat(flows.CERT_ORDER.ingest(first, cert_order_documents(spark, folder, True), SECOND, LABELS))


# --- second runs: texts that change, stay, are blank or absent before or after ------


def varied(documents: DataFrame, fields: str, later: bool, key: str = "_id") -> DataFrame:
    """By the number of the record: absent, blank or given text that is changed later; text that goes; text that stays."""
    n, new = F.split(key, "-")[0].cast("long") % 5, F.lit("later")

    def cell(field: str) -> Column:
        first = F.when(n == 1, "").when(n > 1, F.col(field))
        return F.when(n < 3, new).when(n == 4, F.col(field)) if later else first

    return documents.withColumns({f: cell(f) for f in fields.split()})


def varied_sql(select: str, columns: str, later: bool) -> str:
    n = "cast(split_part(k, '-', 1) as bigint) % 5"
    cells = [
        f"case when {n} < 3 then 'later' when {n} = 4 then {c} end as {c}" if later else f"case when {n} = 1 then '' when {n} > 1 then {c} end as {c}"
        for c in columns.split()
    ]
    return f"select * replace ({', '.join(cells)}) from ({select})"


def two_runs_sql(flow: flows.Flow, ctes: str, select: str, columns: str) -> str:
    """SQL of a first and a second run of a flow; the second one's window takes the place of the first one's."""
    later = select
    for first, second in zip(FIRST_WINDOW, SECOND_WINDOW, strict=True):
        later = later.replace(first, second)
    family = next(iter(flow.families))
    lines = [line.split() for line in flow.families[family].strip().splitlines()]
    merged = merged_sql(
        " ".join(f"{family}_{name}" for name, *_ in lines),
        " ".join(f"{family}_{c}" for c in flow.patch.split()),
        numbers=" ".join(f"{family}_{name}" for name, _, *kind in lines if kind and kind[0] in ("instant", "as_is")),
    )
    return f"with {ctes} a as ({varied_sql(select, columns, False)}), b as ({varied_sql(later, columns, True)}) {merged}"


def two_runs(spark: SparkSession, flow: flows.Flow, source: DataFrame, fields: str) -> DataFrame:
    rows = empty_table(spark, flow.table)
    for run, later in ((FIRST, False), (SECOND, True)):
        rows = flow.ingest(rows, varied(source, fields, later), run, LABELS)
    return flat(rows.select(KEY, next(iter(flow.families))))


# --- registrations and users into one table --------------------------------------


def ordering_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with the dates of their first and last order."""
    dates = (
        table(spark, folder, "orders")
        .groupBy("o_custkey")
        .agg(F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order"))
    )
    return table(spark, folder, "customer").join(dates, F.col("c_custkey") == F.col("o_custkey"))


def register_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with a positive balance; they registered with their first order."""
    key = "cast(c_custkey as string)"
    return documents(
        ordering_customers(spark, folder).filter(F.col("c_acctbal") > 0),
        "Register",
        key,
        status=F.col("c_nationkey"),
        createdDate=F.col("first_order"),
        modifiedDate=F.when(F.col("c_mktsegment") == "BUILDING", instant(NO_DATE)).otherwise(F.col("last_order")),
        address=F.when(
            F.col("c_mktsegment") != "FURNITURE", tags(key, "provinceId districtId wardId streetName address")
        ),
    )


def user_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Customers outside BUILDING as users; the words of their name are roles."""
    key = "cast(c_custkey as string)"
    roles = F.transform(
        F.split("c_name", "#"), lambda w: F.struct(F.when(w != "Customer", w).alias("name"))
    )
    return documents(
        ordering_customers(spark, folder).filter(F.col("c_mktsegment") != "BUILDING"),
        "User",
        key,
        status=F.col("c_nationkey"),
        createDate=F.col("first_order"),
        modifiedDate=F.when(F.col("c_nationkey") != 7, F.col("last_order") + F.expr("INTERVAL 5 HOURS")),
        provinceCodes=F.when(
            F.col("c_nationkey") > 9, F.array(F.struct(F.lit("north").alias("name")), F.struct(F.lit("south").alias("name")))
        ),
        roles=F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.array()).otherwise(roles),
        isTest=F.col("c_nationkey") == 3,
        isComAdmin=F.when(F.col("c_nationkey") < 20, F.lit(False)),
        identityAddress=F.when(
            F.col("c_mktsegment") != "FURNITURE",
            tags(key, "provinceId provinceName districtId districtName wardId wardName streetName address"),
        ),
    )


def _address_sql(family: str, pairs: str) -> str:
    return ", ".join(
        f"case when c_mktsegment <> 'FURNITURE' then '{s}-' || k else '' end as {family}_{t}"
        for t, s in (line.split() for line in pairs.strip().splitlines())
    )


_REGISTER_PLACE = """
    province_id provinceId
    district_id districtId
    ward_id wardId
    street_name streetName
    address address
"""
_USER_PLACE = """
    province_id provinceId
    province_name provinceName
    district_id districtId
    district_name districtName
    ward_id wardId
    ward_name wardName
    street_name streetName
    address address
"""
_REGISTER_TAGS = """
    full_name fullName
    uid uid
    phone phone
    email email
    status_desc statusDesc
    source source
"""
_USER_TAGS = """
    uid uid
    username username
    full_name fullName
    phone phone
    email email
    locality_code localityId
    uid_prefix uidPrefix
    user_group_id userGroupId
    status_desc statusDesc
    account_type accountType
    account_type_desc accountTypeDesc
    pre_status preStatus
    province_code provinceCode
    source source
"""


_CUSTOMERS = """
c as (
  select customer.*, cast(c_custkey as varchar) as k, made, last from customer
  join (select o_custkey, min(o_orderdate) as made, max(o_orderdate) as last from orders group by o_custkey)
    on o_custkey = c_custkey),
r as (select *, case when c_mktsegment <> 'BUILDING' then last end as modified from c where c_acctbal > 0),
u as (
  select *, case when c_nationkey <> 7 then last + interval 5 hour end as modified
  from c where c_mktsegment <> 'BUILDING')
"""
REGISTERS = f"""
  select k, {tag_sql("register", _REGISTER_TAGS)}, {_address_sql("register", _REGISTER_PLACE)},
         cast(c_nationkey as varchar) as register_status, epoch_ms(made) as register_create_date,
         epoch_ms(modified) as register_modified_date
  from r where (made >= timestamp '{FIRST_WINDOW[0]}' or modified >= timestamp '{FIRST_WINDOW[0]}')
    and made < timestamp '{FIRST_WINDOW[1]}'
"""
USERS = f"""
  select k, {tag_sql("info", _USER_TAGS)}, {_address_sql("info", _USER_PLACE)},
         cast(c_nationkey as varchar) as info_status, epoch_ms(made) as info_create_date,
         epoch_ms(modified) as info_modified_date,
         case when c_nationkey < 20 then 'False' else '' end as info_is_com_admin,
         case when c_nationkey = 3 then 'True' else 'False' end as info_is_test,
         case when c_nationkey > 9 then 'north, south' else '' end as info_province_codes,
         case when c_mktsegment = 'HOUSEHOLD' then '' else ', ' || split_part(c_name, '#', 2) end as info_roles
  from u where (made >= timestamp '{FIRST_WINDOW[0]}' or modified >= timestamp '{FIRST_WINDOW[0]}')
    and made < timestamp '{FIRST_WINDOW[1]}'
"""


@query(f"""
with {_CUSTOMERS}, a as ({REGISTERS}), b as ({USERS})
select coalesce(a.k, b.k) as row_key, a.* exclude (k), b.* exclude (k) from a full outer join b on a.k = b.k
""", text="register_create_date register_modified_date info_create_date info_modified_date")
def user_table(spark: SparkSession, folder: str) -> DataFrame:
    registered = flows.REGISTER.ingest(empty_table(spark, "User"), register_documents(spark, folder), FIRST, LABELS)
    return flat(flows.USER.ingest(registered, user_documents(spark, folder), FIRST, LABELS))


@query(
    two_runs_sql(flows.REGISTER, _CUSTOMERS + ",", REGISTERS, "register_status_desc"),
    text="register_create_date register_modified_date",
)
def register_two_runs(spark: SparkSession, folder: str) -> DataFrame:
    return two_runs(spark, flows.REGISTER, register_documents(spark, folder), "statusDesc")


@query(
    two_runs_sql(flows.USER, _CUSTOMERS + ",", USERS, "info_status_desc info_province_code info_pre_status"),
    text="info_create_date info_modified_date",
)
def user_two_runs(spark: SparkSession, folder: str) -> DataFrame:
    return two_runs(spark, flows.USER, user_documents(spark, folder), "statusDesc provinceCode preStatus")


# --- signing-turn orders ---------------------------------------------------------


def turn_order_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Lineitems as turn orders: copies of a line are versions of one document."""
    line = table(spark, folder, "lineitem")
    key = "concat(l_orderkey, '-', l_linenumber)"
    part, supplier = "cast(l_partkey as string)", "cast(l_suppkey as string)"

    def pricing(name: str) -> Column:
        return F.struct(
            tag(name, part).alias("Name"),
            tag("tocdo", part).alias("tocdo_id"),
            tag("code", supplier).alias("Code"),
            F.col("l_linenumber").alias("SignTurnNumber"),
        )

    return documents(
        line,
        "PersonalSignTurnOrder",
        key,
        Status=F.col("l_linenumber"),
        CreatedDate=instant("1998-01-01 00:00:00"),
        UpdatedDate=F.col("l_shipdate"),
        TotalMoney=F.expr("concat(l_partkey, '-', l_suppkey)"),
        Pricings=F.when(F.col("l_returnflag") == "A", F.array(pricing("one"), pricing("two"))).when(
            F.col("l_returnflag") == "N", F.array()
        ),
        UserInfo=tags(key, "_id Uid FullName LocalityCode"),
        DHSXKDCustomerInfo=F.when(F.col("l_linestatus") == "O", tags(key, "ma_tb ma_gd ma_kh ma_hd ma_hrm")),
    )


_TURN_TAGS = """
    identity_id _id
    uid Uid
    full_name FullName
    locality_code LocalityCode
    status_desc StatusDesc
    credential_id CredentialId
    payment_order_id PaymentOrderId
    payment_status PaymentStatus
    payment_status_desc PaymentStatusDesc
    is_sync_dhsxkd IsSyncDHSXKD
    ma_gt MaGt
"""


TURN_ORDERS = f"""
with l as (
  select *, cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as k,
         cast(l_partkey as varchar) as p, cast(l_suppkey as varchar) as s
  from lineitem
  where timestamp '1998-01-01 00:00:00' >= timestamp '{FIRST_WINDOW[0]}' or l_shipdate >= timestamp '{FIRST_WINDOW[0]}'),
newest as (
  select * from l
  qualify row_number() over (
    partition by k
    order by l_shipdate desc, case when l_linestatus = 'O' then 1 else 0 end desc,
             case when l_returnflag = 'A' then 'two-' || p else '' end desc,
             case when l_returnflag = 'A' then 'tocdo-' || p else '' end desc,
             case when l_returnflag = 'A' then 'code-' || s else '' end desc,
             case when l_returnflag = 'A' then cast(l_linenumber as varchar) else '0' end desc, p || '-' || s desc) = 1)
select k, {tag_sql("info", _TURN_TAGS)},
       {", ".join(f"case when l_linestatus = 'O' then '{c}-' || k else '' end as info_{c}" for c in ("ma_tb", "ma_gd", "ma_kh", "ma_hd", "ma_hrm"))},
       cast(l_linenumber as varchar) as info_status, epoch_ms(timestamp '1998-01-01 00:00:00') as info_created_date,
       epoch_ms(l_shipdate) as info_updated_date,
       case when l_returnflag = 'A' then 'two-' || p else '' end as info_pricing_name,
       case when l_returnflag = 'A' then 'tocdo-' || p else '' end as info_pricing_code,
       case when l_returnflag = 'A' then 'code-' || s else '' end as info_code,
       case when l_returnflag = 'A' then cast(l_linenumber as varchar) else '0' end as info_sign_turn_number,
       p || '-' || s as info_total_money
from newest
"""


@query(f"select k as row_key, * exclude (k) from ({TURN_ORDERS})")
def turn_order_table(spark: SparkSession, folder: str) -> DataFrame:
    target = empty_table(spark, "PersonalSignTurnOrder")
    return flat(flows.PERSONAL_SIGN_TURN_ORDER.ingest(target, turn_order_documents(spark, folder), FIRST, LABELS))


@query(
    two_runs_sql(flows.PERSONAL_SIGN_TURN_ORDER, "", TURN_ORDERS, "info_status_desc info_payment_status info_payment_status_desc"),
    text="info_created_date info_updated_date",
)
def turn_order_two_runs(spark: SparkSession, folder: str) -> DataFrame:
    source = turn_order_documents(spark, folder)
    return two_runs(spark, flows.PERSONAL_SIGN_TURN_ORDER, source, "StatusDesc PaymentStatus PaymentStatusDesc")


# --- certificate requests and certificates into one table ------------------------


def request_documents(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    key = "cast(o_orderkey as string)"
    made, state = F.col("o_orderdate"), F.col("o_orderstatus")
    return documents(
        orders,
        "RequestCert",
        key,
        createdDate=made,
        updatedTime=F.when(state == "F", instant(NO_DATE)).otherwise(made + F.expr("INTERVAL 1 DAY")),
        approveTime=F.when(state == "P", made + F.expr("INTERVAL 2 DAYS")),
        username=F.when(state == "O", "  ").otherwise(tag("OPER", key)),
    )


def cert_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Lineitems as certificates of the request of their order, several per request."""
    line = table(spark, folder, "lineitem")
    key = "cast(l_orderkey as string)"
    return documents(
        line,
        "Cert",
        key,
        serial=F.expr("concat(l_partkey, '-', l_suppkey)"),
        validFrom=F.col("l_shipdate"),
        validTo=F.col("l_shipdate") + F.expr("INTERVAL 365 DAYS"),
        createDate=F.col("l_shipdate"),
    )


_REQUEST_TAGS = """
    credential_id credentialId
    status status
    status_desc statusDesc
    client_id createdByClientId
    client_name createdByClientName
    pricing_code pricingCode
    pricing_name pricingName
    uid uid
    identity_id identityId
    full_name fullName
    period period
    code code
    request_type requestType
    request_type_desc requestTypeDesc
"""


REQUESTS = f"""
  select k, {tag_sql("info", _REQUEST_TAGS)}, '' as info_locality_code,
         case o_orderstatus when 'O' then '  ' else 'OPER-' || k end as info_username,
         epoch_ms(o_orderdate) as info_created_date,
         case when o_orderstatus <> 'F' then epoch_ms(o_orderdate + interval 1 day) end as info_updated_time,
         case when o_orderstatus = 'P' then epoch_ms(o_orderdate + interval 2 day) end as info_approve_time
  from (select *, cast(o_orderkey as varchar) as k from orders)
  where (o_orderdate >= timestamp '{FIRST_WINDOW[0]}'
         or (o_orderstatus <> 'F' and o_orderdate + interval 1 day >= timestamp '{FIRST_WINDOW[0]}'))
    and o_orderdate < timestamp '{FIRST_WINDOW[1]}'
"""


@query(f"""
with a as ({REQUESTS}),
b as (
  select k, 'status-' || k as cert_cert_status, 'statusDesc-' || k as cert_cert_status_desc,
         cast(l_partkey as varchar) || '-' || cast(l_suppkey as varchar) as cert_serial, 'subject-' || k as cert_subject,
         epoch_ms(l_shipdate) as cert_valid_from, epoch_ms(l_shipdate + interval 365 day) as cert_valid_to,
         epoch_ms(l_shipdate) as cert_cert_created_date
  from (select *, cast(l_orderkey as varchar) as k from lineitem)
  where l_shipdate >= timestamp '{FIRST_WINDOW[0]}' and l_shipdate < timestamp '{FIRST_WINDOW[1]}'
  qualify row_number() over (
    partition by k
    order by l_shipdate desc, cast(l_partkey as varchar) || '-' || cast(l_suppkey as varchar) desc) = 1)
select coalesce(a.k, b.k) as row_key, a.* exclude (k), b.* exclude (k) from a full outer join b on a.k = b.k
""", text="info_created_date info_updated_time info_approve_time cert_valid_from cert_valid_to cert_cert_created_date")
def cert_table(spark: SparkSession, folder: str) -> DataFrame:
    requested = flows.REQUEST_CERT.ingest(empty_table(spark, "Cert"), request_documents(spark, folder), FIRST, LABELS)
    return flat(flows.CERT.ingest(requested, cert_documents(spark, folder), FIRST, LABELS))


@query(
    two_runs_sql(flows.REQUEST_CERT, "", REQUESTS, "info_status info_status_desc"),
    text="info_created_date info_updated_time info_approve_time",
)
def request_two_runs(spark: SparkSession, folder: str) -> DataFrame:
    return two_runs(spark, flows.REQUEST_CERT, request_documents(spark, folder), "status statusDesc")


# --- credentials with status history, two runs -----------------------------------




def credential_documents(spark: SparkSession, folder: str, later: bool) -> DataFrame:
    """Orders as credentials; their certificate dates follow the order date."""
    orders, customer = table(spark, folder, "orders"), table(spark, folder, "customer")
    rows = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    key = "cast(o_orderkey as string)"
    segment, priority, state = F.col("c_mktsegment"), F.col("o_orderpriority"), F.col("o_orderstatus")
    made = F.col("o_orderdate")

    def cert(name: str, days: int) -> Column:
        return F.struct(
            tag(f"{name}status", key).alias("status"),
            tag(f"{name}desc", key).alias("statusDesc"),
            made.alias("validFrom"),
            (made + F.expr(f"INTERVAL {days} DAYS")).alias("validTo"),
            tag(f"{name}request", key).alias("requestId"),
            tag(f"{name}serial", key).alias("serial"),
        )

    identity = F.struct(
        tag("_id", key).alias("_id"),
        F.when(segment == "MACHINERY", F.concat(F.lit("a TEST "), F.expr(key))).otherwise(tag("name", key)).alias("name"),
        *[tag(n, key).alias(n) for n in ("email", "phone")],
        F.when(priority == "1-URGENT", tag("OPER", key)).when(priority == "2-HIGH", tag("aOPER", key)).alias("username"),
        *[tag(n, key).alias(n) for n in ("uid", "createdByClientId", "createdByClientName")],
        F.when(state == "F", " ").otherwise(tag("LocalityCode", key)).alias("LocalityCode"),
        tag("DHSXKDSubcriptionCode", key).alias("DHSXKDSubcriptionCode"),
        tag("source", key).alias("source"),
    )
    contract = F.struct(
        F.when(priority == "3-MEDIUM", F.concat(segment, F.lit(" cá nhân PS0 (Công dân)")))
        .otherwise(tag("servicePack", key))
        .alias("servicePack"),
        *[tag(n, key).alias(n) for n in ("number", "validity")],
        F.when(state == "O", "   ").otherwise(tag("pricingCode", key)).alias("pricingCode"),
        tag("serviceType", key).alias("serviceType"),
    )
    return documents(
        rows,
        "Credential",
        key,
        identity=F.when(F.col("c_nationkey") != 24, identity),
        contract=contract,
        subjectDN=F.when(priority == "4-NOT SPECIFIED", F.concat(F.lit("CN="), state, F.lit(" Test,O=X")))
        .when(priority == "5-LOW", F.concat(F.lit("CN="), state, F.lit(" Testing,O=X")))
        .otherwise(None),
        status=F.when(F.lit(later) & (priority == "1-URGENT"), "1").otherwise("0"),
        createdDate=made,
        modifiedDate=made + F.expr(f"INTERVAL {250 if later else 1} DAYS"),
        certs=F.when(state == "P", F.array(cert("old", 10), cert("new", 100))).when(
            state == "F", F.array(cert("later" if later else "only", 500))
        ),
    )


CREDENTIAL_TAGS = """
    identity_id _id
    full_name name
    email email
    phone phone
    uid uid
    client_id createdByClientId
    client_name createdByClientName
    ma_tb DHSXKDSubcriptionCode
    source source
    contract_number number
    validity validity
    service_type serviceType
    status_desc statusDesc
"""
CREDENTIAL_COLUMNS = (
    "info_subject_dn info_status info_status_desc info_created_date info_modified_date info_identity_id "
    "info_full_name info_username info_email info_phone info_uid info_client_id info_client_name "
    "info_locality_code info_ma_tb info_source info_contract_number info_pricing_name info_validity "
    "info_pricing_code info_service_type info_serial info_valid_from info_valid_to info_request_cert_id "
    "info_cert_status info_cert_status_desc"
)


def _credential_sql(name: str, later: bool, window: tuple[str, str]) -> str:
    touched = f"o_orderdate + interval {250 if later else 1} day"
    only = "later" if later else "only"
    return f"""
{name}_docs as (
  select *, cast(o_orderkey as varchar) as k,
         case o_orderstatus when 'P' then 'new' when 'F' then '{only}' end as c,
         case o_orderstatus when 'P' then o_orderdate + interval 100 day
                            when 'F' then o_orderdate + interval 500 day end as valid_to,
         case o_orderpriority when '1-URGENT' then 'OPER-' || o_orderkey when '2-HIGH' then 'aOPER-' || o_orderkey end as username
  from orders join customer on c_custkey = o_custkey
  where {touched} >= timestamp '{window[0]}' and o_orderdate < timestamp '{window[1]}'
    and c_mktsegment <> 'MACHINERY' and o_orderpriority <> '4-NOT SPECIFIED' and c_nationkey <> 24),
{name} as (
  select k, {tag_sql("info", CREDENTIAL_TAGS)},
         case o_orderpriority when '5-LOW' then 'CN=' || o_orderstatus || ' Testing,O=X' end as info_subject_dn,
         case o_orderpriority when '1-URGENT' then '{"1" if later else "0"}' else '0' end as info_status,
         epoch_ms(o_orderdate) as info_created_date, epoch_ms({touched}) as info_modified_date,
         username as info_username,
         case when o_orderstatus <> 'F' then 'LocalityCode-' || k
              when username is null then ' '
              when o_orderpriority = '1-URGENT' then 'OPE' else 'OP' end as info_locality_code,
         case o_orderpriority when '3-MEDIUM' then c_mktsegment || ' cá nhân PS0 (Công dân)'
                              else 'servicePack-' || k end as info_pricing_name,
         case when o_orderstatus <> 'O' then 'pricingCode-' || k
              when o_orderpriority = '3-MEDIUM' and c_mktsegment = 'BUILDING' then '17187' else '   ' end as info_pricing_code,
         coalesce(c || 'serial-' || k, '') as info_serial,
         case when c is not null then epoch_ms(o_orderdate) end as info_valid_from, epoch_ms(valid_to) as info_valid_to,
         coalesce(c || 'request-' || k, '') as info_request_cert_id,
         case when valid_to < timestamp '{window[1]}' then '4' else coalesce(c || 'status-' || k, '') end as info_cert_status,
         case when valid_to < timestamp '{window[1]}' then 'EXPIRED' else coalesce(c || 'desc-' || k, '') end as info_cert_status_desc
  from {name}_docs)
"""


_CREDENTIALS = _credential_sql("a", False, FIRST_WINDOW) + "," + _credential_sql("b", True, SECOND_WINDOW)


def _two_runs(spark: SparkSession, folder: str) -> DataFrame:
    first = flows.CREDENTIAL.ingest(
        empty_table(spark, "Credential"), credential_documents(spark, folder, False), FIRST, LABELS
    )
    return flows.CREDENTIAL.ingest(first, credential_documents(spark, folder, True), SECOND, LABELS)


CREDENTIALS_SQL = (
    "with "
    + _CREDENTIALS
    + merged_sql(
        CREDENTIAL_COLUMNS,
        "info_status info_status_desc info_modified_date info_serial info_valid_from info_valid_to "
        "info_request_cert_id info_cert_status info_cert_status_desc",
        numbers="info_modified_date info_valid_from info_valid_to",
    )
)


@query(CREDENTIALS_SQL, text="info_valid_from info_valid_to")
def credential_two_runs(spark: SparkSession, folder: str) -> DataFrame:
    return flat(_two_runs(spark, folder))


@query(CREDENTIALS_SQL, text="info_valid_from info_valid_to")
def credential_stored_two_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The same through storage: the second run writes only the periods it touches."""
    root, flow = work_folder(spark, "credentials"), flows.CREDENTIAL
    for run, later in ((FIRST, False), (SECOND, True)):
        source = credential_documents(spark, folder, later)
        ingest_into(spark, root, flow, source, run, run.run_date.isoformat(), LABELS, buckets=4)
    return flat(current(spark, root, flow.table, table_schema(spark, flow.table)))


@query(CREDENTIALS_SQL, text="info_valid_from info_valid_to")
def stored_merge_new_buckets(spark: SparkSession, folder: str) -> DataFrame:
    """As above, the second run asking for other buckets than the table has: every key stays once."""
    root, flow = work_folder(spark, "credentials"), flows.CREDENTIAL
    for run, later, buckets in ((FIRST, False, 4), (SECOND, True, 8)):
        source = credential_documents(spark, folder, later)
        ingest_into(spark, root, flow, source, run, run.run_date.isoformat(), LABELS, buckets=buckets)
    return flat(current(spark, root, flow.table, table_schema(spark, flow.table)))


@query(
    "with "
    + _CREDENTIALS
    + """
select k as row_key, '1998-06-14' as log_date, info_status as status from a
union all
select b.k, '1999-02-28', b.info_status from b left join a on a.k = b.k
where a.k is null or a.info_status <> b.info_status
"""
)
def credential_status_log(spark: SparkSession, folder: str) -> DataFrame:
    return _two_runs(spark, folder).select(
        "row_key", F.explode("status_log").alias("day", "status")
    ).select("row_key", F.date_format("day", "yyyy-MM-dd").alias("log_date"), "status")


# Credentials of nation 24 lack their identity.
@query(f"""
select cast(o_orderkey as varchar) as row_key
from orders join customer on c_custkey = o_custkey
where o_orderdate + interval 1 day >= timestamp '{FIRST_WINDOW[0]}' and o_orderdate < timestamp '{FIRST_WINDOW[1]}'
  and c_nationkey = 24 and o_orderpriority <> '4-NOT SPECIFIED'
""")
def credential_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    documents = credential_documents(spark, folder, False)
    return flows.CREDENTIAL.quarantined(documents, FIRST, LABELS).select(F.col("_id").alias("row_key"))


# --- signature transactions ------------------------------------------------------


def transaction_documents(spark: SparkSession, folder: str, late: bool) -> DataFrame:
    """Events as transactions; the late copy of January's second half has finished."""
    events = table(spark, folder, "events")
    key = "cast(event_id as string)"
    if late:
        events = events.filter(F.col("ts") >= instant("2024-01-15 00:00:00"))
    finished = F.col("ts") + F.expr("INTERVAL 1 MINUTE")
    return documents(
        events,
        "SignatureTransaction",
        key,
        status=F.when(F.lit(late), "1").otherwise(F.col("event_type")),
        reqTime=F.date_trunc("second", "ts"),
        expireTime=F.when(F.col("event_type") == "view", instant(NO_DATE)).otherwise(
            F.date_trunc("second", finished)
        ),
        finishDate=F.date_trunc("second", finished) if late else F.lit(None).cast("timestamp"),
        appId=F.col("user_id").cast("string"),
        appName=F.col("event_type"),
    )


TRANSACTION_TAGS = """
    serial certSerial
    credential_id credentialId
    identity_id identityId
    uid identityUid
    full_name identityName
    email identityEmail
    status_desc statusDesc
    tran_type_desc tranTypeDesc
    tran_type tranType
    execute_time excuteTime
    tran_code tranCode
"""


TRANSACTIONS_SQL = f"""
with e as (select *, cast(event_id as varchar) as k, date_trunc('second', ts) as second from events)
select k as row_key, {tag_sql("info", TRANSACTION_TAGS)},
       case when ts >= timestamp '2024-01-15 00:00:00' and second < timestamp '2024-01-24 17:00:00' then '1' else event_type end as info_status,
       epoch_ms(second) as info_req_time,
       case when event_type <> 'view' then epoch_ms(second + interval 1 minute) end as info_expired_time,
       case when ts >= timestamp '2024-01-15 00:00:00' and second < timestamp '2024-01-24 17:00:00'
            then epoch_ms(second + interval 1 minute) end as info_finish_date,
       cast(user_id as varchar) as info_app_id, event_type as info_app_name
from e where second < timestamp '2024-01-28 17:00:00'
"""


@query(TRANSACTIONS_SQL, text="info_expired_time info_finish_date")
def transaction_two_runs(spark: SparkSession, folder: str) -> DataFrame:
    flow = flows.SIGNATURE_TRANSACTION
    first = flow.ingest(
        empty_table(spark, flow.table), transaction_documents(spark, folder, False), Run.on("2024-01-29"), LABELS
    )
    return flat(flow.ingest(first, transaction_documents(spark, folder, True), Run.on("2024-01-25"), LABELS))


@query(TRANSACTIONS_SQL, text="info_expired_time info_finish_date")
def stored_backfill(spark: SparkSession, folder: str) -> DataFrame:
    """As above through storage: the run of an earlier day comes second and counts."""
    root, flow = work_folder(spark, "backfill"), flows.SIGNATURE_TRANSACTION
    for day, changed in (("2024-01-29", False), ("2024-01-25", True)):
        source = transaction_documents(spark, folder, changed)
        ingest_into(spark, root, flow, source, Run.on(day), day, LABELS, buckets=4)
    return flat(current(spark, root, flow.table, table_schema(spark, flow.table)))


# --- problem guides --------------------------------------------------------------


def guide_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation turns as problem guides, their text whole; system turns have no date."""
    turns = table(spark, folder, "conversations")
    key = "concat(conv_id, '-', turn)"
    return documents(
        turns,
        "ProblemGuide",
        key,
        GuideContent=F.col("text"),
        Status=F.when(F.col("role") != "assistant", F.col("role")),
        CreatedDate=F.when(F.col("role") == "system", instant(NO_DATE)).when(
            F.col("role") == "user", instant("2024-01-01 00:00:00")
        ),
    )


GUIDES = """
with t as (select *, cast(conv_id as varchar) || '-' || cast(turn as varchar) as k from conversations)
select k, 'ErrorMessage-' || k as info_error_message, text as info_guide_content, 'InUsed-' || k as info_in_used,
       case when role <> 'assistant' then role end as info_status, 'StatusDesc-' || k as info_status_desc,
       'type-' || k as info_type_error, 'type_error_desc-' || k as info_type_error_desc,
       case when role = 'user' then epoch_ms(timestamp '2024-01-01 00:00:00')
            else epoch_ms(timestamp '2024-02-01 00:00:00') end as info_created_date
from t qualify row_number() over (partition by k order by info_created_date desc, text desc, info_status desc) = 1
"""


@query(f"select k as row_key, * exclude (k) from ({GUIDES})")
def problem_guide_table(spark: SparkSession, folder: str) -> DataFrame:
    target = empty_table(spark, "ProblemGuide")
    return flat(flows.PROBLEM_GUIDE.ingest(target, guide_documents(spark, folder), Run.on("2024-02-01"), LABELS))


@query(
    two_runs_sql(flows.PROBLEM_GUIDE, "", GUIDES, "info_error_message info_status_desc info_type_error info_type_error_desc")
)
def problem_guide_two_runs(spark: SparkSession, folder: str) -> DataFrame:
    rows, flow = empty_table(spark, "ProblemGuide"), flows.PROBLEM_GUIDE
    for later in (False, True):
        source = varied(guide_documents(spark, folder), "ErrorMessage StatusDesc type type_error_desc", later)
        rows = flow.ingest(rows, source, Run.on("2024-02-01"), LABELS)
    return flat(rows)
