"""Physical plans of the reports over stored tables: what is read and what is shuffled."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from daybook.operators.merge import insert_or_patch, latest_per_key
from daybook.plans.reports import cumulative_report, signing_report, unmatched_registrations, orders_in_window
from daybook.plans.run import Run
from daybook.plans.tables import empty_table, table_schema
from daybook.session import work_folder
from daybook.sources.keyed import CHANGED, current, publish

RUN = Run.on("2025-05-15")


@pytest.fixture(scope="module")
def stored(spark):
    root = work_folder(spark, "plans")
    at = datetime(2025, 4, 20)

    def table(name, **families):
        schema = table_schema(spark, name)
        row = {"row_key": "k", "period": "2025-04", **families}
        publish(spark.createDataFrame([row], schema).withColumn(CHANGED, F.lit(True)), root, name, "1", 8, schema)
        return current(spark, root, name, schema)

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield {
        "SignatureTransaction": table("SignatureTransaction", info={"req_time": at, "app_id": "a"}),
        "Credential": table("Credential", info={"valid_from": at, "valid_to": at, "locality_code": "x"}),
        "Cert": table("Cert", info={"created_date": at, "status": "5"}),
        "CertOrder": table("CertOrder", info={"created_date": at}),
        "User": table("User", register={"uid": "u"}),
    }
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def below_exchanges(plan):
    """The operator right below each shuffle."""
    lines = plan.splitlines()
    return [
        re.sub(r"^[\s:+*\-]*(\(\d+\) )?", "", lines[i + 1]).split("(")[0] for i, line in enumerate(lines) if "Exchange" in line
    ]


def test_signing_sums_without_the_keys(stored):
    """The sums are hash aggregates from the scan on, which reads no key; only names are asked by key."""
    plan = plan_of(signing_report(stored["SignatureTransaction"], RUN)).splitlines()
    scans = [i for i, line in enumerate(plan) if "FileScan" in line]
    sums = next(i for i in scans if "row_key" not in re.search(r"ReadSchema: (.*)", plan[i]).group(1))
    exchange = max(i for i in range(sums) if "Exchange" in plan[i])
    assert "HashAggregate" in plan[exchange + 1]
    assert not any("Sort" in line for line in plan[exchange:sums])
    assert "GreaterThanOrEqual(info.req_time" in plan[sums] and "LessThan(info.req_time" in plan[sums]
    names = [re.search(r"ReadSchema: (.*)", plan[i]).group(1) for i in scans if "row_key" in plan[i].split("ReadSchema")[1]]
    assert names and all("status" not in n and "tran_code" not in n for n in names)


def test_cumulative_shuffles_counts_only(stored):
    plan = plan_of(cumulative_report(stored["Credential"], stored["Cert"], RUN))
    assert set(below_exchanges(plan)) == {"HashAggregate"}
    assert "EqualTo(info.status,5)" in plan and "In(info.request_type, [0,1])" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    # The keys of valid personal credentials come from the bucketed table as they lie.
    assert "Bucketed: true" in plan


def test_registrations_are_not_shuffled(stored):
    plan = plan_of(unmatched_registrations(stored["User"], orders_in_window(stored["CertOrder"], RUN), RUN))
    assert below_exchanges(plan) == ["HashAggregate"], "only the distinct keys of the orders are"
    assert "subject" not in re.search(r"ReadSchema: (.*)", plan).group(1)


def test_rows_merged_into_an_empty_table_are_shuffled_once(spark):
    """The join of a second run takes the first one's rows as their de-duplication left them."""
    rows = spark.range(100).selectExpr("cast(id as string) as row_key", "id as at", "'p' as period")
    schema = table_schema(spark, "ProblemGuide")
    info = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema["info"].dataType.fields]).alias("info")
    merged = empty_table(spark, "ProblemGuide")
    assert merged.schema == schema
    for _ in range(2):
        merged = insert_or_patch(merged, latest_per_key(rows.select("row_key", info, "period"), ["info"]), "info", ["status"])
    assert plan_of(merged).count("Exchange hashpartitioning") == 2
    assert merged.count() == 100
