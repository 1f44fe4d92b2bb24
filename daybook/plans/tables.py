"""Shape of the keyed tables, and the daily ingest over stored ones."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType

from daybook.operators.merge import KEY, PERIOD
from daybook.plans import flows
from daybook.plans.flows import Flow
from daybook.plans.labels import Labels
from daybook.plans.run import Run
from daybook.session import settings, work_folder
from daybook.sources.archives import scan_with_archives
from daybook.sources.collections import SCHEMAS
from daybook.sources.keyed import (
    CHANGED,
    bucket_count,
    bucketed,
    current,
    finish,
    forget,
    is_published,
    periods_of,
    publish,
)

ALL_FLOWS = (*flows.DAILY, flows.PROBLEM_GUIDE)


def table_schema(spark: SparkSession, table: str) -> StructType:
    """``row_key``, a struct per family of every flow into the table, its history map, and the period."""
    if table not in _SCHEMAS:
        _SCHEMAS[table] = _table_schema(spark, table)
    return _SCHEMAS[table]


# Shapes are the same in every session; only their text form is kept.
_SCHEMAS: dict[str, StructType] = {}


def _table_schema(spark: SparkSession, table: str) -> StructType:
    run, labels = Run.on("2000-01-01"), Labels("-", "-")
    columns = ["row_key string"]
    for flow in ALL_FLOWS:
        if flow.table != table:
            continue
        shape = flow.flatten(spark.createDataFrame([], SCHEMAS[flow.collection]).limit(0), run, labels).schema
        columns += [f"{family} {shape[family].dataType.simpleString()}" for family in flow.families]
        if flow.history:
            columns.append(f"{flow.history[0]} map<date,string>")
    # Stored cells may all be absent, whatever the flow says of its own.
    return StructType.fromDDL(", ".join([*columns, f"{PERIOD} string"]))


def empty_table(spark: SparkSession, table: str) -> DataFrame:
    """Rows that the plan knows to be none, so that a join with them leaves the other side dealt as it was."""
    columns = [f"cast(null as {f.dataType.simpleString()}) as {f.name}" for f in table_schema(spark, table).fields]
    return spark.sql(f"select {', '.join(columns)} from values (1) where false")


def ingest_into(
    spark: SparkSession,
    root: str,
    flow: Flow,
    documents: DataFrame,
    run: Run,
    stamp: str,
    labels: Labels,
    buckets: int = 200,
) -> dict[str, object]:
    """Merge one collection into the stored table and make the result current.

    The batch is written once, bucketed like the table. The index tells which
    periods its keys lie in; only these are read, merged and staged, and only those
    with a row that really changes are replaced. ``buckets`` is the least number for
    the first run into a table, which takes more for a larger batch (``BUCKET_ROWS``);
    later runs keep its buckets. Returns how many records were scanned and quarantined.
    """
    schema = table_schema(spark, flow.table)
    finish(spark, root, flow.table, schema)
    buckets = bucket_count(spark, root, flow.table, 0) or max(buckets, buckets_for(flow.scan(documents, run, labels)))
    seen = Observation()
    folder = work_folder(spark, "batch")
    with settings(spark, shuffles_into(buckets)):
        batch = bucketed(flow.flatten(flow.scan(documents, run, labels, seen), run, labels), folder, buckets)
    merged = merged_periods(spark, root, flow, batch, run)
    publish(merged, root, flow.table, stamp, buckets, schema)
    forget(spark, folder, os.path.dirname(folder))
    return seen.get


# Rows of a first batch for each bucket: a task of a merge holds those of one bucket.
BUCKET_ROWS = 50_000
# Most bytes of several shuffled buckets that one task sorts and writes; rows are some ten times as large in memory.
TASK_SIZE = "8MB"


def buckets_for(rows: DataFrame) -> int:
    return -(-rows.count() // BUCKET_ROWS)


def merged_periods(spark: SparkSession, root: str, flow: Flow, batch: DataFrame, run: Run) -> DataFrame:
    """All rows of the periods a batch touches, merged, and whether they are ``CHANGED``.

    Nothing is shuffled: the rows compared with are carried along.
    """
    target = current(spark, root, flow.table, table_schema(spark, flow.table))
    touched = target.filter(F.col(PERIOD).isin(periods_of(spark, root, flow.table, batch)))
    merged = flow.merge(touched.withColumn("row_before", comparable(touched)), batch, run)
    return merged.withColumn(CHANGED, ~F.col("row_before").eqNullSafe(comparable(merged.drop("row_before")))).drop("row_before")


def comparable(rows: DataFrame) -> Column:
    """All cells of a row but its key, maps as sorted entries."""
    return F.struct(
        *[
            F.array_sort(F.map_entries(f.name)).alias(f.name) if isinstance(f.dataType, MapType) else F.col(f.name)
            for f in sorted(rows.schema.fields, key=lambda f: f.name)
            if f.name != KEY
        ]
    )


def shuffles_into(partitions: int) -> dict[str, str]:
    """Shuffle the batch into as many partitions as there are buckets, so that each task writes the files of its own.

    Small ones are taken together only up to ``TASK_SIZE``.
    """
    return {"spark.sql.shuffle.partitions": str(partitions), "spark.sql.adaptive.advisoryPartitionSizeInBytes": TASK_SIZE}


def daily_ingest(
    spark: SparkSession,
    root: str,
    documents: Callable[[str], DataFrame],
    run: Run,
    labels: Labels,
    open_archives: Callable[[list[str]], DataFrame],
    buckets: int = 200,
) -> dict[str, dict[str, object]]:
    """All flows in order; the outcome of each by collection.

    A run that is started again, with the same run time, goes on after the tables
    it has already published. Transactions come from the live collection and from
    every archived one whose time span meets the window; ``open_archives`` opens these.
    """
    outcome = {}
    for step, flow in enumerate(flows.DAILY):
        stamp = f"{run.time:%Y%m%d%H%M%S}{step:02d}"
        if is_published(spark, root, flow.table, stamp):
            outcome[flow.collection] = {}
            continue
        source = documents(flow.collection)
        if flow is flows.SIGNATURE_TRANSACTION:
            window = run.ingest_window
            source = scan_with_archives(source, documents("CutOff"), flow.collection, *window, open_archives)
        outcome[flow.collection] = ingest_into(spark, root, flow, source, run, stamp, labels, buckets)
    return outcome
