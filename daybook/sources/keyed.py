"""Keyed tables on storage, with an index of the periods their keys lie in.

``<root>/<table>/rows`` is a Parquet table partitioned by period and bucketed by key;
``keys`` holds keys and periods alone, laid out alike. A change is first staged whole
below ``staged``, as all rows of each period it changes, and counts from the moment a
mark with its stamp lies there. Then it replaces these periods by dynamic partition
overwrite. A job that dies in between has lost nothing: readers take the staged
periods, and the next change brings the replacement to its end first. One job at a
time changes a table. Marks are empty files: ``runs/<stamp>`` and ``buckets/<number>``.
"""

from __future__ import annotations

import hashlib
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daybook.operators.merge import KEY, PERIOD
from daybook.session import mark, names_below, path_exists, remove_path, settings

#: Tells the staged rows that are not as they were; only periods that have any are replaced.
CHANGED = "changed_row"
#: A write sorts all rows that its task reads: by bucket these are few, by the bytes of well-packed files they are many.
BY_BUCKET = {"spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}
KEYS = StructType().add(KEY, "string").add(PERIOD, "string")


def _name(path: str) -> str:
    return "keyed_" + hashlib.md5(path.encode()).hexdigest()


def declared(spark: SparkSession, path: str, schema: StructType, buckets: int) -> DataFrame:
    """The table at a path, partitioned and bucketed, with the periods that lie there now."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{_name(path)}` ({columns}) USING parquet OPTIONS (partitionOverwriteMode 'dynamic') "
        f"PARTITIONED BY (`{PERIOD}`) CLUSTERED BY (`{KEY}`) SORTED BY (`{KEY}`) INTO {buckets} BUCKETS LOCATION '{location}'"
    )
    if path_exists(spark, path):
        spark.sql(f"MSCK REPAIR TABLE `{_name(path)}` SYNC PARTITIONS")
    return spark.table(_name(path))


def bucketed(rows: DataFrame, path: str, buckets: int, *by: str) -> DataFrame:
    """Rows written to a path, bucketed by key like the tables, and read again."""
    writer = rows.write.mode("overwrite").option("path", path).bucketBy(buckets, KEY).sortBy(KEY)
    (writer.partitionBy(*by) if by else writer).saveAsTable(_name(path))
    return rows.sparkSession.table(_name(path))


def forget(spark: SparkSession, path: str, root: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS `{_name(path)}`")
    remove_path(spark, path, root)


def _waiting(spark: SparkSession, root: str, table: str) -> str | None:
    """Stamp of a change that is staged and not known to have replaced all its periods."""
    return next(iter(names_below(spark, f"{root}/{table}/staged/stamp")), None)


def is_published(spark: SparkSession, root: str, table: str, stamp: str) -> bool:
    return path_exists(spark, f"{root}/{table}/runs/{stamp}") or _waiting(spark, root, table) == stamp


def bucket_count(spark: SparkSession, root: str, table: str, wanted: int) -> int:
    """The buckets a table has had from its first run on; ``wanted`` before it."""
    return int(next(iter(names_below(spark, f"{root}/{table}/buckets")), wanted))


def _staged_periods(spark: SparkSession, root: str, table: str) -> list[str]:
    names = names_below(spark, f"{root}/{table}/staged/rows")
    return [n.removeprefix(f"{PERIOD}=") for n in names if n.startswith(f"{PERIOD}=")]


def _staged(spark: SparkSession, root: str, table: str, schema: StructType, buckets: int) -> DataFrame:
    cells = [f for f in schema.fields if f.name != PERIOD]
    whole = StructType(cells).add(CHANGED, "boolean").add(PERIOD, "string")
    return declared(spark, f"{root}/{table}/staged/rows", whole, buckets)


def current(spark: SparkSession, root: str, table: str, schema: StructType, part: str = "rows") -> DataFrame:
    """The table as of its last change, replaced already or not; empty before the first one.

    Joins and aggregates on the key read it without a shuffle, and a filter on the
    period reads only the periods it names.
    """
    buckets, waiting = bucket_count(spark, root, table, 0), _waiting(spark, root, table)
    if not buckets or (waiting and waiting.endswith(EMPTY)):
        return spark.createDataFrame([], schema)
    rows = declared(spark, f"{root}/{table}/{part}", schema, buckets)
    if not waiting:
        return rows
    replaced = F.col(PERIOD).isin(_staged_periods(spark, root, table))
    staged = _staged(spark, root, table, schema if part == "rows" else KEYS, buckets)
    return rows.filter(~replaced).unionByName(staged.select(*schema.names))


def periods_of(spark: SparkSession, root: str, table: str, batch: DataFrame) -> list[str]:
    """The periods in which the rows of a batch lie, or will lie, by the index alone."""
    known = current(spark, root, table, KEYS, "keys").select(KEY, F.col(PERIOD).alias("known"))
    found = batch.select(KEY, PERIOD).join(known, KEY, "left").select(F.coalesce("known", PERIOD).alias(PERIOD))
    return sorted(row[PERIOD] for row in found.distinct().collect())


def publish(rows: DataFrame, root: str, table: str, stamp: str, buckets: int, schema: StructType) -> None:
    """Replace the periods of ``rows`` that have a row marked as ``CHANGED``.

    ``rows`` must hold all rows of each period it has any of.
    """
    spark, path = rows.sparkSession, f"{root}/{table}/staged"
    if is_published(spark, root, table, stamp):
        raise FileExistsError(f"run {stamp} of {table} is already published")
    finish(spark, root, table, schema)
    forget(spark, f"{path}/rows", root)
    with settings(spark, BY_BUCKET):
        staged = bucketed(rows.select(*[c for c in schema.names if c != PERIOD], CHANGED, PERIOD), f"{path}/rows", buckets, PERIOD)
    changed = {r[PERIOD] for r in staged.filter(CHANGED).select(PERIOD).distinct().collect()}
    for period in set(_staged_periods(spark, root, table)) - changed:
        remove_path(spark, f"{path}/rows/{PERIOD}={period}", root)
    mark(spark, f"{root}/{table}/buckets/{buckets}")
    mark(spark, f"{path}/stamp/{stamp}")
    finish(spark, root, table, schema)


#: What the stamp of a change that leaves nothing ends with.
EMPTY = "_empty"


def publish_empty(spark: SparkSession, root: str, table: str, stamp: str, schema: StructType) -> None:
    """Make the table empty."""
    finish(spark, root, table, schema)
    mark(spark, f"{root}/{table}/staged/stamp/{stamp}{EMPTY}")
    finish(spark, root, table, schema)


def finish(spark: SparkSession, root: str, table: str, schema: StructType) -> None:
    """Bring a staged change to its end; running it again changes nothing."""
    stamp = _waiting(spark, root, table)
    if stamp is None:
        return

    buckets, periods = bucket_count(spark, root, table, 0), _staged_periods(spark, root, table)

    def replace(part: str, columns: StructType) -> None:
        declared(spark, f"{root}/{table}/{part}", columns, buckets)
        staged.select(*columns.names).write.insertInto(_name(f"{root}/{table}/{part}"), overwrite=True)

    if stamp.endswith(EMPTY):
        for part in ("rows", "keys"):
            forget(spark, f"{root}/{table}/{part}", root)
    elif periods:
        staged = _staged(spark, root, table, schema, buckets)
        with settings(spark, BY_BUCKET), ThreadPoolExecutor(2) as both:
            list(both.map(replace, ("rows", "keys"), (schema, KEYS)))
    mark(spark, f"{root}/{table}/runs/{stamp}")
    forget(spark, f"{root}/{table}/staged/rows", root)
    remove_path(spark, f"{root}/{table}/staged", root)
