"""Archives: manifest, snapshots and scans that span live and archived data."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.windows import overlaps
from daybook.session import path_exists

# Columns of the manifest.
MANIFEST_DDL = (
    "date_report string, start_time string, end_time string, table_name string, "
    "file_name string, description string, count bigint"
)


def append_manifest(spark: SparkSession, path: str, rows: Iterable[tuple]) -> None:
    spark.createDataFrame(list(rows), MANIFEST_DDL).coalesce(1).write.mode("append").parquet(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST_DDL).parquet(path)


def recorded(spark: SparkSession, path: str, file_name: str) -> list[str]:
    """Report dates under which the manifest lists a file."""
    if not path_exists(spark, path):
        return []
    entries = read_manifest(spark, path).filter(F.col("file_name") == file_name)
    return [row["date_report"] for row in entries.select("date_report").distinct().collect()]


def latest_entry(manifest: DataFrame, table: str) -> DataFrame:
    """Manifest row of the newest snapshot of ``table``."""
    return (
        manifest.filter(F.col("table_name") == table)
        .orderBy(F.col("date_report").desc(), F.col("file_name").desc())
        .limit(1)
    )


def latest_path(manifest: DataFrame, table: str) -> str | None:
    entry = latest_entry(manifest, table).select("file_name").first()
    return entry["file_name"] if entry else None


def overlapping(catalogue: DataFrame, source: str, start: Column | None, end: Column | None) -> DataFrame:
    """Archives of ``source`` whose time span meets the window."""
    return catalogue.filter(
        (F.col("sourceCollection") == source) & overlaps(F.col("fromTime"), F.col("toTime"), start, end)
    )


def scan_with_archives(
    live: DataFrame,
    catalogue: DataFrame,
    source: str,
    start: Column | None,
    end: Column | None,
    open_archives: Callable[[list[str]], DataFrame],
) -> DataFrame:
    """Live rows and the rows of every overlapping archive.

    The archive list is as small as the catalogue and is chosen before any data is
    read; ``open_archives`` opens all of it at once, and the same filter then
    applies to live and archived rows.
    """
    chosen = overlapping(catalogue, source, start, end).select("collectionName").distinct().collect()
    if not chosen:
        return live
    archived = open_archives(sorted(row["collectionName"] for row in chosen))
    return live.unionByName(archived, allowMissingColumns=True)
