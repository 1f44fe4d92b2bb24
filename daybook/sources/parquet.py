"""Parquet scans and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Columns of the status dictionary.
DICTIONARY_DDL = "type string, table string, code int, description_vi string"


def read_where(spark: SparkSession, path: str, field: str | None = None, value: object | None = None) -> DataFrame:
    """Parquet with one optional equality, which reaches the scan."""
    rows = spark.read.parquet(path)
    if field is None or value is None:
        return rows
    return rows.filter(F.col(field) == F.lit(value))


def typed(rows: DataFrame, ddl: str) -> DataFrame:
    """Columns in declared order and type; the last step before a sink."""
    fields = StructType.fromDDL(ddl).fields
    return rows.selectExpr(*[f"cast(`{f.name}` as {f.dataType.simpleString()}) as `{f.name}`" for f in fields])


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Status dictionary with the position of each entry, for first-match lookups.

    Positions follow the names of the files and the rows within them, however
    Spark deals the files out.
    """
    place = F.struct("_metadata.file_path", "_metadata.row_index")
    return spark.read.schema(DICTIONARY_DDL).parquet(path).withColumn("position", place)


def write_report(report: DataFrame, path: str, stamp: str, year: int) -> int:
    """Append a report below its year and stamp; returns its number of rows.

    Only the partitions present in ``report`` are replaced, so a second run of
    the same stamp replaces its rows instead of doubling them, and an empty report
    writes no rows. ``stamp`` is the column that identifies the run, ``year`` that
    of the period the report is about.
    """
    written = Observation()
    keyed = report.observe(written, F.count("*").alias("rows")).withColumn(
        "report_stamp", F.col(stamp).cast("string")
    )
    (
        keyed.withColumn("report_year", F.lit(str(year)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("report_year", "report_stamp")
        .parquet(path)
    )
    return written.get["rows"]
