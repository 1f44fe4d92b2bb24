"""Archive a live table to Parquet, record it and empty the live table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.times import compact_label, micro_label
from daybook.operators.merge import KEY
from daybook.plans.run import Run
from daybook.plans.tables import table_schema
from daybook.sources.archives import append_manifest, recorded
from daybook.sources.keyed import current, publish_empty

# The table that is archived, and those a cut-off accepts without doing anything.
ARCHIVED = "SignatureTransaction"
ACCEPTED = ("Cert", "CertOrder", "User", "Credential", "PersonalSignTurnOrder")
DESCRIPTION = "Cut off data by time"


def span(rows: DataFrame, key: str, time: Column, *by: str) -> DataFrame:
    """Count and the first and last time in key order, per group."""
    return rows.groupBy(*by).agg(
        F.count("*").alias("count"),
        F.min_by(time, F.col(key)).alias("first_time"),
        F.max_by(time, F.col(key)).alias("last_time"),
    )


def manifest_rows(
    spans: DataFrame, date_report: str, table: str, folder: str, stem: str, *by: str
) -> DataFrame:
    """Manifest row of each span, after its group columns; the file is named by the first and last time."""
    file_name = F.concat(
        F.lit(f"{folder}/{stem}_"), compact_label("first_time"), F.lit("_"), compact_label("last_time"), F.lit(".parquet")
    )
    return spans.select(
        *by,
        F.lit(date_report).alias("date_report"),
        micro_label(F.col("first_time")).alias("start_time"),
        micro_label(F.col("last_time")).alias("end_time"),
        F.lit(table).alias("table_name"),
        file_name.alias("file_name"),
        F.lit(DESCRIPTION).alias("description"),
        F.col("count"),
    )


def archive_rows(rows: DataFrame, date_report: Column) -> DataFrame:
    """Families flattened to columns, with the report date."""
    return rows.select(F.col(KEY).alias("_id"), date_report.alias("date_report"), "info.*")


def fingerprint(rows: DataFrame) -> tuple:
    """Number of rows and a sum of their hashes: the same for the same rows in any order.

    Every cell is hashed behind its place, so that a null in one column and in the
    next one differ.
    """
    cells = [c for i, name in enumerate(sorted(rows.columns)) for c in (F.lit(i), F.col(name))]
    hashes = F.sum(F.xxhash64(*cells).cast("decimal(38,0)"))
    return tuple(rows.agg(F.count("*").alias("count"), hashes.alias("hashes")).first())


def archive_transactions(spark: SparkSession, root: str, run: Run) -> bool:
    """Archive the live transactions; False when there are none, an error when the copy is not whole.

    The live table is emptied only after the archive was read back and has the same
    ``fingerprint``. A run that failed on the way can be started again: an archive it
    recorded is kept, one it did not record is written anew.
    """
    schema, manifest = table_schema(spark, ARCHIVED), f"{root}/manifest"
    live = current(spark, root, ARCHIVED, schema)
    spans = span(live.select(KEY, F.col("info.req_time").alias("req_time")), KEY, F.col("req_time"))
    stamp = f"{run.time:%Y%m%d%H%M%S}"
    entry = manifest_rows(
        spans, stamp, ARCHIVED, f"{root}/signature_transaction", "signature_transaction"
    ).first()
    if entry["count"] == 0:
        return False
    path = entry["file_name"]
    earlier = recorded(spark, manifest, path)
    if stamp not in earlier:
        if earlier:
            raise FileExistsError(f"{path} was archived by another run")
        archive_rows(live, run.time_column).write.mode("overwrite").parquet(path)
    rows = archive_rows(live, run.time_column)
    wanted, copied = fingerprint(rows), fingerprint(spark.read.schema(rows.schema).parquet(path))
    if copied != wanted:
        raise RuntimeError(f"{path} is no copy of the live table, which stays as it is: {copied} against {wanted}")
    if not earlier:
        append_manifest(spark, manifest, [tuple(entry)])
    publish_empty(spark, root, ARCHIVED, stamp, schema)
    return True
