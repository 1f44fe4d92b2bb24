"""Lookups against dictionary- and geography-sized tables.

No broadcast hints: Spark broadcasts a side below its size threshold and falls
back to a shuffled join, which adaptive execution splits on skew, above it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.text import all_digits, blank_if_absent


def first_match(table: DataFrame, key: str, values: Sequence[str], order: Column) -> DataFrame:
    """One row per key, the first by ``order``, so that a lookup never multiplies rows."""
    return (
        table.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min_by(F.struct(*values), order).alias("hit"))
        .select(key, *[f"hit.{v}" for v in values])
    )


def status_entries(dictionary: DataFrame, table: str) -> DataFrame:
    """Dictionary rows that describe the status codes of ``table``, first entry per code."""
    chosen = dictionary.filter((F.col("type") == "status") & (F.col("table") == table))
    return first_match(chosen, "code", ["description_vi"], F.col("position"))


def decode_status(
    rows: DataFrame, entries: DataFrame, status: Column, own_text: Column, out: str
) -> DataFrame:
    """Description of a status code; the record's own text where the code is unknown or blank."""
    coded = rows.withColumn("_code", blank_if_absent(status).try_cast("int"))
    hits = entries.select(F.col("code").alias("_code"), F.col("description_vi").alias("_hit"))
    return (
        coded.join(hits, "_code", "left")
        .withColumn(out, F.coalesce("_hit", blank_if_absent(own_text)))
        .drop("_code", "_hit")
    )


def decode_province(rows: DataFrame, localities: DataFrame, province_id: Column, out: str) -> DataFrame:
    """Province id to code: blank and non-digit ids pass as they are, unknown ids give blank."""
    wanted = blank_if_absent(province_id)
    codes = first_match(
        localities.select("province_id", "province_code", "ward_id"),
        "province_id",
        ["province_code"],
        F.struct("ward_id", "province_code"),
    ).select(F.col("province_id").alias("_province"), F.col("province_code").alias("_hit"))
    return (
        rows.withColumn("_wanted", wanted)
        .withColumn("_province", F.when(all_digits(F.col("_wanted")), F.col("_wanted").try_cast("int")))
        .join(codes, "_province", "left")
        .withColumn(
            out,
            F.when(~all_digits(F.col("_wanted")), F.col("_wanted")).otherwise(F.coalesce("_hit", F.lit(""))),
        )
        .drop("_wanted", "_province", "_hit")
    )


def resolve_area(rows: DataFrame, areas: DataFrame, code: str) -> DataFrame:
    """Area by its code, else by ``other_code`` (first match, code replaced), else dropped.

    ``areas`` has position, code, other_code and the columns to attach. Both steps
    look the same dimension up, so one equi-join on a tagged key serves them:
    the direct hit is preferred over the other-code hit.
    """
    payload = F.struct("code", "area_code", "area_name", "other_code")
    direct = areas.select(F.col("code").alias("_code"), F.lit(0).alias("_step"), "position", payload.alias("area"))
    other = areas.select(F.col("other_code").alias("_code"), F.lit(1).alias("_step"), "position", payload.alias("area"))
    hits = first_match(direct.unionByName(other), "_code", ["area"], F.struct("_step", "position"))
    return (
        rows.join(hits, rows[code] == hits["_code"], "inner")
        .drop("_code")
        .withColumn(code, F.col("area.code"))
    )
