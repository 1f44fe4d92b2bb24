"""Locality snapshot: wards with the area their province belongs to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.aliases import fold_aliases
from daybook.operators.lookups import resolve_area
from daybook.plans.labels import Labels
from daybook.plans.run import Run
from daybook.sources.archives import append_manifest, latest_path, read_manifest, recorded
from daybook.sources.parquet import typed

# Fixed value: code of the area that stands for the whole country.
WHOLE_COUNTRY = "00"


def ward_schema(labels: Labels) -> str:
    # Field names of the ward documents.
    return (
        "ProvinceId int, ProvinceName string, ProvinceCode string, DistrictId int, DistrictName string, "
        f"{labels.district_field} int, WardId int, WardName string, {labels.ward_field} int, CoTuyenThu boolean"
    )


def snapshot_schema(labels: Labels) -> str:
    # Columns of the snapshot.
    return (
        "area_local_code string, area_local_name string, province_id int, province_name string, "
        "province_code string, province_other_code string, district_id int, district_name string, "
        f"{labels.district_column} int, ward_id int, ward_name string, {labels.ward_column} int, "
        "co_tuyen_thu boolean"
    )


def explode_areas(areas: DataFrame) -> DataFrame:
    """One row per locality of an area, in document order; the whole-country entry is left out."""
    return (
        areas.filter(F.coalesce(F.col("code") != WHOLE_COUNTRY, F.lit(True)))
        .select(
            F.coalesce("code", F.lit("")).alias("area_code"),
            F.coalesce("name", F.lit("")).alias("area_name"),
            F.posexplode("localities").alias("item", "locality"),
        )
        .select(
            F.struct("area_code", "item").alias("position"),
            F.coalesce("locality.code", F.lit("")).alias("code"),
            F.coalesce("locality.name", F.lit("")).alias("name"),
            F.coalesce("locality.otherCode", F.lit("")).alias("other_code"),
            "area_code",
            "area_name",
        )
    )


def locality_snapshot(wards: DataFrame, areas: DataFrame, labels: Labels) -> DataFrame:
    representatives = fold_aliases(explode_areas(areas))
    resolved = resolve_area(
        wards.withColumn("province_code", F.coalesce("ProvinceCode", F.lit(""))), representatives, "province_code"
    )
    snapshot = resolved.select(
        F.col("area.area_code").alias("area_local_code"),
        F.col("area.area_name").alias("area_local_name"),
        F.col("ProvinceId").alias("province_id"),
        F.coalesce("ProvinceName", F.lit("")).alias("province_name"),
        "province_code",
        F.col("area.other_code").alias("province_other_code"),
        F.col("DistrictId").alias("district_id"),
        F.coalesce("DistrictName", F.lit("")).alias("district_name"),
        F.col(labels.district_field).alias(labels.district_column),
        F.col("WardId").alias("ward_id"),
        F.coalesce("WardName", F.lit("")).alias("ward_name"),
        F.col(labels.ward_field).alias(labels.ward_column),
        F.coalesce("CoTuyenThu", F.lit(False)).alias("co_tuyen_thu"),
    )
    return typed(snapshot, snapshot_schema(labels))


def publish_localities(
    spark: SparkSession, root: str, wards: DataFrame, areas: DataFrame, run: Run, labels: Labels
) -> str:
    """Write a snapshot and its manifest row; returns the path.

    A path without a manifest row is what a failed run left behind, and is written
    anew; a recorded one is kept.
    """
    stamp, at = f"{run.time:%Y%m%d%H%M%S}", f"{run.time:%Y-%m-%d %H:%M:%S.%f}"
    path = f"{root}/locality/locality_{stamp}.parquet"
    if recorded(spark, f"{root}/manifest", path):
        return path
    locality_snapshot(wards, areas, labels).write.mode("overwrite").parquet(path)
    count = spark.read.parquet(path).count()
    append_manifest(
        spark, f"{root}/manifest", [(stamp, at, at, "Locality", path, "Update data by request", count)]
    )
    return path


def read_localities(spark: SparkSession, root: str, labels: Labels) -> DataFrame:
    """The newest snapshot."""
    path = latest_path(read_manifest(spark, f"{root}/manifest"), "Locality")
    if path is None:
        raise FileNotFoundError("no locality snapshot in the manifest")
    return spark.read.schema(snapshot_schema(labels)).parquet(path)
