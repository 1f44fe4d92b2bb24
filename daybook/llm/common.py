"""Helpers that several operators of this package share."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.session import remove_path, work_folder

#: What separates words, as a character class without its brackets.
WHITE = r"\x20\x09-\x0D"
WORD = f"[^{WHITE}]+"


#: Where the paths of what is written are noted.
_NOTED: ContextVar[list[str] | None] = ContextVar("noted", default=None)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below ``spark.checkpoint.dir`` and read again.

    Cuts the lineage with a copy that outlives any executor; a plan that reads
    it more than once sees the same rows in the same files.
    """
    spark = df.sparkSession
    path = work_folder(spark, name)
    if _NOTED.get() is not None:
        _NOTED.get().append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def noted(paths: list[str]) -> Iterator[None]:
    """Add the paths of all that is ``written`` meanwhile to a list."""
    before = _NOTED.set(paths)
    try:
        yield
    finally:
        _NOTED.reset(before)


def release(paths: list[str], *kept: DataFrame) -> None:
    """Remove what was written to ``paths`` but for what any of ``kept`` is read from, and forget it."""
    folders = {path: os.path.dirname(path) for path in paths}
    files = [file for df in kept for file in df.inputFiles()] if folders else []
    used = {path for path, folder in folders.items() if any(os.path.basename(folder) in file for file in files)}
    for path in set(paths) - used:
        remove_path(kept[0].sparkSession, folders[path], os.path.dirname(folders[path]))
    paths[:] = sorted(used)


def unused(df: DataFrame | Iterable[str], name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in (df.columns if isinstance(df, DataFrame) else df)}
    while name.lower() in taken:
        name = "_" + name
    return name


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{WHITE}]+"), lambda w: w != "")


def bind(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with its 1-based position in ``order`` as column ``name``.

    Range partitions are sorted one by one and shifted by the rows before them,
    so that no task sees all rows.
    """
    part = unused(df, "_part")
    split = written(
        df.repartitionByRange(*[F.col(c).asc_nulls_last() for c in order]).withColumn(
            part, F.spark_partition_id()
        ),
        "ranges",
    )
    before = "_before"
    sizes = split.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))
    starts = sizes.select(
        part,
        # One row for each partition, not for each row of the data.
        (F.sum("_n").over(Window.orderBy(part)) - F.col("_n")).alias(before),
    )
    place = F.row_number().over(
        Window.partitionBy(part).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    )
    return (
        split.join(starts, part)
        .withColumn(name, place + F.col(before))
        .drop(part, before)
    )


def no_rows(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)
