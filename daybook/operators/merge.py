"""Keyed merges: a batch against a target, set-based on ``row_key``.

A keyed table has one row per ``row_key`` and one struct per column family. A
null struct is a family the row does not have; inside it a null is an absent
cell and ``''`` a blank one. A ``period`` column, where there is one, is kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from daybook.functions.cells import struct_of

KEY = "row_key"
# Where a stored row lies: the month it was born in. It is set by the insert and kept.
PERIOD = "period"
# As many copies of a key may meet in a task; of a key with more, rows that one task reads in turn are collapsed first.
CHUNK = 65_536


def _join_batch(target: DataFrame, batch: DataFrame, columns: list[str]) -> DataFrame:
    """Full outer join; the batch's columns are SQL texts, a period both sides have is settled."""
    if PERIOD not in target.columns:
        return target.join(batch.selectExpr(KEY, *columns), KEY, "full_outer")
    joined = target.join(batch.selectExpr(KEY, *columns, f"{PERIOD} as new_period"), KEY, "full_outer")
    return joined.withColumn(PERIOD, F.coalesce(PERIOD, "new_period"))


def latest_per_key(batch: DataFrame, newest: Sequence[str], key: str = KEY) -> DataFrame:
    """One row per key: the greatest ``newest`` columns, ties broken by all others.

    Whole rows are shuffled once, by key. Rows of keys with very many copies are collapsed
    before that, so that no task ever holds all rows of a hot key; a first job, which reads
    the keys only, finds these.
    """
    rest = [c for c in batch.columns if c != key and c not in newest]
    best = F.max(F.struct(*newest, *rest)).alias("best")

    def collapsed(rows: DataFrame, *dealt: str | Column) -> DataFrame:
        whole = rows.repartition(key, *dealt).groupBy(key).agg(best)
        return whole.select(*[F.col(c) if c == key else F.col("best")[c].alias(c) for c in batch.columns])

    place, crowded = F.pmod(F.xxhash64(key), F.lit(PLACES)), crowded_places(batch, key)
    if crowded:
        is_crowded = F.coalesce(place.isin(crowded), F.lit(False))
        chunk = F.floor(F.monotonically_increasing_id() / CHUNK)
        batch = batch.filter(~is_crowded).unionByName(collapsed(batch.filter(is_crowded), chunk))
    return collapsed(batch)


# Keys are counted by their hash, in this many places; of the crowded ones only the largest are told,
# so that the others hold a small share of the rows however many there are.
PLACES, CROWDED = 262_144, 1024


def crowded_places(batch: DataFrame, key: str) -> list[int]:
    """Places of the keys that have more than ``CHUNK`` rows."""
    counts = batch.groupBy(F.pmod(F.xxhash64(key), F.lit(PLACES)).alias("place")).count()
    largest = counts.filter(F.col("count") > CHUNK).orderBy(F.col("count").desc(), "place").limit(CROWDED)
    return [row["place"] for row in largest.collect()]


def changed(old: str, new: str, is_text: bool = True, fill_absent: bool = False) -> str:
    """Patch test: the old cell is neither absent nor blank and differs from the new one.

    With ``fill_absent`` an absent cell counts as different too; a blank one never does.
    """
    tests = [f"not ({old} <=> {new})"]
    if is_text:
        tests.append(f"not ({old} <=> '')")
    if not fill_absent:
        tests.append(f"{old} is not null")
    return " and ".join(tests)


def insert_or_patch(
    target: DataFrame,
    batch: DataFrame,
    family: str,
    patch: Sequence[str],
    fill: Sequence[str] = (),
    companions: Sequence[str] = (),
    history: tuple[str, str, str] | None = None,
) -> DataFrame:
    """Insert rows whose ``family`` is absent, else patch only the changed ``patch`` columns.

    ``fill`` names patch columns that are also filled when absent. ``companions``
    are families inserted together with ``family`` and never patched. ``history``
    is (map family, column, ISO date): the column's value is logged under the date
    on insert and on change. One full outer join on the key; both sides hold a key
    once, so the key cannot be skewed, and a bucketed target is not shuffled.
    """
    incoming = [f"{f} as new_{f}" for f in (family, *companions)]
    types = batch.schema[family].dataType
    old, new = family, f"new_{family}"
    test = {
        c: changed(f"{old}.`{c}`", f"{new}.`{c}`", isinstance(types[c].dataType, StringType), c in fill)
        for c in patch
    }
    patched = struct_of(
        {c: f"if({test[c]}, {new}.`{c}`, {old}.`{c}`)" if c in test else f"{old}.`{c}`" for c in types.names}
    )
    inserted = f"{old} is null and {new} is not null"
    result = {family: f"case when {new} is null then {old} when {old} is null then {new} else {patched} end"}
    for f in companions:
        result[f] = f"if({inserted}, new_{f}, {f})"
    if history:
        log, column, day = history
        entry = f"map(date'{day}', {new}.`{column}`)"
        logged = f"map_concat(map_filter({log}, (day, _) -> day <> date'{day}'), {entry})"
        result[log] = (
            f"case when {inserted} then {entry} "
            f"when {new} is not null and {test[column]} then coalesce({logged}, {entry}) else {log} end"
        )
    return _join_batch(target, batch, incoming).selectExpr(
        KEY, *[f"{result.get(c, c)} as {c}" for c in target.columns if c != KEY]
    )


def replace_rows(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Whole-row put: rows of the batch replace those of the same key, in all columns the batch has.

    A full outer join rather than an anti join and a union, which would compute
    the batch twice.
    """
    put = [c for c in target.columns if c not in (KEY, PERIOD) and c in batch.columns]
    result = {c: f"if(new_row is not null, new_row.`{c}`, `{c}`)" for c in put}
    incoming = [f"{struct_of({c: c for c in put})} as new_row"]
    return _join_batch(target, batch, incoming).selectExpr(
        KEY, *[f"{result.get(c, c)} as `{c}`" for c in target.columns if c != KEY]
    )


def put_columns(target: DataFrame, batch: DataFrame, family: str) -> DataFrame:
    """Put some columns of a family under a key another source shares.

    Rows only one side knows are kept; columns the batch lacks stay as they are.
    """
    given = set(batch.schema[family].dataType.names)
    cells = {
        c: f"if(new_cells is not null, new_cells.`{c}`, {family}.`{c}`)" if c in given else f"{family}.`{c}`"
        for c in target.schema[family].dataType.names
    }
    merged = f"if({family} is null and new_cells is null, null, {struct_of(cells)})"
    return _join_batch(target, batch, [f"{family} as new_cells"]).selectExpr(
        KEY, *[f"{merged if c == family else c} as {c}" for c in target.columns if c != KEY]
    )


def daily_status(changes: DataFrame, key: str, day: Column, status: str, order: Sequence[str]) -> DataFrame:
    """Long status history: the last status of each key and day."""
    return (
        changes.groupBy(F.col(key), day.alias("log_date"))
        .agg(F.max(F.struct(*order, status)).alias("last"))
        .select(key, "log_date", F.col(f"last.{status}").alias("status"))
    )
