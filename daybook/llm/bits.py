"""Bit tables of fixed size, to thin out a scan before anything is moved."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import unused

#: 64-bit words of a table: 128 kB, whatever the input. A full table lets all rows pass.
TABLE_WORDS = 1 << 14
TABLE_BITS = 64 * TABLE_WORDS


def _word(key: Column) -> Column:
    return F.shiftright(F.pmod(key, F.lit(TABLE_BITS)), 6).cast("int")


def _bit(key: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(key, F.lit(64)).cast("int"))


def table_of(keys: DataFrame, key: str) -> Column:
    """A constant with a bit for each slot that a 64-bit ``key`` falls on."""
    found = keys.where(F.col(key).isNotNull()).groupBy(_word(F.col(key)).alias("at")).agg(F.bit_or(_bit(F.col(key))).alias("bits"))
    words = [0] * TABLE_WORDS
    for row in found.collect():  # a row for each word of the table at most
        words[row["at"]] = row["bits"]
    return F.split(F.lit(",".join(map(str, words))), ",").cast("array<bigint>")


def may_hold(table: Column, key: Column) -> Column:
    """False only if no key of the table equals ``key``."""
    return F.coalesce(F.get(table, _word(key)).bitwiseAND(_bit(key)) != 0, F.lit(False))


#: 64-bit words of a table that travels as a row: 2 MB, whatever the input.
ROW_WORDS = 1 << 18


def thinned(rows: DataFrame, key: Column, wanted: DataFrame, name: str) -> DataFrame:
    """The ``rows`` whose ``key`` is a value of the column ``name`` of ``wanted``, and a few others.

    The table is too large for a constant of a plan; it is one row that is broadcast.
    """
    def word(value: Column) -> Column:
        return F.shiftright(F.pmod(value, F.lit(64 * ROW_WORDS)), 6)

    found = wanted.where(F.col(name).isNotNull()).groupBy(word(F.col(name)).alias("at")).agg(F.bit_or(_bit(F.col(name))).alias("bits"))
    words = rows.sparkSession.range(ROW_WORDS).select(F.col("id").alias("at")).join(found, "at", "left")
    words = words.agg(F.array_sort(F.collect_list(F.struct("at", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")))).alias("words"))
    table = unused(rows, "_table")
    one = words.select(F.transform("words", lambda w: w["bits"]).alias(table))
    hit = F.get(F.col(table), word(key).cast("int")).bitwiseAND(_bit(key)) != 0
    return rows.crossJoin(F.broadcast(one)).where(hit).drop(table)


def without(docs: DataFrame, key: Column, unwanted: DataFrame, name: str) -> DataFrame:
    """The rows of ``docs`` whose ``key`` is no value of the column ``name`` of ``unwanted``.

    Rows that the table clears stay where they are; the others are looked up.
    ``unwanted`` is read twice.
    """
    maybe = may_hold(table_of(unwanted, name), key)
    kept = unwanted.select(name).distinct()
    looked_up = docs.where(maybe).join(kept, key == kept[name], "left_anti")
    return docs.where(~maybe).unionByName(looked_up)
