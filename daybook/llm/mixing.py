"""Mixing sources to target weights by systematic sampling.

Within a source every document is expected to be taken target / size times. The
documents stand in the order of their size, the expected copies are summed along
it from one random offset, and a document is emitted once for each integer the
sum crosses. The order keeps the words taken near the target, however unequal
the documents are. A source is summed in many blocks, never in one task.

Defined results: a null text has size 0; null is a source of its own and the
last one; null and repeated ids are rows like others; rows that are equal in id
and size are interchangeable; with no words at all every target is 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import WORD, numbered, unused, written

#: Weights of the sources in their order, repeating.
WEIGHTS = (1, 2, 3)
#: Copies of a document, and so the target of a source in its own sizes, at most.
MOST_COPIES = 3
#: Sizes are ordered by this many leading binary digits, a step of 1.6 %.
DIGITS = 7
#: Sub-blocks of the documents of one source and size step.
SPREAD = 16


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def fraction(value: Column) -> Column:
    """A number in [0, 1) that the text decides, in steps of 2^-32."""
    return F.conv(F.substring(F.md5(value), 1, 8), 16, 10).cast("double") / float(2**32)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """(source, source_size, n_docs, target) from (source, source_size, n_docs).

    All sizes are shared out by weight; a source whose share exceeds ``most`` times
    its size gets that, and the rest is shared out again until none exceeds.
    """
    ranked = numbered(sizes, ["source"], "_rank")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("_rank") - 1) % len(weights) + 1).cast("int"))
    ranked = written(
        ranked.withColumn("_weight", weight).withColumn("_bound", most * F.col("source_size")), "sources"
    )
    level = None
    while True:
        bounded = F.lit(False) if level is None else F.col("_bound") < F.col("_weight") * F.lit(level)
        row = ranked.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(bounded, F.col("_bound"))).alias("given"),
            F.sum(F.when(~bounded, F.col("_weight"))).alias("open"),
        ).first()
        if not row["open"]:
            break
        after = ((row["all"] or 0) - (row["given"] or 0)) / row["open"]
        if after == level:
            break
        level = after
    share = F.col("_weight") * F.lit(float(level or 0.0))
    return ranked.select("source", "source_size", "n_docs", F.least(F.col("_bound").cast("double"), share).alias("target"))


def with_copies(docs: DataFrame, seed: int = 0, weights: tuple[int, ...] = WEIGHTS) -> tuple[DataFrame, list[str]]:
    """``docs`` with columns for size, source_size, target and copies, whose names follow.

    ``docs`` is read twice and must give the same rows each time: a table, or what
    ``written`` returns.
    """
    size, total, target, copies, key, block, sub, start, n = (
        unused(docs, c)
        for c in ("size", "source_size", "target", "copies", "_key", "_block", "_sub", "_start", "_n")
    )
    name = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    cut = F.expr(f"greatest(0, length(bin(`{size}`)) - {DIGITS})")
    sized = (
        docs.withColumn(size, n_words(F.col("text")))
        # Never null, so that windows and joins deal rows alike and move them once.
        .withColumn(key, F.when(F.col("source").isNull(), "none").otherwise(F.concat(F.lit("="), F.col("source"))))
        .withColumn(block, F.call_function("shiftright", F.col(size), cut) * F.pow(F.lit(2), cut).cast("long"))
        .withColumn(sub, F.conv(F.substring(name, 1, 4), 16, 10).cast("int") % SPREAD)
    )
    blocks = written(
        sized.groupBy(key, block, sub)
        .agg(F.first("source").alias("source"), F.count(F.lit(1)).alias(n), F.sum(size).alias(total)),
        "blocks",
    )
    sources = targets(
        blocks.groupBy("source").agg(F.sum(total).alias("source_size"), F.sum(n).alias("n_docs")), weights
    )
    # The rows of a source here are its blocks: size steps by SPREAD, not documents.
    before = F.sum(n).over(Window.partitionBy(key).orderBy(block, sub)) - F.col(n)
    starts = (
        blocks.drop(total)
        .withColumn(start, before)
        .join(sources.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
        .select(key, block, sub, start, F.col("source_size").alias(total), F.col("target").alias(target))
    )
    within = Window.partitionBy(key, block, sub).orderBy(size, name, "doc_id")
    placed = sized.withColumn(n, F.row_number().over(within)).join(starts, [key, block, sub])
    rate = F.when(F.col(total) > 0, F.col(target) / F.col(total)).otherwise(F.lit(0.0))
    offset = fraction(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("source"), F.lit(""))))
    place = F.col(start) + F.col(n)
    crossed = F.floor(place * rate + offset) - F.floor((place - 1) * rate + offset)
    out = placed.withColumn(copies, crossed.cast("int"))
    kept = [F.col(f"`{c}`") for c in docs.columns]
    return out.select(*kept, size, total, target, copies), [size, total, target, copies]


def mix(docs: DataFrame, seed: int = 0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The mix: every row of ``docs`` as often as it is taken, with its own columns."""
    out, names = with_copies(docs, seed, weights)
    copies = names[-1]
    return (
        out.where(F.col(copies) > 0)
        .withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies))))
        .select([F.col(f"`{c}`") for c in docs.columns])
    )


def taken_words(docs: DataFrame, seed: int = 0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """doc_id, size, source_size, target and taken of every document."""
    out, _ = with_copies(_narrow(docs), seed, weights)
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", "text")
