"""A uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

Row p, column s of the matrix is how many rows of input partition p go to shard
s. It is drawn from the multivariate hypergeometric distribution, so that all
shuffles with these shard sizes are equally likely. Each partition deals its
labels out in a random order of its own, the rows are exchanged, and the rows of
a shard are put in the order of random numbers.

A shard is exchanged in blocks of its random order, so that no task holds a
whole shard. Draws depend on the seed and the partition only: a task that runs
again deals the same. That asks for the same rows in the same partitions, which
a scan of files gives; anything else is written to the shared folder first.

Defined results: nulls, empty texts and repeated rows are rows like others;
equal texts fall on shards independently of each other; shard sizes differ by
one at most, the first shards being the larger ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import unused, written

#: Rows of a block of a shard's random order, about.
BLOCK_ROWS = 10_000


def shard_sizes(rows: int, shards: int) -> np.ndarray:
    return np.full(shards, rows // shards) + (np.arange(shards) < rows % shards)


def communication_matrix(counts: np.ndarray, sizes: np.ndarray, seed: int) -> np.ndarray:
    """How many rows of each partition go to each shard; rows sum to counts, columns to sizes."""
    rng = np.random.default_rng([seed, 1])
    left = np.array(sizes, np.int64)
    out = np.zeros((len(counts), len(sizes)), np.int64)
    for p, n in enumerate(counts):
        # The marginals method: one shard after the other, as it also holds for very large counts.
        open_rows = int(left.sum())
        n = int(n)
        for s in range(len(sizes)):
            if not n:
                break
            rest = open_rows - int(left[s])
            out[p, s] = _hypergeometric(rng, int(left[s]), rest, n)
            open_rows, n = rest, n - int(out[p, s])
        left -= out[p]
    return out


def _hypergeometric(rng: np.random.Generator, good: int, other: int, n: int) -> int:
    """numpy's draw is bounded by 10^9 rows; beyond it the urn is drawn from in halves."""
    if good + other < 10**9:
        return int(rng.hypergeometric(good, other, n))
    if n == 0 or good == 0:
        return 0
    if other == 0:
        return n
    # Rows of one partition are few against the urn: the draws follow one another.
    taken = 0
    step = min(n, 1 << 20)
    while n:
        k = min(step, n)
        got = int(np.clip(rng.binomial(k, good / (good + other)), max(0, k - other), min(k, good)))
        taken, good, other, n = taken + got, good - got, other - (k - got), n - k
    return taken


def shuffled_shards(docs: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """``docs`` with shard (0 to shards - 1) and slot, its place in the shard from 0.

    ``docs`` is written first with the number of each row, by which it is counted and dealt:
    how the copy is split into tasks later does not matter. Columns called shard and slot
    give way.
    """
    docs = docs.drop("shard", "slot")
    key = unused(docs, "_row")
    whole = written(docs.withColumn(key, F.monotonically_increasing_id()), "rows")
    counted = whole.groupBy(F.shiftright(key, 33).alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    counts = {r["part"]: r["n"] for r in sorted(counted)}  # a row for each partition that was written
    sizes = shard_sizes(sum(counts.values()), shards)
    matrix = communication_matrix(np.array(list(counts.values()), np.int64), sizes, seed)
    share = docs.sparkSession.sparkContext.broadcast(dict(zip(counts, matrix, strict=True)))
    blocks = max(1, -(-int(sizes.max(initial=0)) // BLOCK_ROWS))

    extra = [unused(whole, c) for c in ("_shard", "_order")]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, labels, orders = None, None, None
        for batch in batches:
            ids = np.asarray(batch.column(batch.schema.get_field_index(key)))
            label, order = np.empty(len(ids), np.int32), np.empty(len(ids), np.int64)
            for p in np.unique(ids >> 33).tolist():
                if p != part:
                    rng = np.random.default_rng([seed, 2, p])
                    part, labels = p, rng.permutation(np.repeat(np.arange(shards, dtype=np.int32), share.value[p]))
                    orders = rng.integers(0, 2**62, len(labels))
                mine = ids >> 33 == p
                at = ids[mine] & ((1 << 33) - 1)
                label[mine], order[mine] = labels[at], orders[at]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(label), pa.array(order)], [*batch.schema.names, *extra])

    def dealt_out(rows: DataFrame) -> DataFrame:
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
        return rows.mapInArrow(deal, f"{fields}, {shard} int, {order} long")

    shard, order = extra
    place = key
    dealt = dealt_out(whole)
    block = unused(dealt, "_block")
    dealt = dealt.withColumn(block, _block_of(F.col(order), blocks))
    if blocks == 1:
        starts = None
    else:
        narrow = dealt_out(whole.select(key))  # no column of the rows is read here
        sums = narrow.groupBy(shard, _block_of(F.col(order), blocks).alias(block)).agg(F.count(F.lit(1)).alias("_n"))
        before = F.sum("_n").over(Window.partitionBy(shard).orderBy(block)) - F.col("_n")
        starts = sums.select(shard, block, before.alias("_start"))
    within = Window.partitionBy(shard, block).orderBy(order, place)
    out = dealt.withColumn(unused(dealt, "_slot"), F.row_number().over(within) - 1)
    slot = out.columns[-1]
    if starts is not None:
        out = out.join(starts, [shard, block]).withColumn(slot, F.col(slot) + F.col("_start"))
    kept = [F.col(f"`{c}`") for c in docs.columns]
    return out.select(*kept, F.col(shard).alias("shard"), F.col(slot).cast("long").alias("slot"))


def _block_of(order: Column, blocks: int) -> Column:
    return F.floor(order / F.lit(float(2**62)) * blocks).cast("int")


def crc32_of_text(text: Column) -> Column:
    """Of the UTF-8 bytes; of none for null."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def size_of_text(text: Column) -> Column:
    return (F.octet_length(F.coalesce(text, F.lit(""))) + 1).cast("long")
