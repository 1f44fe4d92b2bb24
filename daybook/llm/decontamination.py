"""Benchmark items in documents: SimHash windows, a multi-index, exact verification.

A window of a document is as many shingles long as an item. Windows and items
are reduced to 64-bit SimHash fingerprints and meet if these differ in at most
``RADIUS`` bits. Fingerprints are cut into ``BLOCKS`` blocks; within the radius
some block differs in at most ``BLOCK_RADIUS`` bits, and items are indexed under
all values that near, so that no pair within the radius is missed. Candidates
are verified by the exact weighted Jaccard similarity of their shingles, with
their numbers of occurrences as weights.

Windows are looked at where they can matter only: one that holds too few of an
item's shingles cannot reach the threshold, and of the others those that begin
with such a shingle are enough, as moving a window on to the next one loses none.

Defined results: words are compared in lower case; an item of fewer than
``WIDTH`` words is one shingle of all of them; null and empty items and texts
match nothing; a text shorter than an item is one window; of several best
windows the first is told; repeated documents and items each get their rows.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.bits import may_hold, table_of, without
from daybook.llm.common import bind, words, written

WIDTH, PERCENT = 5, 80
BITS, BLOCKS, BLOCK_RADIUS = 64, 8, 2
#: Largest distance at which no pair can be missed: some block of eight differs in two bits at most.
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
_BLOCK_BITS = BITS // BLOCKS
_NEAR = [sum(1 << b for b in c) for k in range(BLOCK_RADIUS + 1) for c in combinations(range(_BLOCK_BITS), k)]


def shingles(text: Column, width: int) -> Column:
    """64-bit hashes of all runs of ``width`` words in lower case, in order."""
    runs = lambda w: F.when(
        F.size(w) >= width,
        F.transform(F.sequence(F.lit(0), F.size(w) - width), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)])),
    ).otherwise(F.array().cast("array<bigint>"))
    return bind(words(F.lower(text)), runs)


def simhash(hashes: Column) -> Column:
    """Each bit is what the majority of the hashes, counted as often as they occur, has there."""
    ones = lambda b: F.aggregate(
        hashes,
        F.lit(0),
        lambda n, h: n + F.call_function("shiftrightunsigned", h, b).bitwiseAND(F.lit(1).cast("long")).cast("int"),
    )
    bit = lambda b: F.when(2 * ones(b) > F.size(hashes), F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(BITS - 1)),
        F.lit(0).cast("long"),
        lambda acc, b: acc.bitwiseOR(F.call_function("shiftleft", bit(b), b)),
    )


def common_weight(a: Column, b: Column) -> Column:
    """Sum of the smaller numbers of occurrences of each hash."""
    times = lambda x, h: F.size(F.filter(x, lambda y: y == h))
    return F.aggregate(
        F.array_distinct(F.array_intersect(a, b)), F.lit(0), lambda n, h: n + F.least(times(a, h), times(b, h))
    )


def _blocks(fingerprint: Column) -> list[Column]:
    return [
        F.shiftrightunsigned(fingerprint, _BLOCK_BITS * k).bitwiseAND(F.lit((1 << _BLOCK_BITS) - 1).cast("long")).cast("int")
        for k in range(BLOCKS)
    ]


def _items(benchmark: DataFrame) -> DataFrame:
    """(item, width, n, grams, print) of the distinct items that have words."""
    split = benchmark.select("text").distinct().withColumn("w", words(F.lower("text"))).where(F.size("w") > 0)
    width = F.least(F.size("w"), F.lit(WIDTH))
    grams = F.coalesce(*[F.when(width == k, shingles(F.col("text"), k)) for k in range(1, WIDTH + 1)])
    items = split.select(F.col("text").alias("item"), width.alias("width"), grams.alias("grams"))
    return items.withColumn("n", F.size("grams")).withColumn("print", simhash(F.col("grams")))


def _needed(n: Column) -> Column:
    return F.ceil(n * PERCENT / 100).cast("int")


def text_key(text: Column) -> Column:
    return F.xxhash64(text)


def found_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(text_key, item, start, similarity) of every text of ``docs`` and item alike enough.

    start counts words from 0 and is that of the best window, the first of several.
    """
    items = written(_items(benchmark), "items")
    parts = [
        _found_of_width(docs, items.where(F.col("width") == row["width"]), row["width"])
        for row in items.select("width").distinct().orderBy("width").collect()  # WIDTH rows at most
    ]
    if not parts:
        return docs.sparkSession.createDataFrame([], "text_key long, item string, start int, similarity double")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _found_of_width(docs: DataFrame, items: DataFrame, width: int) -> DataFrame:
    gram_items = items.select("item", "n", F.posexplode("grams").alias("place", "gram"))
    table = table_of(gram_items, "gram")
    least = items.agg(F.min(_needed(F.col("n")))).first()[0]

    hits = F.filter(F.col("grams"), lambda h: may_hold(table, h))
    scanned = docs.select(text_key(F.col("text")).alias("text_key"), shingles(F.col("text"), width).alias("grams"))
    hit_texts = scanned.withColumn("hits", hits).where(F.size("hits") >= least).drop("hits")
    # Copies of a text are one text from here on.
    texts = written(hit_texts.groupBy("text_key").agg(F.first("grams").alias("grams")), "texts")

    places = texts.select("text_key", F.size("grams").alias("length"), F.posexplode("grams").alias("place", "gram"))
    met = (
        places.join(gram_items.select("item", "n", "gram").distinct(), "gram")
        .groupBy("text_key", "item", "n", "length")
        .agg(F.array_sort(F.collect_list("place")).alias("places"))
        .where(F.size("places") >= _needed(F.col("n")))
    )
    # A window that begins with the k-th of the item's shingles holds enough of them
    # if the one needed places on still lies within it.
    starts = F.filter(
        F.col("places"), lambda p, k: F.get(F.col("places"), k + _needed(F.col("n")) - 1) <= p + F.col("n") - 1
    )
    last = F.greatest(F.lit(0), F.col("length") - F.col("n"))
    windows = met.select(
        "text_key", "n", F.explode(F.array_distinct(F.transform(starts, lambda s: F.least(s, last)))).alias("start")
    ).distinct()
    sliced = windows.join(texts, "text_key").select(
        "text_key", "n", "start", F.slice("grams", F.col("start") + 1, F.col("n")).alias("window")
    )
    sliced = written(sliced.withColumn("window_key", F.xxhash64("window")), "windows")

    # Equal windows are fingerprinted, looked up and verified once.
    distinct = sliced.groupBy("window_key", "n").agg(F.first("window").alias("window"))
    marked = written(distinct.withColumn("print", simhash(F.col("window"))), "fingerprints")
    index = items.select(
        "item", "n", F.col("grams").alias("item_grams"), F.col("print").alias("item_print"),
        F.posexplode(F.array(*_blocks(F.col("print")))).alias("block", "value"),
    ).withColumn("value", F.explode(F.transform(F.array(*[F.lit(x) for x in _NEAR]), lambda x: x.bitwiseXOR(F.col("value")))))
    probes = marked.select("window_key", "n", "print", F.posexplode(F.array(*_blocks(F.col("print")))).alias("block", "value"))
    near = (
        probes.join(index.select("item", "n", "item_print", "block", "value"), ["n", "block", "value"])
        .where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS)
        .select("window_key", "n", "item")
        .distinct()
    )
    both = common_weight(F.col("window"), F.col("grams"))
    alike = (
        near.join(marked, ["window_key", "n"])
        .join(items.select("item", "grams"), "item")
        .withColumn("both", both)
        .withColumn("all", F.size("window") + F.size("grams") - F.col("both"))
        .where(100 * F.col("both") >= PERCENT * F.col("all"))
        .select("window_key", "n", "item", (F.col("both") / F.col("all")).alias("similarity"))
    )
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"))).alias("best")
    return (
        sliced.select("text_key", "n", "start", "window_key")
        .join(alike, ["window_key", "n"])
        .groupBy("text_key", "item")
        .agg(best)
        .select("text_key", "item", (-F.col("best.back")).alias("start"), F.col("best.similarity").alias("similarity"))
    )


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, start, similarity) for every document that holds a benchmark item."""
    found = written(found_items(docs, benchmark), "found")
    keyed = docs.select("doc_id", text_key(F.col("text")).alias("text_key"))
    named = benchmark.select("item_id", F.col("text").alias("item"))
    return keyed.join(found, "text_key").join(named, "item").select("doc_id", "item_id", "start", "similarity")


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item."""
    found = written(found_items(docs, benchmark).select("text_key").distinct(), "found")
    return without(docs, text_key(F.col("text")), found, "text_key")
