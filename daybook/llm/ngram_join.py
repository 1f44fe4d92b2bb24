"""Set-similarity self-join on word n-grams by prefixes and tries.

Every text becomes the sorted array of its distinct n-grams under one global
order, frequent ones last. Texts of a Jaccard similarity at or above the
threshold share an n-gram among their first ``|set| - required + 1`` ones, so
only sets that meet under such an n-gram are compared. They are compared in
tries: sets that begin alike share the overlap of what they share, and a
subtree is left as soon as the lengths that remain cannot reach the required
overlap.

Only groups are asked for, so a meeting place of m sets gives pairs with its most
central set and with the next one first; after these are joined, pairs within a
group are settled and only pairs between different groups are compared, with no
cap on either. Before two sets are compared, parity bits of both bound how many
n-grams only one of them has; no similar pair exceeds the bound.

Defined results: equal sets are one set (compared once), nulls, empty texts and
texts without words have the empty set and stay alone, repeated and null ids
are rows like others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.bits import without
from daybook.llm.common import noted, release, unused, written
from daybook.llm.components import components
from daybook.llm.shingles import mixed, shingle_hashes

#: n-grams are 58-bit hashes; the five bits above them hold the frequency class.
GRAM_BITS = 58
#: Slots of the table of frequency classes, one byte each: its size never grows.
SLOTS = 1 << 21
#: Slots of the bit tables that thin out a scan; 2 MB, whatever the input.
BIT_SLOTS = 1 << 24
#: n-grams seen less often than this keep class 0.
FREQUENT = 8
#: Prefixes are taken anew while an n-gram of class 0 stands in more of them than this.
CROWDED = 512
#: Sets in a trie.
TRIE = 256
#: 64-bit words of parity that are at hand wherever sets meet.
WORDS = 4


def needed(size_a: int, size_b: int, percent: int) -> int:
    """The least overlap with which 100 * overlap >= percent * union."""
    return -(-percent * (size_a + size_b) // (100 + percent))


def prefix_length(size: int, percent: int) -> int:
    """How many first n-grams must meet one of any set that is similar enough."""
    return size - -(-percent * size // 100) + 1 if size else 0


def _distinct_grams(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    for hashes in shingle_hashes(texts, width):
        yield np.unique(hashes >> np.uint64(64 - GRAM_BITS))


def _ordered(grams: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The set under the global order: by frequency class, then by hash."""
    kind = classes[(grams & np.uint64(SLOTS - 1)).astype(np.int64)].astype(np.uint64)
    return np.sort(grams | (kind << np.uint64(GRAM_BITS))).astype(np.int64)


def _fingerprint(grams: np.ndarray) -> int:
    """The same for equal sets; 62 bits, and the size is compared as well."""
    return int(mixed(np.array([mixed(grams ^ np.uint64(0x5DEECE66D)).sum(dtype=np.uint64)]))[0] >> np.uint64(2))


def parity(grams: np.ndarray) -> np.ndarray:
    """Whether an odd number of n-grams falls on each of at least two slots an n-gram, in 64-bit words.

    Two sets of equally many words differ in at most as many slots as there are
    n-grams that only one of them has. Words are a power of two, ``WORDS`` at
    least; half as many are the exclusive or of both halves.
    """
    words = WORDS
    while 64 * words < 2 * len(grams):
        words *= 2
    odd = np.bincount((grams & np.uint64(64 * words - 1)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _frequency_classes(texts: DataFrame, width: int) -> np.ndarray:
    """One byte per slot: the binary logarithm of how many texts hold an n-gram of it.

    Counted are n-grams that several texts of one batch share. Any table gives
    right results; a good one keeps frequent n-grams out of prefixes.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(_distinct_grams(batch.column(0), width))
            grams, n = np.unique(np.concatenate([np.empty(0, np.uint64), *sets]), return_counts=True)
            keep = n > 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams[keep].astype(np.int64)), pa.array(n[keep].astype(np.int64))], ["gram", "n"]
            )

    counted = texts.mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return _raised(np.zeros(SLOTS, np.uint8), counted.where(F.col("n") >= FREQUENT))


def _raised(classes: np.ndarray, counted: DataFrame) -> np.ndarray:
    """``classes`` raised to the counts of (gram, n)."""
    out = classes.copy()
    slots = counted.groupBy(F.col("gram").bitwiseAND(SLOTS - 1).cast("int").alias("slot")).agg(F.max("n").alias("n"))
    for row in slots.select("slot", F.floor(F.log2("n")).cast("int").alias("k")).toLocalIterator():
        out[row["slot"]] = max(out[row["slot"]], min(row["k"], 31))
    return out


def _bit_table(keys: DataFrame, key: str) -> np.ndarray:
    """A bit for every slot that a value of ``key`` falls on; its size is fixed."""
    slot = F.pmod(F.col(key), F.lit(BIT_SLOTS))
    found = keys.groupBy(F.floor(slot / 32).cast("int").alias("at")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, int(pmod({key}, 32)))")).alias("bits")
    )
    out = np.zeros(BIT_SLOTS // 32, np.uint32)
    for row in found.toLocalIterator():
        out[row["at"]] = row["bits"]
    return out


def _in_table(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slot = (keys & np.int64(BIT_SLOTS - 1)).astype(np.int64)
    return (bits[slot >> 5] >> (slot & 31).astype(np.uint32) & 1).astype(bool)


def _prefixes(texts: DataFrame, classes: np.ndarray, width: int, percent: int) -> DataFrame:
    """Of every row its set's size, fingerprint and parity, and the prefix of the ordered set."""
    shared = texts.sparkSession.sparkContext.broadcast(classes)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, prints, bits, firsts = [], [], [], []
            for grams in _distinct_grams(batch.column(0), width):
                sizes.append(len(grams))
                prints.append(_fingerprint(grams) if len(grams) else None)
                bits.append(parity(grams) if len(grams) else np.empty(0, np.int64))
                firsts.append(_ordered(grams, shared.value)[: prefix_length(len(grams), percent)])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(sizes, pa.int64()), pa.array(prints, pa.int64()), _lists(bits), _lists(firsts)],
                [*batch.schema.names[1:], "n_shingles", "set_id", "parity", "prefix"],
            )

    rest = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema.fields[1:])
    return texts.mapInArrow(read, f"{rest}, n_shingles long, set_id long, parity array<long>, prefix array<long>")


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int64()))


def _shared_grams(rows: DataFrame) -> DataFrame:
    """(gram, n) of the n-grams that stand in the prefixes of several sets."""
    return (
        rows.select("set_id", F.explode("prefix").alias("gram"))
        .groupBy("gram")
        .agg(F.min("set_id").alias("least"), F.max("set_id").alias("most"), F.count(F.lit(1)).alias("n"))
        .where("least < most")
        .select("gram", "n")
    )


def _meetings(rows: DataFrame, shared: DataFrame) -> DataFrame:
    """(gram, set_id, row_key, n_shingles, reach, n): which sets meet where, each once.

    reach is how many n-grams the set has from this one on; row_key names one row
    that has the set.
    """
    table = rows.sparkSession.sparkContext.broadcast(_bit_table(shared, "gram"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.asarray(batch.column(3).offsets)
            flat = np.asarray(batch.column(3).values)[ends[0] : ends[-1]]
            lengths = np.diff(ends)
            keep = _in_table(table.value, flat)
            owner, key, size = (np.repeat(np.asarray(batch.column(i).fill_null(0)), lengths) for i in range(3))
            reach = size - (np.arange(len(flat)) - np.repeat(ends[:-1] - ends[0], lengths))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[keep]) for x in (flat, owner, key, size, reach)],
                ["gram", "set_id", "row_key", "n_shingles", "reach"],
            )

    entries = rows.select("set_id", "row_key", "n_shingles", "prefix").mapInArrow(
        read, "gram long, set_id long, row_key long, n_shingles long, reach long"
    )
    # Of rows with equal sets one stands for all.
    return (
        entries.groupBy("gram", "set_id", "n_shingles", "reach")
        .agg(F.min("row_key").alias("row_key"))
        .join(shared, "gram")
    )


#: Rows whose sets are made and handed on together.
SET_ROWS = 500


def _sets(texts: DataFrame, wanted: DataFrame, classes: np.ndarray, width: int) -> DataFrame:
    """(set_id, row_key, grams) of the rows of ``wanted``, and of some others.

    The scan filters by a bit table of fixed size before anything is moved; what
    its collisions let through finds no partner when it is joined.
    """
    shared = texts.sparkSession.sparkContext.broadcast((classes, _bit_table(wanted, "row_key")))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (batch.slice(at, SET_ROWS) for batch in batches for at in range(0, batch.num_rows, SET_ROWS))
        for batch in parts:
            table, bits = shared.value
            keys = np.asarray(batch.column(1))
            chosen = _in_table(bits, keys)
            sets = list(_distinct_grams(batch.column(0).filter(pa.array(chosen)), width))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_fingerprint(x) for x in sets], pa.int64()),
                    pa.array(keys[chosen]),
                    _lists([_ordered(x, table) for x in sets]),
                ],
                ["set_id", "row_key", "grams"],
            )

    return written(texts.mapInArrow(read, "set_id long, row_key long, grams array<long>"), "sets")


def similar_in_trie(probe: np.ndarray, sets: list[np.ndarray], percent: int) -> list[bool]:
    """Which of ``sets``, given in lexicographic order, are similar enough to ``probe``.

    In this order sets that follow each other share their path from the root of
    the trie: ``path[d]`` is the overlap of the first d n-grams of the current
    path, and is kept for as much as the next set shares.
    """
    out, path, last = [], np.zeros(1, np.int64), np.empty(0, np.int64)
    for grams in sets:
        most = min(len(last), len(grams))
        differ = np.flatnonzero(last[:most] != grams[:most])
        depth = min(int(differ[0]) if len(differ) else most, len(path) - 1)
        want = needed(len(probe), len(grams), percent)
        used = int(np.searchsorted(probe, grams[depth - 1], "right")) if depth else 0
        if path[depth] + min(len(grams) - depth, len(probe) - used) < want:
            last, path = grams[:depth], path[: depth + 1]  # the subtree is left here
            out.append(False)
            continue
        tail = grams[depth:]
        at = np.searchsorted(probe, tail)
        met = probe[np.minimum(at, len(probe) - 1)] == tail
        path = np.concatenate([path[: depth + 1], path[depth] + np.cumsum(met)])
        last = grams
        out.append(bool(path[-1] >= want))
    return out


def _links(pairs: DataFrame, texts: DataFrame, classes: np.ndarray, width: int, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose sets are similar enough.

    The sets compared with one set form tries of about ``TRIE`` sets, dealt out
    one by one, so that a set with very many partners is no single task.
    """
    wanted = pairs.select(F.explode(F.array("key_a", "key_b")).alias("row_key")).distinct()
    sizes = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / TRIE).alias("tries"))
    scratch: list[str] = []
    with noted(scratch):
        sets = _sets(texts.select("text", "row_key"), wanted, classes, width)
        dealt = written(
            pairs.join(sizes, "a").select("a", "key_a", "b", "key_b", F.pmod(F.xxhash64("b"), F.col("tries")).alias("trie")),
            "pairs",
        )
    # Sets grow with the input: they are met by moving both sides, never by copying one.
    own = sets.hint("merge")
    members = dealt.join(own, (F.col("b") == F.col("set_id")) & (F.col("key_b") == F.col("row_key")))
    members = members.select("a", "trie", "b", "grams")
    heads = dealt.groupBy("a", "trie").agg(F.min("key_a").alias("key_a"))
    heads = heads.join(own, (F.col("a") == F.col("set_id")) & (F.col("key_a") == F.col("row_key")))
    heads = heads.select("a", "trie", F.col("a").alias("b"), "grams")
    grouped = (
        members.withColumn("head", F.lit(0))
        .unionByName(heads.withColumn("head", F.lit(1)))
        .repartition("a", "trie")
        .sortWithinPartitions("a", "trie", F.desc("head"))
        .select("a", "trie", "b", "head", "grams")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, probe, names, sets = None, None, [], []

        def done() -> pa.RecordBatch:
            order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">i8").tobytes())
            same = similar_in_trie(probe, [sets[i] for i in order], percent)
            found = [names[i] for i, yes in zip(order, same, strict=True) if yes]
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]] * len(found), pa.int64()), pa.array(found, pa.int64())], ["a", "b"]
            )

        for batch in batches:
            firsts, tries, seconds, head = (batch.column(i).to_pylist() for i in range(4))
            ends = np.asarray(batch.column(4).offsets)
            flat = np.asarray(batch.column(4).values)
            for i in range(batch.num_rows):
                grams = flat[ends[i] : ends[i + 1]]
                if head[i]:
                    if names:
                        yield done()
                    key, probe, names, sets = (firsts[i], tries[i]), grams.copy(), [], []
                else:
                    names.append(seconds[i])
                    sets.append(grams.copy())
        if names:
            yield done()

    links = written(grouped.mapInArrow(compare, "a long, b long"), "links")
    release(scratch, links)
    return links


def _reaches(a: str, b: str, percent: int) -> Column:
    """Whether two sets whose first common n-gram this is can be similar enough.

    Before their first common n-gram two sets share nothing, so the overlap is at
    most what either has from there on. Every similar pair has a first one.
    """
    least = F.least(F.col(f"{a}.reach"), F.col(f"{b}.reach"))
    return least * (100 + percent) >= (F.col(f"{a}.n_shingles") + F.col(f"{b}.n_shingles")) * percent


def _pairs(met: DataFrame) -> DataFrame:
    """(a, key_a, b, key_b) of the sets that meet, each pair once, a the lesser one."""
    low = F.col("p.set_id") < F.col("q.set_id")
    pick = lambda x, y, name: F.when(low, F.col(f"{x}.{name}")).otherwise(F.col(f"{y}.{name}"))
    return (
        met.select(
            pick("p", "q", "set_id").alias("a"), pick("p", "q", "row_key").alias("key_a"),
            pick("q", "p", "set_id").alias("b"), pick("q", "p", "row_key").alias("key_b"),
        )
        .groupBy("a", "b")
        .agg(F.min("key_a").alias("key_a"), F.min("key_b").alias("key_b"))
    )


def _distance(a: Column, b: Column) -> Column:
    """In how many slots the parity of two sets differs, that of more words halved before."""
    xor = lambda x, y: x.bitwiseXOR(y)

    def halved(x: Column, y: Column) -> Column:
        half = (F.size(x) / 2).cast("int")
        return F.when(F.size(x) > F.size(y), F.zip_with(F.slice(x, 1, half), F.slice(x, half + 1, half), xor)).otherwise(x)

    bits = F.zip_with(halved(a, b), halved(b, a), lambda x, y: F.bit_count(xor(x, y)))
    return F.aggregate(bits, F.lit(0), lambda n, x: n + x)


def _not_too_far(distance: Column, sizes: Column, percent: int) -> Column:
    """Whether two sets of ``sizes`` n-grams together, of which only one has ``distance``, can be similar enough."""
    return distance * (100 + percent) <= sizes * (100 - percent)


def _comparable(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` of ``_pairs`` whose parity does not tell that they are too far apart."""
    side = lambda x: sets.select(F.col("set_id").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("parity").alias(f"parity_{x}"))
    near = _not_too_far(_distance(F.col("parity_a"), F.col("parity_b")), F.col("n_a") + F.col("n_b"), percent)
    return pairs.join(side("a"), "a").join(side("b"), "b").where(near).select(*pairs.columns)


def _near(a: str, b: str, percent: int) -> Column:
    """The same of two sets that meet, by the few words that are at hand there."""
    bits = [F.bit_count(F.col(f"{a}.parity_{i}").bitwiseXOR(F.col(f"{b}.parity_{i}"))) for i in range(WORDS)]
    return _not_too_far(sum(bits[1:], bits[0]), F.col(f"{a}.n_shingles") + F.col(f"{b}.n_shingles"), percent)


#: A round of a few partners each that leaves more than this share of the groups apart is the last one.
JOINING = 0.8
#: Sets of one meeting that are put in a chain together.
CHAIN = 1000


def _few_words(sets: DataFrame) -> list[Column]:
    """``WORDS`` words of the parity of a set, whatever its size."""
    folded = lambda i: F.aggregate(
        F.filter("parity", lambda _, at: at % WORDS == i), F.lit(0).cast("long"), lambda x, y: x.bitwiseXOR(y)
    )
    return [folded(i).alias(f"parity_{i}") for i in range(WORDS)]


def _apart(met: DataFrame, sets: DataFrame, roots: DataFrame) -> DataFrame:
    """The meetings of sets of different groups, with root and few words of parity of each set."""
    rooted = sets.join(roots, F.col("set_id") == F.col("node"), "left").select(
        "set_id", F.coalesce("root", "set_id").alias("root"), *_few_words(sets)
    )
    grouped = met.select("gram", "n", "set_id", "row_key", "reach", "n_shingles").join(rooted, "set_id")
    between = (
        grouped.groupBy("gram").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x < y").select("gram")
    )
    return written(grouped.join(between, "gram", "left_semi"), "apart")


def _meeting(turn: int) -> tuple[Column, Column]:
    """The chain of a set in a meeting; large meetings are several chains, so that none is a single task."""
    return F.col("gram"), F.pmod(F.xxhash64("gram", "set_id", F.lit(turn)), F.ceil(F.col("n") / CHAIN))


def _hung(met: DataFrame) -> DataFrame:
    """(p, q): each set of a chain with its first one and with the one before it.

    The first one has the fewest n-grams before the common one, which are those that few
    others have: copies with changes hang on the copy without.
    """
    whole = F.struct("set_id", "row_key", "reach", "n_shingles")
    order = Window.partitionBy(*_meeting(0)).orderBy(F.col("n_shingles") - F.col("reach"), F.xxhash64("gram", "set_id"), "set_id")
    found = met.select(whole.alias("p"), F.array(F.first(whole).over(order), F.lag(whole).over(order)).alias("others"))
    return found.select("p", F.explode("others").alias("q")).where("p.set_id <> q.set_id")


def _chained(apart: DataFrame, turn: int) -> DataFrame:
    """(p, q): each set of a chain with the one before it in a random order, if that is of another group.

    A set stands in several meetings and so meets several others.
    """
    whole = F.struct("set_id", "row_key", "reach", "n_shingles", "root", *[f"parity_{i}" for i in range(WORDS)])
    order = Window.partitionBy(*_meeting(turn)).orderBy(F.xxhash64("gram", "set_id", F.lit(turn)), "set_id")
    return apart.select(whole.alias("p"), F.lag(whole).over(order).alias("q")).where("p.root <> q.root")


def similar_groups(docs: DataFrame, text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """The columns of ``docs`` but ``text``, with n_shingles, set_id and root.

    Rows are in one group, with one ``root``, if a chain of links joins them; two
    rows link if 100 * intersection >= ``percent`` * union of their sets of
    ``width``-word n-grams. Rows with the empty set have null set_id and root. The
    columns kept are the caller's few; they may not be called as the added ones.
    """
    others = [c for c in docs.columns if c != text]
    row = [F.col(f"`{c}`") for c in docs.columns]
    texts = docs.select(F.col(f"`{text}`").alias("text"), F.xxhash64(*row).alias("row_key"), *others)
    classes = _frequency_classes(texts.select("text"), width)
    scratch: list[str] = []
    while True:
        with noted(scratch):
            rows = written(_prefixes(texts, classes, width, percent), "prefixes")
            release(scratch, rows)  # of an earlier turn
            shared = written(_shared_grams(rows), "shared")
        crowded = shared.where((F.col("n") > CROWDED) & (F.shiftright("gram", GRAM_BITS) == 0))
        better = _raised(classes, crowded)
        if (better == classes).all():
            break
        classes = better

    meetings: list[str] = []
    with noted(meetings):
        met = written(_meetings(rows, shared), "meetings")
    parities: list[str] = []
    with noted(parities):
        sets = rows.where("set_id is not null").groupBy("set_id", "n_shingles").agg(F.first("parity").alias("parity"))
        sets = written(sets.join(met.select("set_id").distinct(), "set_id", "left_semi"), "parities")
    rows = written(rows.drop("prefix", "parity", "row_key"), "rows")
    release(scratch, rows)
    # A few partners for each set, for as long as that joins groups ...
    tried = written(_comparable(_pairs(_hung(met).where(_reaches("p", "q", percent))), sets, percent), "tried")
    links = _links(tried, texts, classes, width, percent)
    roots = written(components(links), "roots")
    apart, groups, turn = _apart(met, sets, roots), sets.count(), 1
    release(meetings, apart)
    while (left := apart.select("root").distinct().count()) <= JOINING * groups and left:
        pairs = _pairs(_chained(apart, turn).where(_reaches("p", "q", percent) & _near("p", "q", percent)))
        pairs = written(_comparable(pairs.join(tried, ["a", "b"], "left_anti"), sets, percent), "tried")
        links = written(links.unionByName(_links(pairs, texts, classes, width, percent)), "links")
        roots, tried = written(components(links), "roots"), tried.unionByName(pairs)
        apart, groups, turn = _apart(apart, sets, roots), left, turn + 1
    # ... and then all that are still apart, so that no link is missed.
    p, q = apart.alias("p"), apart.alias("q")
    across = p.join(
        q,
        (F.col("p.gram") == F.col("q.gram")) & (F.col("p.root") < F.col("q.root"))
        & _reaches("p", "q", percent) & _near("p", "q", percent),
    )
    pairs = _comparable(_pairs(across).join(tried, ["a", "b"], "left_anti"), sets, percent)
    more = _links(written(pairs, "rest"), texts, classes, width, percent)
    release(parities, more)
    roots = components(links.unionByName(more))
    return (
        rows.join(roots, F.col("set_id") == F.col("node"), "left")
        .withColumn("root", F.coalesce("root", "set_id"))
        .drop("node")
    )


def component_ids(docs: DataFrame, percent: int = 80, width: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id): component_id is the least doc_id of the row's group.

    A row with the empty set is alone: its component_id is its own doc_id. Null
    ids are passed over when the least is taken.
    """
    grouped = written(similar_groups(docs.select("doc_id", "text"), "text", width, percent), "groups")
    least = grouped.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return grouped.join(least, "root", "left").select(
        "doc_id", "n_shingles", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def one_of_each_group(docs: DataFrame, percent: int = 80, width: int = 5) -> DataFrame:
    """``docs`` without near duplicates: of each group the row with the least doc_id stays.

    Rows are told apart by doc_id and text: rows that repeat both, and equal texts
    without doc_id, stay or go together; ``one_row_of_each_group`` parts them.
    """
    key = F.xxhash64("doc_id", "text")
    return without(docs, key, _others(docs.select("doc_id", "text", key.alias("own_key")), percent, width), "own_key")


def one_row_of_each_group(docs: DataFrame, percent: int = 80, width: int = 5) -> DataFrame:
    """``docs`` with exactly one row of each group: the first with the least doc_id, null ids last.

    ``docs`` is written first, so that rows keep their numbers.
    """
    row = unused(docs, "_row")
    whole = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    dropped = _others(whole.select("doc_id", "text", F.col(row).alias("own_key")), percent, width)
    return without(whole, F.col(row), dropped, "own_key").drop(row)


def _others(rows: DataFrame, percent: int, width: int) -> DataFrame:
    """(own_key) of the ``rows`` (doc_id, text, own_key) that their groups do not keep."""
    grouped = written(similar_groups(rows, "text", width, percent).where("root is not null"), "groups")
    # A missing id sorts after all others.
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "own_key")
    best = grouped.groupBy("root").agg(F.min(order).alias("best"))
    dropped = grouped.join(best, "root").where(F.col("own_key") != F.col("best.own_key")).select("own_key")
    return written(dropped, "dropped")
