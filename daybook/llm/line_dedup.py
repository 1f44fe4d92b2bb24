"""Fuzzy line de-duplication: MinHash, banding, exact Jaccard, distributed union-find.

A line's shingles are the runs of ``WIDTH`` characters at every place of the whole
line, in lower case; a shorter line is one shingle. Its signature is the least shingle
hash in ``SIZE`` orders, and each two neighbours of these make a band. Two lines are
candidates if they share a band and at least ``AGREE`` of all minima: lines of
similarity 0.8 are with a probability of 0.993. Candidates are verified by the exact
Jaccard similarity of all their shingles, links become components, and of each
component the first line, by document and place, is kept.

A band of m lines gives m - 1 pairs with its least line first. Of bands that then
still hold several components, the lines outside the largest are compared with all
others: each with one at random first, then the best pair of each two components, then
the rest. Bands in which that
would be very many pairs are first split by two more minima that candidates share,
so that lines with a frequent passage in common are not all compared. Parity bits of the
shingles of two lines bound how many only one of them has, so that pairs which cannot be
similar enough are left out where they meet.

Shingles are never stored: signatures are aggregated as the shingles are made, and
pairs are verified from the text of their lines.

Defined results: lines end at line feeds; lines without a word are never removed;
equal lines are one line with several places; a null text has no lines; documents
without id come after all others; the longest lines are taken whole.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.bits import thinned
from daybook.llm.common import WHITE, bind, noted, release, unused, written
from daybook.llm.components import components

WIDTH, PERCENT, SIZE, AGREE = 8, 80, 10, 4
#: Comparisons within a band from which it is split.
CROWDED = 1 << 24
#: Bits that are kept of each minimum beside the bands.
_KEPT = 6
#: 64-bit words of parity bits.
WORDS = 16
# Bytes of a character in UTF-32, where all have the same length.
_CHAR = 4


def _places(encoded: Column) -> Column:
    """Where in a line in UTF-32 a shingle begins; at its first byte if it is shorter than one."""
    return F.sequence(F.lit(1), F.greatest(F.length(encoded) - F.lit((WIDTH - 1) * _CHAR), F.lit(1)), F.lit(_CHAR))


def _shingle(encoded: Column, place: Column) -> Column:
    return F.xxhash64(F.substring(encoded, place, F.lit(WIDTH * _CHAR)))


def _encoded(line: Column) -> Column:
    return F.encode(F.lower(line), "UTF-32")


def shingles(line: Column) -> Column:
    """Distinct shingle hashes of a line."""
    return F.array_distinct(bind(_encoded(line), lambda b: F.transform(_places(b), lambda i: _shingle(b, i))))


def _signatures(lines: DataFrame) -> DataFrame:
    """(line_key, bands, kept) of each different line; kept holds some bits of all its minima.

    Order i is that of the hashes with i added to their first bits without carry: a
    random order like any other, for which no further hash is needed.
    """
    encoded = lines.select(F.xxhash64("line").alias("line_key"), _encoded(F.col("line")).alias("encoded"))
    # One row a shingle, which goes from the generator straight into the aggregate.
    at = encoded.select("line_key", "encoded", F.explode(_places(F.col("encoded"))).alias("place"))
    hashed = at.select("line_key", _shingle(F.col("encoded"), F.col("place")).alias("h"))
    orders = [F.lit((i - 8) << 60) for i in range(SIZE)]
    least = hashed.groupBy("line_key").agg(*[F.min(F.col("h").bitwiseXOR(o)).alias(f"m{i}") for i, o in enumerate(orders)])
    bands = F.array(*[F.xxhash64(F.lit(i), F.col(f"m{i}"), F.col(f"m{i + 1}")) for i in range(0, SIZE, 2)])
    bits = [F.shiftleft(F.col(f"m{i}").bitwiseAND(F.lit((1 << _KEPT) - 1)), i * _KEPT) for i in range(SIZE)]
    return least.select("line_key", bands.alias("bands"), reduce(Column.bitwiseOR, bits).alias("kept"))


def _minimum(kept: Column, i: int) -> Column:
    return F.shiftright(kept, i * _KEPT).bitwiseAND(F.lit((1 << _KEPT) - 1))


def _agreeing(p: Column, q: Column) -> Column:
    """How many minima of two lines agree, as far as is kept of them: never fewer than really do."""
    return reduce(Column.__add__, [(_minimum(p.bitwiseXOR(q), i) == 0).cast("int") for i in range(SIZE)])


def _finer(band: Column, at: Column, kept: Column) -> Column:
    """What becomes of a band in which candidates agree twice: a band for each two other minima."""
    two = [
        F.when(~at.isin(i // 2, j // 2), F.xxhash64(band, F.lit(i), F.lit(j), _minimum(kept, i), _minimum(kept, j)))
        for i, j in combinations(range(SIZE), 2)
    ]
    return F.array_compact(F.array(*two))


def _lines(text: Column) -> Column:
    """Array of (place, line) of the lines of a text that hold a word."""
    split = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x, i: F.struct(i.alias("place"), x.alias("line")))
    return F.filter(split, lambda x: x["line"].rlike(f"[^{WHITE}]"))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("line_key"))


def _texts(wanted: DataFrame, lines: DataFrame) -> DataFrame:
    """(line_key, line) of the lines whose keys are wanted, each once."""
    wanted = written(wanted.distinct(), "wanted")
    # Only wanted lines are moved, and the few that the table cannot tell from them.
    found = (
        thinned(lines, F.xxhash64("line"), wanted, "line_key")
        .groupBy(F.xxhash64("line").alias("line_key"))
        .agg(F.first("line").alias("line"))
        .join(wanted, "line_key", "left_semi")
    )
    return written(found, "texts")


def _some(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The texts of the lines of ``pairs``, if these are few of all, and a few others."""
    return thinned(texts, F.col("line_key"), _ends(pairs), "line_key")


def _links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` whose shingles are similar enough."""
    a = texts.select(F.col("line_key").alias("a"), F.col("line").alias("line_a"))
    b = texts.select(F.col("line_key").alias("b"), F.col("line").alias("line_b"))
    sets = pairs.select("a", "b").join(a, "a").join(b, "b").select(
        "a", "b", shingles(F.col("line_a")).alias("of_a"), shingles(F.col("line_b")).alias("of_b")
    )
    # Counts are written before they are looked at, so that shingles are made once.
    counted = written(
        sets.select(
            "a", "b", F.size(F.array_intersect("of_a", "of_b")).alias("n"), (F.size("of_a") + F.size("of_b")).alias("of_both")
        ),
        "counted",
    )
    return counted.where(F.col("n") * 100 >= (F.col("of_both") - F.col("n")) * PERCENT).select("a", "b")


def _open(entries: DataFrame) -> DataFrame:
    """The entries of bands with several components, and main, the component with most lines of the band.

    others and total are the lines outside main and all lines.
    """
    # Dealt by band once, for both windows.
    one, whole = Window.partitionBy("band", "root"), Window.partitionBy("band")
    sized = entries.repartition("band").withColumn("n", F.count(F.lit(1)).over(one))
    sized = sized.withColumns({
        "most": F.max(F.struct("n", "root")).over(whole),
        "total": F.count(F.lit(1)).over(whole),
        "several": F.min("root").over(whole) != F.max("root").over(whole),
    })
    main, others = F.col("most")["root"].alias("main"), (F.col("total") - F.col("most")["n"]).alias("others")
    return sized.where("several").select(*entries.columns, main, "total", others)


def _meeting(rooted: DataFrame) -> DataFrame:
    """The entries of open bands, and those of what crowded ones are split into, written."""
    whole = written(_open(rooted), "open")
    crowded = F.col("others") * F.col("total") > CROWDED
    if whole.where(crowded).isEmpty():
        return whole
    finer = whole.where(crowded).select(
        "line_key", "kept", "root", "at", F.explode(_finer(F.col("band"), F.col("at"), F.col("kept"))).alias("band")
    )
    return written(whole.where(~crowded).unionByName(_open(finer.select(*rooted.columns))), "meeting")


def _marks(texts: DataFrame) -> DataFrame:
    """(line_key, size, w0 and on): how many shingles a line has, and the parity of their number in each slot."""
    each = texts.select("line_key", F.explode(shingles(F.col("line"))).alias("h"))
    word = F.pmod(F.shiftright("h", 6), F.lit(WORDS))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("h").bitwiseAND(F.lit(63)).cast("int"))
    parity = [F.bit_xor(F.when(word == j, bit).otherwise(F.lit(0).cast("long"))).alias(f"w{j}") for j in range(WORDS)]
    return each.groupBy("line_key").agg(F.count(F.lit(1)).alias("size"), *parity)


def _apart() -> Column:
    """Whether an entry p outside the main component and an entry q are candidates of different components."""
    # Lines of the main component are met once, the others in one order.
    once = (F.col("q.root") == F.col("q.main")) | (F.col("p.line_key") < F.col("q.line_key"))
    agree = _agreeing(F.col("p.kept"), F.col("q.kept")) >= AGREE
    return (F.col("p.band") == F.col("q.band")) & (F.col("p.root") != F.col("q.root")) & once & agree


def _close() -> Column:
    """False only if p and q are not similar enough: slots of different parity are shingles of one of them."""
    differ = reduce(Column.__add__, [F.bit_count(F.col(f"p.w{j}").bitwiseXOR(F.col(f"q.w{j}"))) for j in range(WORDS)])
    most = (F.col("p.size") + F.col("q.size")) * (100 - PERCENT)
    return (F.abs(F.col("p.size") - F.col("q.size")) * (100 + PERCENT) <= most) & (differ * (100 + PERCENT) <= most)


def _rooted(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """``pairs`` with x and y, the roots of a and b, where these differ."""
    x = roots.select(F.col("node").alias("a"), F.col("root").alias("x"))
    y = roots.select(F.col("node").alias("b"), F.col("root").alias("y"))
    both = pairs.join(x, "a", "left").join(y, "b", "left").withColumns({"x": F.coalesce("x", "a"), "y": F.coalesce("y", "b")})
    return both.where("x <> y")


def similar_lines(lines: DataFrame) -> DataFrame:
    """(node, root) of the keys of lines that are similar to others, of the ``lines`` that hold a word.

    What is written on the way is removed as soon as nothing reads it any more.
    """
    scratch: list[str] = []
    with noted(scratch):
        found = _components_of(lines, scratch)
    roots = written(found, "roots")
    release(scratch, roots)
    return roots


def _components_of(lines: DataFrame, scratch: list[str]) -> DataFrame:
    entries = _signatures(lines).select("line_key", "kept", F.posexplode("bands").alias("at", "band"))
    # Entries are dealt once, by band; the least line comes with each of them.
    band = Window.partitionBy("band")
    met = entries.repartition("band").withColumns({"m": F.count(F.lit(1)).over(band), "least": F.min(F.struct("line_key", "kept")).over(band)})
    met = written(met.where("m > 1").drop("m"), "met")

    stars = met.where((F.col("line_key") != F.col("least.line_key")) & (_agreeing(F.col("kept"), F.col("least.kept")) >= AGREE))
    tried = written(stars.select(F.col("least.line_key").alias("a"), F.col("line_key").alias("b")).distinct(), "tried")
    links = _links(tried, _texts(_ends(tried), lines))
    roots = written(components(links), "roots")
    release(scratch, met, tried, links, roots)

    rooted = met.join(roots, F.col("line_key") == F.col("node"), "left")
    meeting = _meeting(rooted.select("line_key", "kept", "at", "band", F.coalesce("root", "line_key").alias("root")))
    release(scratch, meeting, tried, links)
    small, every = meeting.where("root <> main").alias("p"), meeting.alias("q")
    ends = small.join(every, _apart(), "left_semi").unionByName(every.join(small, _apart(), "left_semi"))
    texts = _texts(ends.select("line_key"), lines)
    marked = written(meeting.join(_marks(texts), "line_key"), "marked")
    release(scratch, marked, texts, tried, links)

    # The lines of a band in a random order, each with the one before it, join most of what is alike at little cost.
    in_turn = Window.partitionBy("band").orderBy(F.xxhash64("band", "line_key"), "line_key")
    entry = F.struct("line_key", "kept", "root", "size", *[f"w{j}" for j in range(WORDS)])
    chained = marked.select(entry.alias("p"), F.lag(entry).over(in_turn).alias("q"))
    agree = _agreeing(F.col("p.kept"), F.col("q.kept")) >= AGREE
    chained = chained.where((F.col("p.root") != F.col("q.root")) & agree & _close())
    chained = chained.select(F.least("p.line_key", "q.line_key").alias("a"), F.greatest("p.line_key", "q.line_key").alias("b"))
    turned = written(chained.distinct().join(tried, ["a", "b"], "left_anti"), "turned")
    tried = tried.unionByName(turned)
    links = links.unionByName(_links(turned, _some(texts, turned)))
    roots = written(components(links), "roots")
    marked = marked.drop("root", "main", "total", "others").join(roots, F.col("line_key") == F.col("node"), "left")
    marked = written(_open(marked.withColumn("root", F.coalesce("root", "line_key")).drop("node")), "marked")
    release(scratch, marked, texts, tried, links, roots)

    pairs = marked.where("root <> main").alias("p").join(marked.alias("q"), _apart() & _close())
    a, b = F.least("p.line_key", "q.line_key"), F.greatest("p.line_key", "q.line_key")
    pairs = pairs.select(a.alias("a"), b.alias("b"), _agreeing(F.col("p.kept"), F.col("q.kept")).alias("same")).distinct()
    left = written(pairs.join(tried, ["a", "b"], "left_anti"), "left")
    if left.isEmpty():
        return roots
    release(scratch, left, texts, links, roots)
    x, y = F.least("x", "y"), F.greatest("x", "y")
    best = _rooted(left, roots).groupBy(x, y).agg(F.max_by(F.struct("a", "b"), "same").alias("pair")).select("pair.*")
    best = written(best, "best")
    links = links.unionByName(_links(best, _some(texts, best)))
    rest = _rooted(left.join(best, ["a", "b"], "left_anti"), written(components(links), "roots"))
    rest = written(rest.select("a", "b"), "rest")
    return components(links.unionByName(_links(rest, _some(texts, rest))))


def removed_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, doc_id, n_lines, removed): of each row how many lines hold a word, and which places go.

    ``docs`` has a column row that numbers its rows.
    """
    found = _lines(F.col(f"`{text}`"))
    entry = lambda x: F.struct(x["place"].alias("place"), F.xxhash64(x["line"]).alias("line_key"))
    # Rows and what becomes of their lines are written at once: a row keeps its number in all uses.
    rows = written(docs.select("row", "doc_id", F.transform(found, entry).alias("lines")), "places")
    places = rows.select("row", "doc_id", F.explode("lines").alias("at")).select("row", "doc_id", "at.*")
    roots = similar_lines(docs.select(F.explode(found).alias("at")).select("at.line"))
    again = places.groupBy("line_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("line_key")
    node = roots.select(F.col("node").alias("line_key"), "root")
    groups = again.join(node, "line_key", "full").select("line_key", F.coalesce("root", "line_key").alias("root"))
    members = written(places.join(groups, "line_key"), "members")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "place")
    kept = members.groupBy("root").agg(F.min(order).alias("kept"))
    gone = (
        members.join(kept, "root")
        .where(~((F.col("row") == F.col("kept.row")) & (F.col("place") == F.col("kept.place"))))
        .groupBy("row")
        .agg(F.array_sort(F.collect_list("place")).alias("removed"))
    )
    removed = F.coalesce("removed", F.array().cast("array<int>")).alias("removed")
    return rows.select("row", "doc_id", F.size("lines").cast("long").alias("n_lines")).join(gone, "row", "left").select(
        "row", "doc_id", "n_lines", removed
    )


def _numbered(docs: DataFrame, text: str) -> DataFrame:
    return docs.select("doc_id", F.col(f"`{text}`").alias("text"), F.monotonically_increasing_id().alias("row"))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed, and removed, the places of the removed lines, comma-joined."""
    out = removed_lines(_numbered(docs, "text"))
    return out.select(
        "doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"),
        F.array_join(F.transform("removed", lambda x: x.cast("string")), ",").alias("removed"),
    )


def without_fuzzy_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with one line left of each component of similar lines.

    ``docs`` is written first, so that rows keep their numbers.
    """
    row = unused(docs, "row")
    whole = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    named = whole.select("doc_id", F.col(f"`{text}`").alias("text"), F.col(row).alias("row"))
    key, places = unused(whole, "_gone_row"), unused(whole, "_removed")
    gone = removed_lines(named).where(F.size("removed") > 0)
    gone = gone.select(F.col("row").alias(key), F.col("removed").alias(places))
    kept = F.filter(F.split(F.col(f"`{text}`"), "\n"), lambda x, i: ~F.array_contains(places, i))
    left = F.when(F.col(places).isNull(), F.col(f"`{text}`")).otherwise(F.array_join(kept, "\n"))
    return whole.join(gone, F.col(row) == F.col(key), "left").select(
        *[left.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns]
    )
