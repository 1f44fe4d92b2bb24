"""Fold of areas whose names contain each other into representatives with an other code.

The fold goes through the areas in order, but what becomes of an area depends only on
who stands in the places of representatives that ever hold a name that pairs with its
own. So it runs in rounds over names, not areas: a round looks at the first undecided
area of every name and, where all that can matter to it is known, decides it and the
areas of that name behind it until something changes. A place is known as long as
every undecided area of it pairs with its holder: such an area is absorbed somewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.session import work_folder

CELLS = ["position", "code", "name", "other_code", "area_code", "area_name"]
#: Characters of the grams that names are met by; shorter names are grams themselves.
GRAM = 3


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _pairs(names: DataFrame) -> DataFrame:
    """(x, y): ids of names of which one contains the other, both ways, every name with itself.

    A name is filed under its rarest gram, by which all names that may contain it
    find it: as many rows as a name has characters, not as it has parts.
    """
    low = F.col("low")

    def parts(size: int) -> Column:
        places = F.sequence(F.lit(1), F.length(low) - (size - 1))
        return F.when(F.length(low) >= size, F.transform(places, lambda i: F.substring(low, i, F.lit(size))))

    grams = [parts(size) for size in range(1, GRAM + 1)]
    all_grams = F.array_distinct(F.concat(*[F.coalesce(g, F.array().cast("array<string>")) for g in grams]))
    held = _stored(names.select("id", F.least(F.length(low), F.lit(GRAM)).alias("size"), F.explode(all_grams).alias("gram")), "grams")
    counts = held.groupBy("gram").agg(F.count("*").alias("n"))
    filed = (
        held.where(F.length("gram") == F.col("size"))
        .join(counts, "gram")
        .groupBy("id")
        .agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"))
        .select("gram", F.col("id").alias("y"))
    )
    met = held.select("gram", F.col("id").alias("x")).join(filed, "gram").select("x", "y")
    whole, part = names.select(F.col("id").alias("x"), low.alias("whole")), names.select(F.col("id").alias("y"), low.alias("part"))
    inside = _stored(met.join(part, "y").join(whole, "x").where("contains(whole, part)").select("x", "y"), "inside")
    return inside.unionByName(inside.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct()


def fold_aliases(areas: DataFrame) -> DataFrame:
    """Representatives in order of ``position``.

    An area is absorbed by the first earlier representative whose name contains
    its own or is contained in it, which takes its code as ``other_code`` (the
    last one stays); otherwise it becomes a representative. A repeated code with
    an unmatched name replaces the earlier entry in place. Blank names, which
    every name contains, are left out.
    """
    # A place among the representatives belongs to a code; a missing code is one as well.
    slot = F.when(F.col("code").isNull(), "").otherwise(F.concat(F.lit("="), F.col("code")))
    named = areas.select(*CELLS).filter(F.coalesce(F.length("name"), F.lit(0)) > 0)
    named = _stored(named.select("*", slot.alias("slot"), F.lower("name").alias("low")), "areas")
    names = _stored(named.select("low").distinct().withColumn("id", F.monotonically_increasing_id()), "names")
    pairs = _stored(_pairs(names), "pairs")
    undecided = _stored(named.join(names, "low").select("position", "slot", "id"), "undecided")
    # The slots that ever hold a name which pairs with x.
    reach = pairs.join(undecided.select(F.col("id").alias("y"), "slot").distinct(), "y").select("x", "slot").distinct()
    reach = _stored(reach, "reach")

    decided = holders = None  # of all rounds: position, slot, id, into: the slot that absorbed the area, or null
    while not undecided.isEmpty():
        if holders is None:
            holders = undecided.limit(0)
        verdict = _stored(_decide(undecided, holders, reach, pairs), "round")
        if verdict.isEmpty():
            raise RuntimeError("no area could be decided")  # the first undecided one always can
        decided = verdict if decided is None else decided.unionByName(verdict)
        holders = _stored(holders.unionByName(verdict.where("into is null").drop("into")), "holders")
        undecided = _stored(undecided.join(verdict, "position", "left_anti"), "undecided")
    if decided is None:
        return named.select(*CELLS)
    return _representatives(named, decided)


def _decide(undecided: DataFrame, holders: DataFrame, reach: DataFrame, pairs: DataFrame) -> DataFrame:
    """What becomes of the areas of every name up to its next change, where that is known."""
    first = undecided.groupBy(F.col("id").alias("x")).agg(F.min("position").alias("now"))
    events = holders.withColumn("held", F.lit(True)).unionByName(undecided.withColumn("held", F.lit(False)))
    before = F.col("position") < F.col("now")
    held, place = F.col("held"), F.struct("position", "id")
    slots = (
        reach.join(first, "x")
        .join(events, "slot")
        .groupBy("x", "slot", "now")
        .agg(
            F.max(F.when(held & before, place)).alias("last"),
            F.min(F.when(held & before, F.col("position"))).alias("start"),
            F.min(F.when(~held & before, F.col("position"))).alias("open"),
            F.min(F.when(held & ~before, F.col("position"))).alias("next"),
        )
        .select("*", F.col("last.id").alias("holder"), F.col("last.position").alias("since"))
    )
    # Undecided areas that may come to hold a slot: they do not pair with its holder.
    harmless = pairs.select(F.col("x").alias("id"), F.col("y").alias("holder"))
    rivals = (
        slots.select("x", "slot", "now", "holder", "since")
        .join(undecided, "slot")
        .where("id <> x and (since is null or position > since)")
        .join(harmless, ["id", "holder"], "left_anti")
        .groupBy("x", "slot")
        .agg(F.bool_or(before).alias("rivalled"), F.min(F.when(~before, F.col("position"))).alias("rival"))
    )
    matches = pairs.select("x", F.col("y").alias("holder"), F.lit(True).alias("pairs"))
    known = (
        slots.join(rivals, ["x", "slot"], "left")
        .join(matches, ["x", "holder"], "left")
        .select(
            "x",
            "slot",
            "now",
            "pairs",
            "start",
            # A slot counts from its first area on, which may be one that is not decided.
            F.least("start", "open").alias("counts"),
            F.least("next", "rival").alias("turn"),
            (F.coalesce("rivalled", F.lit(False)) | F.coalesce(F.col("open") < F.col("start"), F.lit(False))).alias("unsure"),
        )
    )
    sure_hit = F.when(~F.col("unsure") & F.col("pairs"), F.struct("start", "slot"))
    best = known.groupBy("x", "now").agg(
        F.min(sure_hit).alias("hit"), F.min(F.when(F.col("unsure"), F.col("counts"))).alias("unsure_from")
    )
    ready = best.where("unsure_from is null or unsure_from > hit.start")
    until = (
        known.select("x", "counts", "turn").join(ready, "x").where("counts <= hit.start").groupBy("x").agg(F.min("turn").alias("until"))
    )
    verdict = ready.join(until, "x", "left").select("x", "now", "until", F.col("hit.slot").alias("into"))
    return (
        undecided.join(verdict, F.col("id") == F.col("x"))
        .where("position = now or (into is not null and (until is null or position <= until))")
        .select("position", "slot", "id", "into")
    )


def _representatives(named: DataFrame, decided: DataFrame) -> DataFrame:
    held = (
        decided.where("into is null")
        .groupBy("slot")
        .agg(F.min("position").alias("start"), F.max("position").alias("holder"))
    )
    codes = named.select("position", F.col("code").alias("taken"))
    absorbed = (
        decided.where("into is not null")
        .join(codes, "position")
        .join(held.select(F.col("slot").alias("into"), "holder"), "into")
        .where(F.col("position") > F.col("holder"))
        .groupBy("into")
        .agg(F.max(F.struct("position", "taken")).alias("last"))
    )
    return (
        held.join(named.drop("slot"), F.col("holder") == F.col("position"))
        .join(absorbed, F.col("slot") == F.col("into"), "left")
        .select(
            F.col("start").alias("position"),
            "code",
            "name",
            F.when(F.col("last").isNotNull(), F.col("last.taken")).otherwise(F.col("other_code")).alias("other_code"),
            "area_code",
            "area_name",
        )
        .orderBy("position")
    )
