"""Personal data: base patterns, and identifiers found by the contexts these stand in.

Base matches of four kinds are seeds. What stands beside an identifier is its
lexical patterns: the word before it, the two words before it and the word after
it. Patterns and instances form a graph whose scores are exchanged until none
rises by more than ``SETTLED``: a pattern is as sure of a kind as the mean
score of the different instances it stands beside, an instance as its surest pattern. Where a sure
pattern stands beside something of a kind's form that no base pattern matches, that
is personal data too. Candidates are words with a digit or at sign, groups of
digits joined by single blanks, brackets, dots, slashes or hyphens, and mail
addresses written out in words.

Base patterns are written so that a search is linear in the text: a match may
begin only where a run of its first characters begins or the last match ended.

Defined results: a null text is empty; spans count code points from 0, the end
exclusive; base matches that fail their check are never brought back; a found
span never touches a base span or another found one; words further than ``BESIDE``
characters from an identifier's ends are no context of it; repeated and null ids are
rows like others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from daybook.llm.common import WHITE, bind, unused, written

KINDS = ("email", "ip", "card", "phone")
_LOCAL = r"[A-Za-z0-9._%+-]"
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a pattern to match at all.
TRIGGERS = {"email": "@", "ip": "[0-9]", "card": "[0-9]", "phone": r"\+"}
#: What may be an identifier: a written-out mail address, groups of digits, a word with a digit or at sign.
_AT, _DOT = r"(?i:at|\(at\)|\[at\])", r"(?i:dot|\(dot\)|\[dot\])"
_GROUP = r"[(\[]?[0-9]++[)\]]?+"
_CLOSING = r"\"')\]}>.,;:!?"
_NUMBER = rf"{_GROUP}(?:[./-]?{_GROUP})*+(?=[{_CLOSING}]*+(?:[{WHITE}]|\z))"
CANDIDATE = (
    rf"(?<![^{WHITE}])(?:{_LOCAL}++\x20{_AT}\x20[A-Za-z0-9-]++(?:\x20{_DOT}\x20[A-Za-z0-9-]++)++"
    rf"|\+?+{_NUMBER}(?:\x20{_NUMBER})*+|[^{WHITE}0-9@]*+[0-9@][^{WHITE}]*+)"
)
#: What a found identifier of a kind must look like.
FORMS = {
    "email": rf"^[^@\x20]+@[^@\x20]+$|^{_LOCAL}+ {_AT} [A-Za-z0-9-]+(?: {_DOT} [A-Za-z0-9-]+)+$",
    "ip": r"^[0-9A-Fa-f]*[.:][0-9A-Fa-f]*[.:][0-9A-Fa-f.:]*$",
    "card": r"^(?:[^0-9A-Za-z]*[0-9]){12,19}$",
    "phone": r"^\+?(?:[()\[\].\x20/-]*[0-9]){7,15}[)\]]?$",
}
#: Scores only rise, and no further than 1; a lesser rise than this ends the rounds.
SETTLED = 1e-6
#: A pattern must be this sure, by this many different instances.
SURE, SUPPORT = 0.8, 5


#: Numbers that are summed one by one; their sums are summed in turn.
BLOCK = 256


def _running_sums(numbers: Column) -> Column:
    """Sums of the first one, two, three ... numbers; arrays that grow one by one stay short."""

    def grown(block: Column) -> Column:
        return F.aggregate(
            block,
            F.array().cast("array<int>"),
            lambda acc, x: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)) + x)),
        )

    starts = lambda blocks: F.aggregate(
        blocks, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + F.element_at(x, -1)))
    )
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(numbers) - 1) / BLOCK).cast("int")),
        lambda k: grown(F.slice(numbers, k * BLOCK + 1, F.lit(BLOCK))),
    )
    return bind(
        blocks,
        lambda bs: bind(
            starts(bs),
            lambda before: F.flatten(F.transform(bs, lambda x, k: F.transform(x, lambda n: n + F.get(before, k)))),
        ),
    )


def spans(text: Column, pattern: str) -> Column:
    """Leftmost matches in order: array of (start, end, match, gap, next), with the text before and after."""

    def placed(found: Column, gaps: Column) -> Column:
        lengths = F.transform(found, lambda m, i: F.length(F.get(gaps, i)) + F.length(m))
        return bind(
            _running_sums(lengths),
            lambda ends: F.transform(
                found,
                lambda m, i: F.struct(
                    (F.get(ends, i) - F.length(m)).alias("start"), F.get(ends, i).alias("end"), m.alias("match"),
                    F.get(gaps, i).alias("gap"), F.get(gaps, i + 1).alias("next"),
                ),
            ),
        )

    empty = F.array().cast("array<struct<start:int,end:int,match:string,gap:string,next:string>>")
    return bind(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda found: F.when(F.size(found) == 0, empty).otherwise(
            bind(F.split(text, pattern, -1), lambda gaps: placed(found, gaps))
        ),
    )


def _passes(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return match.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "phone":
        return F.length(digits).between(8, 15)
    if kind == "card":
        return F.length(digits).between(16, 19) & bind(digits, luhn)
    return F.lit(True)


def _fails(kind: str, match: Column) -> Column:
    """Whether a match that does not pass is of the kind's form; a few digits are no failed card."""
    if kind == "card":
        return F.length(F.regexp_replace(match, "[^0-9]", "")).between(16, 19) & ~_passes(kind, match)
    return ~_passes(kind, match)


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def step(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), step) % 10 == 0


_SPAN = "array<struct<start:int,end:int,match:string>>"


def base_spans(text: Column, kind: str) -> Column:
    """Struct of ``good`` and ``failed`` spans of a kind, with what they match."""
    bare = lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["match"].alias("match"))
    split = lambda found: F.struct(
        F.transform(F.filter(found, lambda x: _passes(kind, x["match"])), bare).alias("good"),
        F.transform(F.filter(found, lambda x: _fails(kind, x["match"])), bare).alias("failed"),
    )
    none = F.struct(F.array().cast(_SPAN).alias("good"), F.array().cast(_SPAN).alias("failed"))
    return F.when(text.rlike(TRIGGERS[kind]), bind(spans(text, PATTERNS[kind]), split)).otherwise(none)


def _candidates(text: Column) -> Column:
    """Array of (start, end, value, contexts): what may be an identifier, bare of punctuation around it."""

    def contexts(gap: Column, after: Column) -> Column:
        two = F.lower(F.regexp_extract(gap, rf"([^{WHITE}]++[{WHITE}]++[^{WHITE}]++)[{WHITE}]*+$", 1))
        one = F.lower(F.regexp_extract(gap, rf"([^{WHITE}]++)[{WHITE}]*+$", 1))
        right = F.lower(F.regexp_extract(after, rf"^[{WHITE}]+([^{WHITE}]+)(?:[{WHITE}]|$)", 1))
        return F.array(
            F.when(one != "", F.concat(one, F.lit(" _"))),
            F.when(two != "", F.concat(F.regexp_replace(two, f"[{WHITE}]+", " "), F.lit(" _"))),
            F.when(right != "", F.concat(F.lit("_ "), right)),
        )

    def bare(x: Column) -> Column:
        front = F.when(
            x["match"].rlike(r"^[(\[][0-9]+[)\]]."), F.lit(0)  # a bracketed group of digits is part of its number
        ).otherwise(F.length(F.regexp_extract(x["match"], r"^[\"'(\[{<]*", 0)))
        back = F.length(F.regexp_extract(x["match"], r"[\"')\]}>.,;:!?]*$", 0))
        value = F.substring(x["match"], front + 1, F.greatest(F.lit(0), F.length(x["match"]) - front - back))
        # The last words before and the first one after; long texts beside an identifier are cut to their ends first.
        return F.struct(
            (x["start"] + front).alias("start"), (x["end"] - back).alias("end"), value.alias("value"),
            contexts(_last_words(x["gap"]), _first_words(x["next"])).alias("contexts"),
        )

    kind = "array<struct<start:int,end:int,value:string,contexts:array<string>>>"
    found = F.transform(spans(text, CANDIDATE), bare)
    return F.when(text.rlike(rf"[0-9@]|\x20{_DOT}\x20"), F.filter(found, lambda x: x["end"] > x["start"])).otherwise(F.array().cast(kind))


#: Longest text beside an identifier that is searched for words; words that do not end there are no context.
BESIDE = 200


def _last_words(gap: Column) -> Column:
    return F.when(F.length(gap) <= BESIDE, gap).otherwise(F.regexp_extract(F.right(gap, F.lit(BESIDE)), rf"[{WHITE}](?s:.*)$", 0))


def _first_words(gap: Column) -> Column:
    return F.when(F.length(gap) <= BESIDE, gap).otherwise(F.regexp_extract(F.left(gap, F.lit(BESIDE)), rf"^(?s:.*)[{WHITE}]", 0))


def _so_far(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _occurrences(found: DataFrame, row: str, base: dict[str, str], cands: str) -> DataFrame:
    """(row, start, end, value, contexts, seed, known, failed) of every candidate, set against the base spans.

    Spans and candidates of a row are put in order, and what begins before and
    after each candidate is carried along, so that their number counts once.
    """
    none = lambda kind: F.lit(None).cast(kind)
    entry = lambda kind, good: lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["match"].alias("value"),
        none("array<string>").alias("contexts"), F.lit(kind).alias("kind"), F.lit(good).alias("good"),
    )
    candidate = lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value"),
        x["contexts"].alias("contexts"), none("string").alias("kind"), none("boolean").alias("good"),
    )
    arrays = [F.transform(F.col(cands), candidate)]
    for k in KINDS:
        arrays += [
            F.transform(F.col(f"{base[k]}.good"), entry(k, True)),
            F.transform(F.col(f"{base[k]}.failed"), entry(k, False)),
        ]
    entries = (
        found.where(F.size(cands) > 0)
        .select(F.col(row).alias("row"), F.concat(*arrays).alias("entries"))
        .select("row", F.explode("entries").alias("e"))
        .select("row", "e.*")
    )
    # A span that begins with a candidate counts as one that begins after it.
    rising = _so_far(Window.partitionBy("row").orderBy("start", F.col("kind").isNotNull()))
    falling = _so_far(Window.partitionBy("row").orderBy(F.col("start").desc(), F.col("kind").isNull()))
    is_good = lambda k: F.col("good") & (F.col("kind") == k)
    is_failed = lambda k: ~F.col("good") & (F.col("kind") == k)
    before = {"good_end": F.max(F.when(F.col("good"), F.col("end"))).over(rising)}
    after = {}
    for k in KINDS:
        before[f"failed_end_{k}"] = F.max(F.when(is_failed(k), F.col("end"))).over(rising)
        after[f"failed_start_{k}"] = F.last(F.when(is_failed(k), F.col("start")), ignorenulls=True).over(falling)
        after[f"next_{k}"] = F.last(F.when(is_good(k), F.struct("start", "value")), ignorenulls=True).over(falling)
    set_against = entries.withColumns(before).withColumns(after).where("kind is null")
    begins = lambda k: F.col(f"next_{k}.start") < F.col("end")
    yes = lambda test: F.coalesce(test, F.lit(False))
    # What begins within a candidate is its seed, whole: the kind first named, if several do.
    seed = F.coalesce(*[F.when(begins(k), F.lit(k)) for k in KINDS])
    whole = F.coalesce(*[F.when(begins(k), F.col(f"next_{k}.value")) for k in KINDS], F.col("value"))
    known = yes(F.col("good_end") > F.col("start"))
    failed = F.array_compact(
        F.array(
            *[
                F.when(
                    yes(F.col(f"failed_end_{k}") > F.col("start")) | yes(F.col(f"failed_start_{k}") < F.col("end")), F.lit(k)
                )
                for k in KINDS
            ]
        )
    )
    return set_against.select(
        "row", "start", "end", F.array_compact("contexts").alias("contexts"), F.lower(whole).alias("value"),
        seed.alias("seed"), (known | seed.isNotNull()).alias("known"), failed.alias("failed"),
    ).where(F.col("seed").isNotNull() | ~F.col("known"))


def found_patterns(occurrences: DataFrame) -> DataFrame:
    """(left, kind, sure, support) of the patterns that are sure enough.

    ``occurrences`` holds left (the pattern), value and seed, the kind of a base match or null.
    """
    edges = written(
        occurrences.where("left <> ''").groupBy("left", "value").agg(F.max("seed").alias("seed")), "edges"
    )
    seeds = edges.where("seed is not null").groupBy("value", F.col("seed").alias("kind")).agg(F.lit(1.0).alias("score"))
    sizes = edges.groupBy("left").agg(F.count(F.lit(1)).alias("n"))
    scores, before, step = seeds, (0, 0.0), 0
    while True:
        patterns = written(
            edges.join(scores, "value")
            .groupBy("left", "kind")
            .agg(F.sum("score").alias("mass"))
            .join(sizes, "left")
            .select("left", "kind", (F.col("mass") / F.col("n")).alias("sure"), F.col("mass").alias("support"))
            .where((F.col("sure") >= SURE) & (F.col("support") >= SUPPORT)),
            f"patterns{step}",
        )
        now = patterns.agg(F.count(F.lit(1)), F.coalesce(F.sum("sure"), F.lit(0.0))).first()
        if now[0] == before[0] and now[1] - before[1] <= SETTLED:
            return patterns
        before, step = now, step + 1
        spread = edges.where("seed is null").join(patterns, "left").groupBy("value", "kind")
        scores = seeds.unionByName(spread.agg(F.max("sure").alias("score")))


def personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with arrays of spans for each kind: ``base_<kind>`` and ``all_<kind>``."""
    kept = [c for c in docs.columns if c != text]
    row, body, cands = unused(docs, "_row"), F.coalesce(F.col(f"`{text}`"), F.lit("")), unused(docs, "_candidates")
    found = docs.select(
        *[F.col(f"`{c}`") for c in kept],
        F.monotonically_increasing_id().alias(row),
        *[base_spans(body, kind).alias(unused(kept, f"_{kind}")) for kind in KINDS],
        _candidates(body).alias(cands),
    )
    base = {kind: unused(kept, f"_{kind}") for kind in KINDS}
    found = written(found, "base")

    occurrences = written(_occurrences(found, row, base, cands), "occurrences")
    beside = lambda rows: rows.withColumn("left", F.explode("contexts")).drop("contexts")
    patterns = found_patterns(beside(occurrences.select("contexts", "value", "seed")))
    form = F.lit(False)
    for k in KINDS:
        form = form | ((F.col("kind") == k) & F.col("value").rlike(FORMS[k]))
    more = (
        beside(occurrences.where("seed is null and not known"))
        .join(patterns, "left")
        .where(form & ~F.array_contains("failed", F.col("kind")))
        .groupBy("row", "start", "end")
        .agg(F.max(F.struct("sure", "kind")).alias("best"))
        .groupBy(F.col("row").alias("_more_row"))
        .agg(F.collect_list(F.struct(F.col("best.kind").alias("kind"), "start", "end")).alias("_more"))
    )
    out = found.join(more, F.col(row) == F.col("_more_row"), "left")
    bare = lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))
    extra = lambda k: F.transform(
        F.filter(F.coalesce("_more", F.array().cast("array<struct<kind:string,start:int,end:int>>")), lambda x: x["kind"] == k), bare
    )
    return out.select(
        *[F.col(f"`{c}`") for c in kept],
        *[F.transform(f"{base[k]}.good", bare).alias(f"base_{k}") for k in KINDS],
        *[F.array_sort(F.concat(F.transform(f"{base[k]}.good", bare), extra(k))).alias(f"all_{k}") for k in KINDS],
    )


def joined(prefix: str) -> Column:
    """kind:start:end of all spans, by kind and start, comma-joined."""
    named = lambda k: F.transform(
        F.col(f"{prefix}_{k}"),
        lambda x: F.concat_ws(":", F.lit(k), x["start"].cast("string"), x["end"].cast("string")),
    )
    return F.array_join(F.concat(*[named(k) for k in KINDS]), ",")


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, the number of base spans of each kind, their hash, and all spans of every document."""
    found = personal_data(docs.select("doc_id", "text"))
    return found.select(
        "doc_id",
        *[F.size(f"base_{k}").cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"),
        joined("all").alias("spans"),
    )


def masked(docs: DataFrame, text: str = "text", mask: str = "*") -> DataFrame:
    """``docs`` with every personal character but white space replaced by ``mask``."""
    whole = unused(docs, "_whole")
    found = personal_data(docs.withColumn(whole, F.col(f"`{text}`")), whole)
    all_spans = F.array_sort(F.concat(*[F.col(f"all_{k}") for k in KINDS]))
    step = lambda acc, x: F.concat(
        F.substring(acc, F.lit(1), x["start"]),
        F.regexp_replace(F.substring(acc, x["start"] + 1, x["end"] - x["start"]), f"[^{WHITE}]", mask),
        F.substring(acc, x["end"] + 1, F.length(acc)),
    )
    covered = F.when(F.col(f"`{text}`").isNotNull(), F.aggregate(all_spans, F.col(f"`{text}`"), step))
    return found.select(*[covered.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
