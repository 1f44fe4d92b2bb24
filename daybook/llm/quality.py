"""Quality rules: an ordered list of threshold conjunctions learned from labelled documents.

Rules are found by sequential covering. Each rule grows on one part of the
labelled rows, one threshold at a time by information gain, is pruned on the
other part, and is taken if it is precise enough there; what it covers leaves
both parts. The list becomes one Spark CASE expression over statistics that are
column expressions of the whole text.

Defined results: a null text has no words; a document without a label, and any
document when no labels are given, is judged by the rules alone; labels that are
null are not learned from; repeated labels each count; ties between thresholds
go to the feature named first and the lower threshold.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import WHITE, bind, words

#: Labelled rows the rules are learned from at most, the first by hash of the id.
FIT_ROWS = 20_000
#: Conditions of a rule, and rules of a list, at most.
MOST_CONDITIONS, MOST_RULES = 4, 16
#: Share of wrongly rejected among a rule's rejections that pruning rows may show.
MOST_WRONG = 0.02
#: Fewest bad rows a rule must cover, growing and pruning together.
LEAST_COVER = 8
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 3

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "symbols_per_word",
    "repeat_share",
    "chars_per_word",
    "upper_share",
    "marks_per_word",
    "dup_line_share",
    "n_words",
)


def repeated_words(w: Column) -> Column:
    """How many words lie in a window of ``WINDOW`` words that the array holds twice or more."""

    def covered(places: Column) -> Column:
        step = lambda acc, x: F.struct(
            x.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), x - acc["last"])).alias("n")
        )
        start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(places, start, step, lambda acc: acc["n"])

    def places(s: Column) -> Column:
        same = lambda e, k: (
            F.coalesce(F.get(s, k - 1)["h"] == e["h"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["h"] == e["h"], F.lit(False))
        )
        return F.array_sort(F.transform(F.filter(s, same), lambda e: e["i"]))

    def counted(h: Column) -> Column:
        pairs = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            bind(F.array_sort(pairs), lambda s: covered(places(s)))
        )

    windows = F.transform(
        F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)])
    )
    return F.when(F.size(w) < WINDOW, F.lit(0)).otherwise(bind(windows, counted)).cast("long")


def statistics(text: Column) -> Column:
    """A struct of ``COUNTS`` and ``FEATURES`` of a whole text.

    One expression that computes its parts once: it can be moved or filtered by
    without the words being split anew for each use.
    """

    def counts(body: Column, w: Column) -> Column:
        lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(f"[^{WHITE}]"))
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.aggregate(w, F.lit(0).cast("long"), lambda n, x: n + F.length(x)).alias("word_chars"),
            (F.length(body) - F.length(F.translate(body, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
            bind(lines, lambda x: F.struct(F.size(x).alias("all"), F.size(F.array_distinct(x)).alias("kinds"))).alias("lines"),
            repeated_words(w).alias("n_repeat_words"),
            F.regexp_count(body, F.lit(r"\p{Lu}")).alias("n_upper"),
            F.regexp_count(body, F.lit(r"[.!?]")).alias("n_marks"),
        )

    def features(c: Column) -> Column:
        share = lambda part, whole: F.when(whole > 0, part / whole).otherwise(F.lit(0.0))
        n_dup_lines = (c["lines"]["all"] - c["lines"]["kinds"]).cast("long")
        return F.struct(
            c["n_words"].alias("n_words"),
            c["word_chars"].alias("word_chars"),
            c["n_symbols"].alias("n_symbols"),
            n_dup_lines.alias("n_dup_lines"),
            c["n_repeat_words"].alias("n_repeat_words"),
            share(c["n_symbols"], c["n_words"]).alias("symbols_per_word"),
            share(c["n_repeat_words"], c["n_words"]).alias("repeat_share"),
            share(c["word_chars"], c["n_words"]).alias("chars_per_word"),
            share(c["n_upper"], c["word_chars"]).alias("upper_share"),
            share(c["n_marks"], c["n_words"]).alias("marks_per_word"),
            share(n_dup_lines, c["lines"]["all"]).alias("dup_line_share"),
        )

    filled = F.coalesce(text, F.lit(""))
    return bind(bind(filled, lambda body: bind(words(body), lambda w: counts(body, w))), features)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    bound: float

    def column(self, stats: Column) -> Column:
        value = stats[self.feature].cast("double")
        return value >= self.bound if self.above else value <= self.bound

    def holds(self, x: np.ndarray) -> np.ndarray:
        value = x[:, FEATURES.index(self.feature)]
        return value >= self.bound if self.above else value <= self.bound


Rule = tuple[Condition, ...]


def _holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for condition in rule:
        out &= condition.holds(x)
    return out


def _best_condition(x: np.ndarray, bad: np.ndarray) -> tuple[float, Condition | None]:
    """The threshold with the largest information gain for bad rows."""
    p, n = int(bad.sum()), len(bad)
    before = np.log2(p / n)
    best: tuple[float, Condition | None] = (0.0, None)
    for k, feature in enumerate(FEATURES):
        order = np.argsort(x[:, k], kind="stable")
        value, flag = x[order, k], bad[order]
        below_bad, below = np.cumsum(flag), np.arange(1, n + 1)
        edge = np.append(value[1:] > value[:-1], False)
        for above in (False, True):
            got_bad = (p - below_bad if above else below_bad)[edge]
            got = (n - below if above else below)[edge]
            if not len(got):
                continue
            gain = got_bad * (np.log2(np.maximum(got_bad, 1e-9) / got) - before)
            at = int(np.argmax(gain))
            if gain[at] > best[0] + 1e-9:
                place = np.flatnonzero(edge)[at]
                # Halfway between neighbours, so that unseen rows fall on the nearer side.
                best = (float(gain[at]), Condition(feature, above, float((value[place] + value[place + 1]) / 2)))
    return best


def _grow(x: np.ndarray, bad: np.ndarray) -> Rule:
    rule: Rule = ()
    inside = np.ones(len(x), bool)
    while len(rule) < MOST_CONDITIONS and bad[inside].any() and not bad[inside].all():
        _, condition = _best_condition(x[inside], bad[inside])
        if condition is None:
            break
        rule += (condition,)
        inside &= condition.holds(x)
    return rule


def _prune(rule: Rule, x: np.ndarray, bad: np.ndarray) -> Rule:
    """The beginning of the rule that does best on rows it did not grow on."""

    def worth(part: Rule) -> float:
        inside = _holds(part, x)
        p, n = int(bad[inside].sum()), int((~bad[inside]).sum())
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:k] for k in range(1, len(rule) + 1)), key=worth, default=())


def learn_rules(x: np.ndarray, bad: np.ndarray) -> list[Rule]:
    """Rules for bad rows, in the order found; ``x`` has a column for each of ``FEATURES``.

    Every third row prunes, the others grow.
    """
    rules: list[Rule] = []
    grows = np.arange(len(x)) % 3 != 2
    left = np.ones(len(x), bool)
    while len(rules) < MOST_RULES:
        grow, prune = left & grows, left & ~grows
        if not bad[grow].any():
            break
        rule = _prune(_grow(x[grow], bad[grow]), x[prune], bad[prune])
        if not rule:
            break
        inside = _holds(rule, x) & left
        tested = inside & ~grows
        wrong, right = int((~bad[tested]).sum()), int(bad[inside].sum())
        if right < LEAST_COVER or (tested.any() and wrong > MOST_WRONG * tested.sum()) or (~bad[inside]).mean() > MOST_WRONG:
            break
        rules.append(rule)
        left &= ~inside
    return rules


def accepts(rules: list[Rule], stats: Column) -> Column:
    """False if a rule fires on the statistics, in order; else true."""
    out = F.lit(True)
    for rule in reversed(rules):
        all_hold = rule[0].column(stats)
        for condition in rule[1:]:
            all_hold &= condition.column(stats)
        out = F.when(all_hold, F.lit(False)).otherwise(out)
    return out


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, id_col: str = "doc_id", text: str = "text") -> list[Rule]:
    """Rules learned from at most ``fit_rows`` labelled documents (label ``quality``, 0 is bad).

    The labels are the first by hash of the id, so their number bounds what is
    joined, and the rows of repeated ids that join them are cut to the bound too.
    """
    key, order = "_label_id", "_order"
    taken = (
        labels.where(F.col("quality").isNotNull() & F.col(id_col).isNotNull())
        .select(F.col(id_col).alias(key), F.col("quality").alias("_quality"))
        .orderBy(F.xxhash64(key), key, "_quality")
        .limit(fit_rows)
    )
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("text"))
    joined = texts.join(F.broadcast(taken), F.col("_id") == F.col(key))  # at most fit_rows narrow rows
    rows = (
        joined.withColumn("stats", statistics(F.col("text")))
        .select(F.xxhash64(key).alias(order), key, "_quality", *[F.col(f"stats.{f}").cast("double").alias(f) for f in FEATURES])
        .orderBy(order, key, "_quality", *FEATURES)
        .limit(fit_rows)
        .collect()
    )
    if not rows:
        return []
    x = np.array([[r[f] for f in FEATURES] for r in rows], float)
    return learn_rules(x, np.array([r["_quality"] == 0 for r in rows]))


def base_failed(stats: Column) -> Column:
    """Fewer than 50 words, or more than half of them in repeated windows."""
    return (stats["n_words"] < 50) | (100 * stats["n_repeat_words"] > 50 * stats["n_words"])


def judged(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per document: doc_id, n_words and the base counts, base_failed, kept."""
    rules = fit(docs, labels, fit_rows)
    stats = F.col("stats")
    return docs.select("doc_id", statistics(F.col("text")).alias("stats")).select(
        "doc_id",
        *[stats[name].alias(name) for name in COUNTS],
        base_failed(stats).alias("base_failed"),
        (~base_failed(stats) & accepts(rules, stats)).alias("kept"),
    )


def kept_documents(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The rows and columns of ``docs`` that the base rules and the learned rules keep."""
    rules = fit(docs, labels, fit_rows)
    return docs.where(bind(statistics(F.col("text")), lambda s: ~base_failed(s) & accepts(rules, s)))
