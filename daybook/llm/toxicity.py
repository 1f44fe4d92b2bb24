"""Toxicity by learning from confirmed toxic documents and unlabelled text.

Non-negative positive-unlabelled learning: the risk of a linear classifier is that of
the positives, weighted by the share of toxic documents, plus that of the unlabelled
texts less what the positives among them add to it. Where that difference falls
below zero the classifier fits the unlabelled texts too closely, and the step goes
back up. Several classifiers learn from bootstrap samples of both sides, in numpy; the
score is the mean of their probabilities. What they see of a text is which words it
holds, how words begin, and which beginnings a notable share of its words has.

The classifiers are fitted on bounded samples of different texts: ``POSITIVES`` and
``UNLABELLED``, the first by hash of the text. The share of toxic documents is that of
all labelled ones of the training part, and every text is scored whole.

Defined results: a null text is empty, and an empty text gets the score of a text with
no known feature; a document is positive if any of its labels is 1, null labels say
nothing; without positives the score is 0. A null document id belongs to the training
part and has no label. Equal texts have equal scores.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Container, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import unused, written

#: Different texts a fit takes of either side at most.
POSITIVES, UNLABELLED = 5_000, 10_000
#: Features the classifiers know, documents of the samples one must be in, and its least chi square.
FEATURES, LEAST_DOCUMENTS, SIGNIFICANT = 2_000, 5, 25.0
#: Lengths of beginnings, and the shares of a text's words (one in so many) that are told apart.
HEADS, SHARES = (4, 5, 6), (20, 50, 100)
#: Classifiers, steps, step size, weight decay, and how far a step goes back where the risk is negative.
MODELS, STEPS, RATE, DECAY, BACK = 3, 400, 0.1, 1e-4, 1.0
#: Documents are in one of this many parts; one of them is held out.
FOLDS, HELD_OUT = 3, 1
#: From this score on a document counts as toxic.
THRESHOLD = 0.7
LETTERS = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column) -> Column:
    """Whether a document takes no part in learning."""
    key = F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")
    return F.crc32(key) % FOLDS == HELD_OUT


def features(text: str | None, known: Container[str] | None = None) -> set[str]:
    """Words, beginnings (``^head``) and frequent beginnings (``^head/20``: one word in 20) of a text.

    With ``known`` only beginnings it holds are counted, which is faster.
    """
    words = Counter(LETTERS.findall((text or "").lower()))
    heads: Counter[str] = Counter()
    for word, n in words.items():
        for k in HEADS:
            if len(word) > k and (known is None or "^" + word[:k] in known):
                heads["^" + word[:k]] += n
    found = set(words)
    found.update(heads)
    total = words.total()
    found.update(f"{h}/{part}" for h, n in heads.items() if n > 1 for part in SHARES if n * part >= total)
    return found


# --- learning ----------------------------------------------------------------------------


def _softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, x)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


@dataclass(frozen=True)
class Bags:
    """Texts as the places of the features they hold, one after the other."""

    places: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, rows: list[list[int]]) -> Bags:
        sizes = np.array([len(r) for r in rows], np.int64)
        return cls(np.fromiter((p for r in rows for p in r), np.int64, sizes.sum()), sizes)

    def margins(self, weights: np.ndarray) -> np.ndarray:
        """Sum of the weights of each text's features, and the constant, which is the last weight."""
        sums = np.concatenate(([0.0], np.cumsum(weights[self.places])))
        ends = np.cumsum(self.sizes)
        return sums[ends] - sums[ends - self.sizes] + weights[-1]

    def pull(self, slopes: np.ndarray, n: int) -> np.ndarray:
        """Gradient of the weights from that of the margins."""
        back = np.bincount(self.places, np.repeat(slopes, self.sizes), minlength=n)
        back[-1] += slopes.sum()
        return back


def risk(positive: np.ndarray, unlabelled: np.ndarray, share: float, p: np.ndarray, u: np.ndarray) -> tuple[float, float]:
    """Risk of margins by positives, and that of negatives as the unlabelled texts show it.

    ``p`` and ``u`` are the weights of the texts and each sum to 1.
    """
    on_positive = share * (p @ _softplus(-positive))
    on_negative = u @ _softplus(unlabelled) - share * (p @ _softplus(positive))
    return float(on_positive), float(on_negative)


def learn(positives: Bags, unlabelled: Bags, share: float, n_features: int, seed: int) -> np.ndarray:
    """Weights of the features, and a constant, of least non-negative risk on a bootstrap sample."""
    rng = np.random.default_rng(seed)

    def drawn(bags: Bags) -> np.ndarray:
        counts = rng.multinomial(len(bags.sizes), np.full(len(bags.sizes), 1 / len(bags.sizes)))
        return counts / counts.sum()

    p, u = drawn(positives), drawn(unlabelled)
    weights, speed, size = np.zeros(n_features + 1), np.zeros(n_features + 1), np.zeros(n_features + 1)
    weights[-1] = np.log(share / (1 - share))
    for step in range(1, STEPS + 1):
        on_p, on_u = positives.margins(weights), unlabelled.margins(weights)
        of_negatives = unlabelled.pull(u * _sigmoid(on_u), n_features + 1) - share * positives.pull(p * _sigmoid(on_p), n_features + 1)
        if risk(on_p, on_u, share, p, u)[1] >= 0:
            gradient = of_negatives - share * positives.pull(p * _sigmoid(-on_p), n_features + 1)
        else:
            gradient = -BACK * of_negatives
        gradient[:-1] += DECAY * share * weights[:-1]
        speed = 0.9 * speed + 0.1 * gradient
        size = 0.999 * size + 0.001 * gradient**2
        weights -= RATE * (speed / (1 - 0.9**step)) / (np.sqrt(size / (1 - 0.999**step)) + 1e-8)
    return weights


def heads_of(known: Iterable[str]) -> frozenset[str]:
    return frozenset(f.split("/")[0] for f in known if f.startswith("^"))


def places_of(text: str | None, places: dict[str, int], heads: frozenset[str]) -> list[int]:
    return sorted(places[f] for f in places.keys() & features(text, heads))


@dataclass(frozen=True)
class Classifier:
    """Known features, the beginnings among them, and the weights of each in every model; the constants are last."""

    places: dict[str, int]
    heads: frozenset[str]
    weights: np.ndarray

    def scores(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros((len(texts), len(self.weights)))
        for i, text in enumerate(texts):
            at = places_of(text, self.places, self.heads)
            out[i] = self.weights[:, at].sum(axis=1) + self.weights[:, -1]
        return _sigmoid(out).mean(axis=1)


# --- samples -----------------------------------------------------------------------------


def _least(hashes: DataFrame, side: int, most: int) -> DataFrame:
    """(hash, side) of the ``most`` least different hashes."""
    return hashes.select("hash").distinct().orderBy("hash").limit(most).withColumn("side", F.lit(side))


def _all_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 100):
            part = batch.slice(at, 100)
            found = [sorted(features(t)) for t in part.column("text").to_pylist()]
            sides = np.repeat(part.column("side").to_numpy(), [len(f) for f in found])
            yield pa.RecordBatch.from_pydict({"feature": pa.array([f for x in found for f in x], pa.string()), "side": sides})


def _telling_features(sample: DataFrame, sizes: tuple[int, int]) -> list[str]:
    """Features whose shares of positive and of unlabelled texts differ most for their frequency (chi square)."""
    counts = (
        sample.mapInArrow(_all_features, "feature string, side int")
        .groupBy("feature")
        .agg(F.count_if(F.col("side") == 1).alias("p"), F.count_if(F.col("side") == 0).alias("u"))
        .where(F.col("p") + F.col("u") >= LEAST_DOCUMENTS)
    )
    p, u = F.col("p") / sizes[0], F.col("u") / sizes[1]
    both, scale = (F.col("p") + F.col("u")) / sum(sizes), sizes[0] * sizes[1] / sum(sizes)
    apart = scale * (p - u) * (p - u) / (both * (1 - both) + 1e-9)
    found = counts.select("feature", apart.alias("apart")).where(F.col("apart") >= SIGNIFICANT)
    return [r["feature"] for r in found.orderBy(F.col("apart").desc(), "feature").limit(FEATURES).collect()]


def _places(places: dict[str, int], heads: frozenset[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [places_of(t, places, heads) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("hash"), batch.column("side"), pa.array(found, pa.list_(pa.int32()))], names=["hash", "side", "places"]
            )

    return bags


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Classifier | None:
    """Classifiers from the training part of the documents; None without positives."""
    texts = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    training = texts.where(~held_out(F.col("id"))).withColumn("hash", F.xxhash64("text"))
    known = (
        labels.select(F.col(doc_id).alias("id"), F.col(label).alias("toxic"))
        .where(F.col("id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("id")))
        .groupBy("id")
        .agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    )
    share = known.agg(F.avg("toxic")).first()[0]
    if not share:
        return None
    hashes = training.select("id", "hash")
    positives = hashes.join(known.where("toxic = 1").select("id"), "id", "left_semi")
    chosen = written(_least(positives, 1, POSITIVES).unionByName(_least(hashes, 0, UNLABELLED)), "toxic_hashes")
    found = training.join(F.broadcast(chosen), "hash")  # POSITIVES + UNLABELLED rows at most
    sample = written(found.groupBy("hash", "side").agg(F.max("text").alias("text")), "toxic_sample")
    sizes = dict(sample.groupBy("side").count().collect())
    if not sizes.get(1):
        return None
    places = {f: i for i, f in enumerate(_telling_features(sample, (sizes[1], sizes[0])))}
    heads = heads_of(places)
    rows = sample.mapInArrow(_places(places, heads), "hash long, side int, places array<int>").collect()
    bags = [Bags.of([r["places"] for r in sorted(rows, key=lambda r: r["hash"]) if r["side"] == side]) for side in (1, 0)]
    share = min(share, 0.99)
    return Classifier(places, heads, np.array([learn(*bags, share, len(places), seed) for seed in range(MODELS)]))


# --- scoring -----------------------------------------------------------------------------


def scored(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the column ``out``: how likely the label 1 is, from 0 to 1."""
    model = fit(docs, labels, doc_id, text)
    out = unused(docs, out)
    if model is None:
        return docs.withColumn(out, F.lit(0.0))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores([t if isinstance(t, str) else None for t in texts]))

    return docs.withColumn(out, score(F.col(text)))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score of every document, whether it was held out, and the verdict."""
    rows = scored(docs.select("doc_id", "text"), labels)
    return rows.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
