"""Spelling variants, whitening and toxicity against plain Python, numpy and held-out labels."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.llm import spelling, toxicity, whitening
from tests.llm import plain

DOCS = "doc_id long, text string, lang string, source string, word string, n long, near string, root string, size string, key string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, *["x"] * 3, 7, *["x"] * 4) for i, t in rows], DOCS).repartition(3)


# --- spelling ------------------------------------------------------------------------


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def near_pairs(words):
    """All ordered pairs of words one edit apart, by every word without each of its characters."""
    by = defaultdict(set)
    for w in words:
        for left in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            by[left].add(w)
    return {(a, b) for group in by.values() for a in group for b in group if a != b and one_edit(a, b)}


def variants(counts, ratio=10):
    near, form = defaultdict(set), {}
    for a, b in near_pairs([w for w in counts if len(w) >= 7]):
        near[a].add(b)
    for w, found in near.items():
        best = min(found, key=lambda x: (-counts[x], x))
        if counts[best] >= ratio * counts[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(near[w]), counts[form[w]] if w in form else None) for w, n in counts.items()}


@pytest.mark.parametrize(
    ("letters", "longest", "listed", "crowded"), [("ab", 11, 1 << 15, 256), ("abc", 10, 300, 4), ("abcé中\U0001f600", 9, 100, 256), ("ab", 9, 20, 1)]
)
def test_near_words(spark, monkeypatch, letters, longest, listed, crowded):
    monkeypatch.setattr(spelling, "LISTED", listed)
    monkeypatch.setattr(spelling, "CROWDED", crowded)
    rng = random.Random(len(letters) + longest)
    words = {"".join(rng.choice(letters) for _ in range(rng.randrange(7, longest))) for _ in range(300)}
    for w in sorted(words):
        i, c = rng.randrange(len(w) + 1), rng.choice(letters)
        words |= {x for x in (w[:i] + c + w[i:], w[:i] + w[i + 1 :], w[:i] + c + w[i + 1 :], c + w, w + c) if len(x) >= 7}
    words |= {"z" * 5000, "z" * 2500 + "y" + "z" * 2499, "z" * 5001}
    counts = spark.createDataFrame([(w, rng.randrange(1, 99)) for w in sorted(words)], "word string, n long").repartition(3)
    assert {(r.word, r.near) for r in spelling.near_words(counts).collect()} == near_pairs(words)


def test_forms_follow_each_other(spark):
    words = {"quantity": 100_000, "quantitx": 9_000, "quantixx": 800, "quanxxxx": 7, "quantixy": 60, "other": 5, "others": 500}
    given = spark.createDataFrame([*words.items(), ("quantity", 0), (None, 4)], "word string, n long")
    got = {tuple(r) for r in spelling.variants(given).collect()}
    assert got == variants(words)
    assert ("quantixx", "quantitx", "quantity", 800, 2, 9_000) in got  # two steps to the root
    assert spelling.variants(given.limit(0)).count() == 0


def test_words_of_documents(spark):
    rng = random.Random(1)
    names = ["".join(rng.choice("abdeglnorstuàé") for _ in range(rng.randrange(5, 10))) for _ in range(150)]
    rows = [(i, " ".join(rng.choice(names) for _ in range(rng.randrange(120)))) for i in range(200)]
    rows += [(300, None), (301, ""), (302, "word-Word's ÀLongÀ ÀlongÀ x" * 3), (None, names[7] * 9), (None, names[7] * 9)]
    rows += [(303, " ".join(names * 400)), *rows[:20], (304, "Abcdefgh" * 2000 + " " + "Abcdefgh" * 2000)]
    counts, lower = Counter(), str.maketrans(spelling.UPPER, spelling.LOWER)
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= 2}
    docs = docs_of(spark, rows)
    assert {(r.word, r.n) for r in spelling.words_of(docs).collect()} == set(counts.items())
    got = spelling.variants(spelling.words_of(docs)).collect()
    assert len(got) == len(counts) and {tuple(r) for r in got} == variants(counts)
    assert spelling.variants(spelling.words_of(docs.limit(0))).count() == 0


# --- whitening -------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, n long, component int, i long, total double"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3, 4.0) for i, v in rows], VECTORS).repartition(3)


@pytest.mark.parametrize("n", [1, 2, 3, 8, 60])
def test_eigenvectors(n):
    rng = np.random.default_rng(n)
    whole = rng.standard_normal((n, n))
    basis, _ = np.linalg.qr(whole)
    spectra = [np.sort(rng.random(n))[::-1], np.ones(n), np.r_[np.full((n + 1) // 2, 5.0), np.linspace(1, 0, n // 2)], np.arange(n) * 1e-9 + 2]
    for matrix in [whole @ whole.T, np.diag(np.arange(n, 0, -1.0)), np.zeros((n, n)), *[(basis * s) @ basis.T for s in spectra]]:
        matrix = (matrix + matrix.T) / 2
        size = max(1.0, np.abs(matrix).max())
        values, vectors = whitening.leading_components(matrix, 8)
        assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][:8], atol=1e-12 * size * n)
        assert np.abs(matrix @ vectors.T - vectors.T * values).max() < 1e-11 * size
        assert np.abs(vectors @ vectors.T - np.eye(len(vectors))).max() < 1e-12


def test_sturm_counts():
    d, e = np.array([2.0, 2, 2, 2]), np.array([1.0, 0, 1])
    assert whitening.values_below(d, e, np.array([0.5, 1.5, 3.5])).tolist() == [0, 2, 4]


def test_whitening(spark):
    rng = np.random.default_rng(4)
    mixed = rng.standard_normal((300, 12)) @ rng.standard_normal((12, 12)) + 3
    good = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(mixed)]
    good += [good[0], good[0], (None, good[5][1]), (900, [1e3, *good[1][1][1:]])]
    nan = float("nan")
    bad = [(901, None), (902, []), (903, [nan, *good[1][1][1:]]), (904, [None, *good[1][1][1:]]), (905, [float("-inf")] * 12), (906, [1.0] * 5), (907, [3e38] * 12)]
    got = whitening.digest(vectors_of(spark, good + bad))
    rows = got.collect()
    x = np.floor(np.array([v for _, v in good], float) * 1024) + 100_000
    n, whole = len(x), x.astype(np.int64).astype(object)
    values, basis = np.linalg.eigh(np.cov(x.T, bias=True))
    values, basis = values[::-1], basis[:, ::-1]
    y = (x - x.mean(axis=0)) @ basis[:, :8] / np.sqrt(values[:8])
    apart = ((n * whole - whole.sum(axis=0)) ** 2).sum(axis=1)
    key = lambda i: -1 if i is None else i
    expected = sorted((key(i), k + 1, n, int(dev), abs(w[k])) for (i, _), w, dev in zip(good, y, apart, strict=True) for k in range(8))
    found = sorted((key(r.vec_id), r.component, r.n, r.deviation, abs(r.whitened)) for r in rows)
    assert [r[:4] for r in found] == [r[:4] for r in expected]
    assert np.allclose([r[4] for r in found], [r[4] for r in expected], atol=1e-8)
    assert {r.component: round(r.explained, 10) for r in rows} == {k + 1: round(v / values.sum(), 10) for k, v in enumerate(values[:8])}
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-9
    # The general form keeps all rows and columns.
    wide = whitening.whitened(vectors_of(spark, good + bad), components=3)
    assert wide.columns[:-1] == [c.split()[0] for c in VECTORS.split(", ")]
    held = {r.vec_id: r.whitened for r in wide.collect()}
    assert [held[b[0]] for b in bad] == [None] * len(bad) and len(held[7]) == 3


def test_whitening_of_little(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(5)]):
        vectors = vectors_of(spark, rows)
        got = whitening.digest(vectors)
        assert got.count() == 0 and got.columns[:4] == ["vec_id", "component", "n", "deviation"]
        assert whitening.whitened(vectors).where("whitened is not null").count() == 0
    line = whitening.digest(vectors_of(spark, [(i, [float(i), float(2 * i)]) for i in range(4)])).collect()
    assert {r.component for r in line} == {1} and abs(line[0].explained - 1) < 1e-9


def test_deviations_beyond_a_long():
    centre = whitening.Centre(10**9, np.array([10**14] * 3))
    assert centre.deviations(np.array([[100_000] * 3, [100_001, 100_000, 100_000], [104_000] * 3])) == [0, 10**18, None]


# --- toxicity --------------------------------------------------------------------------


def toxic_corpus():
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(900):
        words = plain.prose(rng, rng.randrange(20, 200)).split(" ")
        toxic = i % 6 == 0
        if toxic:
            for _ in range(rng.randrange(3, 7)):
                words[rng.randrange(len(words))] = rng.choice(("fiendish", "Rotter,", "swine", "vermin", "vermined", "verminous"))
        rows.append((i, " ".join(words)))
        if i % 5 < 3:
            labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity(spark):
    rows, labels = toxic_corpus()
    more = [(2000, None), (2001, ""), (2002, ""), (None, rows[6][1]), (2003, rows[6][1] * 300), rows[12], rows[12]]
    docs = docs_of(spark, rows + more)
    truth = spark.createDataFrame([*labels, (3, None), (None, 1), labels[0], labels[0], (99_999, 1)], "doc_id long, toxic int")
    got = toxicity.digest(docs, truth).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows + more)
    out = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 3 == 1
    assert all(r.held_out == out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    unseen = [(r.predicted, r.doc_id % 6 == 0) for r in got if r.held_out and r.doc_id is not None and r.doc_id < 900]
    assert sum(p and t for p, t in unseen) >= 0.9 * sum(t for _, t in unseen) and not any(p and not t for p, t in unseen)
    by_id = {r.doc_id: r for r in got}
    assert by_id[2000].score == by_id[2001].score < 0.5 and by_id[2003].predicted == 1
    assert by_id[None].score == by_id[6].score
    # The rows, not their files, decide; held-out labels do not.
    flipped = spark.createDataFrame([(i, 1 - t if out(i) else t) for i, t in labels] + [(99_999, 1)], "doc_id long, toxic int")
    again = {(r.doc_id, r.score) for r in toxicity.digest(docs.repartition(7), flipped).collect()}
    assert again == {(r.doc_id, r.score) for r in got}


def test_toxicity_without_positives(spark):
    docs = docs_of(spark, toxic_corpus()[0][:20])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    for labels in (none, spark.createDataFrame([(1, 0), (2, 0)], none.schema), spark.createDataFrame([(99_999, 1)], none.schema)):
        got = toxicity.digest(docs, labels)
        assert {(r.score, r.predicted) for r in got.collect()} == {(0.0, 0)}
    assert toxicity.digest(docs.limit(0), none).count() == 0
    scored = toxicity.scored(docs.withColumn("score", F.lit("x")), none)
    assert scored.columns == [*docs.columns, "score", "_score"]


def test_steps_go_back_where_the_risk_is_negative():
    """Memorised positives make the negative risk fall below zero; the learned one stays near it."""
    rng = np.random.default_rng(0)
    positives = toxicity.Bags.of([[i, 40 + i % 3] for i in range(40)])
    unlabelled = toxicity.Bags.of([[int(rng.integers(50, 60))] for _ in range(200)] + [[40 + i % 3] for i in range(20)])
    weights = toxicity.learn(positives, unlabelled, 0.3, 60, 0)
    even = lambda bags: np.full(len(bags.sizes), 1 / len(bags.sizes))
    on_positive, on_negative = toxicity.risk(positives.margins(weights), unlabelled.margins(weights), 0.3, even(positives), even(unlabelled))
    assert on_positive < 0.3 * np.log(2) and on_negative > -0.5
    assert weights[40:43].min() > weights[50:60].max()
