"""The operators against plain Python on documents with every awkward case."""

import hashlib
import os
import random
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from daybook.llm import (
    bits,
    common,
    components,
    decontamination,
    html_text,
    licences,
    line_dedup,
    mixing,
    ngram_join,
    pii,
    quality,
    queries,
    sharding,
    suffix_dedup,
)
from tests.llm import plain

SCHEMA = "doc_id long, text string, source string"


@pytest.fixture(scope="module")
def rows():
    return plain.documents()


@pytest.fixture(scope="module")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents")
    # Clashing names of extra columns must do no harm.
    extra = [c + " string" for c in ("root", "set_id", "stats", "size", "place", "row", "_key", "kept")]
    data = [(*r, *(["x"] * len(extra))) for r in rows]
    spark.createDataFrame(data, ", ".join([SCHEMA, *extra])).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def bag(rows):
    return Counter(tuple(r) for r in rows)


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 1), (5, 4), (7, 7), (9, 8), (8, 10), (10, 11), (None, 3)]
    found = components.components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.root for r in found.collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 8: 8, 9: 8, 10: 8, 11: 8}


def test_ngram_join(docs, rows):
    texts = [t for _, t, _ in rows]
    sets, group = plain.near_duplicate_groups(texts)
    least = {}
    for (doc_id, _, _), g in zip(rows, group, strict=True):
        if doc_id is not None:
            least[g] = min(doc_id, least.get(g, doc_id))
    expected = Counter((d, len(s), d if not s else least.get(g)) for (d, _, _), s, g in zip(rows, sets, group, strict=True))
    assert bag(ngram_join.component_ids(docs).collect()) == expected


def test_ngram_join_when_everything_is_crowded(docs, rows, monkeypatch):
    monkeypatch.setattr(ngram_join, "CROWDED", 1)
    monkeypatch.setattr(ngram_join, "TRIE", 2)
    _, group = plain.near_duplicate_groups([t for _, t, _ in rows])
    found = ngram_join.similar_groups(docs.select("doc_id", "text")).where("root is not null").select("root").distinct()
    sets = [plain.shingle_set(t) for _, t, _ in rows]
    assert found.count() == len({g for g, s in zip(group, sets, strict=True) if s})


def test_parity_bounds_the_difference(spark):
    rng, sets = np.random.default_rng(3), []
    for size, changed in ((1, 0), (5, 2), (127, 5), (128, 3), (129, 9), (146, 30), (600, 60), (1030, 40), (4000, 300)):
        grams = np.unique(rng.integers(0, 1 << 58, size, dtype=np.uint64))
        sets += [(grams, np.unique(np.concatenate([grams[changed:], rng.integers(0, 1 << 58, changed + 1, dtype=np.uint64)])))]
    given = [(ngram_join.parity(a).tolist(), ngram_join.parity(b).tolist(), len(np.setxor1d(a, b))) for a, b in sets]
    assert any(len(a) != len(b) for a, b, _ in given)
    told = spark.createDataFrame(given, "a array<long>, b array<long>, n long").select(
        ngram_join._distance(F.col("a"), F.col("b")).alias("d"), ngram_join._distance(F.col("b"), F.col("a")).alias("e"), "n"
    )
    for r in told.collect():
        assert r.d == r.e and r.n / 2 < r.d <= r.n


def test_copies_that_are_too_far_apart_are_not_compared(spark, monkeypatch):
    rng, texts, compared, links = random.Random(5), [], [], ngram_join._links
    base = [f"{w}{i}" for i, w in enumerate(plain.prose(rng, 160).split(" "))]
    for k in range(150):
        words = list(base)
        for at in rng.sample(range(4, 156), 3):
            words[at] = f"other{k}x{at}"
        texts.append(" ".join(words))
    monkeypatch.setattr(ngram_join, "_links", lambda pairs, *more: compared.append(pairs.count()) or links(pairs, *more))
    found = ngram_join.component_ids(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    _, group = plain.near_duplicate_groups(texts)
    assert {r.doc_id: r.component_id for r in found} == dict(enumerate(group))
    # Each one meets all others: 11175 pairs.
    assert sum(compared) < 1500


def test_one_of_each_group(docs, rows):
    sets, group = plain.near_duplicate_groups([t for _, t, _ in rows])
    best = {}
    for (doc_id, text, _), g, s in zip(rows, group, sets, strict=True):
        if s and doc_id is not None:
            best[g] = min((doc_id, text), best.get(g, (doc_id, text)), key=lambda x: x[0])
    expected = Counter(
        (d, t) for (d, t, _), g, s in zip(rows, group, sets, strict=True) if not s or best.get(g, (d, t))[0] == d
    )
    kept = ngram_join.one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert bag(kept.select("doc_id", "text").collect()) == expected


def test_stage_keeps_one_row_of_each_group(spark, rows):
    text = "seven words are in this short text"
    many = rows + [(70_000, text, "s1")] * 40 + [(None, text + " again", "s1")] * 40 + [(None, text[::-1], None)] * 40
    sets, group = plain.near_duplicate_groups([t for _, t, _ in many])
    found = corpus_pipeline.keep_one_of_each_group(spark, spark.createDataFrame(many, SCHEMA).repartition(3), "")
    best = {}
    for (doc_id, _, _), g, s in zip(many, group, sets, strict=True):
        if s:
            best[g] = min((doc_id is None, doc_id or 0), best.get(g, (True, 10**9)))
    alone = Counter(d for (d, _, _), s in zip(many, sets, strict=True) if not s)
    assert found.columns == ["doc_id", "text", "source"]
    assert Counter(r.doc_id for r in found.collect()) == alone + Counter(None if none else d for none, d in best.values())


def test_trie_shares_paths():
    rng = np.random.default_rng(3)
    probe = np.sort(rng.choice(60, 30, replace=False))
    sets = [np.sort(rng.choice(60, rng.integers(1, 40), replace=False)) for _ in range(200)] + [probe, probe[1:]]
    sets.sort(key=lambda s: s.astype(">i8").tobytes())
    got = ngram_join.similar_in_trie(probe, sets, 50)
    plain_sets = [set(s.tolist()) for s in sets]
    both = [len(s & set(probe.tolist())) for s in plain_sets]
    assert got == [100 * b >= 50 * (30 + len(s) - b) for b, s in zip(both, plain_sets, strict=True)]


@pytest.mark.parametrize("crowded", [50_000, 1])
def test_suffix_dedup(docs, rows, monkeypatch, crowded):
    monkeypatch.setattr(suffix_dedup, "CROWDED", crowded)
    expected = Counter()
    for (doc_id, text, _), (left, n, runs) in zip(rows, plain.repeated_bytes([t for _, t, _ in rows]), strict=True):
        expected[doc_id, len((text or "").encode()), n, runs, hashlib.sha256(left).hexdigest()] += 1
    assert bag(suffix_dedup.digest(docs).collect()) == expected


@pytest.mark.parametrize("crowded", [50_000, 1])
def test_suffix_dedup_when_other_places_pass_the_table(spark, monkeypatch, crowded):
    monkeypatch.setattr(suffix_dedup, "BIT_SLOTS", 32)
    monkeypatch.setattr(suffix_dedup, "CROWDED", crowded)
    rng = plain.random.Random(7)
    shared, edited = plain.prose(rng, 150), plain.prose(rng, 150)
    half = len(edited) // 2
    texts = [f"{plain.prose(rng, 40)}\n{shared}\n{plain.prose(rng, 40)}" for _ in range(12)]
    texts += [edited, edited + " end", "start " + edited, edited[:half] + "#" + edited[half + 1 :]] + [shared[40:]] * 2
    docs = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], SCHEMA).repartition(4)
    got = {r.doc_id: (r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.digest(docs).collect()}
    expected = plain.repeated_bytes(texts)
    assert got == {i: (n, runs, hashlib.sha256(left).hexdigest()) for i, (left, n, runs) in enumerate(expected)}


def test_suffix_contexts_are_cut_only_where_wanted(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BIT_SLOTS", 32)  # full, as at size: a bit table cannot tell places apart
    rng = plain.random.Random(8)
    texts = [plain.prose(rng, 200) + "\u00e9" for _ in range(8)]
    places = [(0, 0), (0, 300), (3, 70), (5, len(texts[5].encode()) - suffix_dedup.LEAD)]
    docs = spark.createDataFrame([(t,) for t in texts * 2], "text string").repartition(3)
    docs = docs.withColumn("text_key", F.xxhash64("text"))
    keys = {r.text: r.text_key for r in docs.collect()}
    wanted = spark.createDataFrame(
        [(7, k, keys[texts[i]], at, 4) for k, (i, at) in enumerate(places)], "lead long, context long, text_key long, at int, kinds long"
    )
    got = {r.context: (bytes(r.bytes), r.left, r.right) for r in suffix_dedup._context_bytes(docs, wanted).collect()}
    expected = {}
    for k, (i, at) in enumerate(places):
        data = texts[i].encode()
        before, after = data[max(0, at - suffix_dedup.REACH) : at], data[at : at + suffix_dedup.LENGTH]
        padded = before.rjust(suffix_dedup.REACH, b"\0") + after.ljust(suffix_dedup.LENGTH, b"\0")
        expected[k] = padded, len(before), len(after)
    assert got == expected
    assert suffix_dedup._context_bytes(docs, wanted).count() == len(places)


def test_many_contexts_of_one_lead_are_compared_in_little_memory():
    n = 4000
    rng = np.random.default_rng(5)
    body = rng.integers(0, 256, (n, suffix_dedup.CONTEXT), dtype=np.uint8)
    body[1, 10:300] = body[0, 10:300]
    whole = np.full(n, suffix_dedup.REACH), np.full(n, suffix_dedup.LENGTH)
    parts = [(np.full(n, 9, np.uint64), np.arange(n), body, *whole)]
    tracemalloc.start()
    out = suffix_dedup._compared(parts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2000 * n
    held = np.unpackbits(np.frombuffer(out.column(2)[0].as_py(), np.uint8))
    # Strings that lie in the equal bytes 10 to 300 begin at 10 to 100.
    assert out.column(1).to_pylist() == [0, 1]
    assert np.flatnonzero(held).tolist() == list(range(suffix_dedup.REACH - 100, suffix_dedup.REACH - 10 + 1))


def test_fuzzy_lines(docs, rows):
    gone = defaultdict(list)
    for i, place in sorted(plain.removed_lines(rows)):
        gone[i].append(place)
    lines = [sum(bool(plain.WORD.search(x)) for x in (t or "").split("\n")) for _, t, _ in rows]
    got = line_dedup.digest(docs).collect()
    assert Counter((r.doc_id, r.n_lines) for r in got) == Counter((d, n) for (d, _, _), n in zip(rows, lines, strict=True))
    # Which of several equal rows loses its lines is open; how many lines go is not.
    assert sum(r.n_removed for r in got) == sum(map(len, gone.values()))
    cleaned = line_dedup.without_fuzzy_lines(docs)
    assert cleaned.columns == docs.columns and cleaned.count() == len(rows)
    left = [x for r in cleaned.collect() for x in (r.text or "").split("\n") if plain.WORD.search(x)]
    assert len(left) == sum(lines) - sum(map(len, gone.values()))


def test_fuzzy_lines_by_all_their_characters(spark):
    rng = plain.random.Random(11)
    lines = ["https://example.com/archive/2021/05/first-article.html", "https://example.com/archive/about", "short", "Short", "shor"]
    lines += ["data:image/png;base64," + "".join(rng.choice("ABCDEFabcdef0123456789+/") for _ in range(n)) for n in (80, 80, 200)]
    han = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(120))
    lines += [han[:60], han[:20] + han[80:120], han[:60] + "\u3002", "\U0001f600" * 3 + han[60:], "\U0001f600" * 4 + han[60:]]
    for n in (8, 15, 25, 40, 60):
        words = plain.prose(rng, n).split(" ")
        lines += [" ".join(words), " ".join([*words[: n // 2], "other", *words[n // 2 + 1 :]])]

    def whole(line, width=8):
        return {line.lower()[k : k + width] for k in range(max(1, len(line) - width + 1))}

    sets = [whole(x) for x in lines]
    alike = [(i, j) for i in range(len(lines)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    expected = {i for i, root in enumerate(plain.groups(len(lines), alike)) if root != i}
    assert not expected & {0, 1, 4, 5, 6, 7, 8, 9} and {3, 10, 20, 22} <= expected
    docs = spark.createDataFrame([(i, t, None) for i, t in enumerate(lines)], SCHEMA)
    assert {r.doc_id for r in line_dedup.digest(docs).collect() if r.n_removed} == expected


def test_fuzzy_lines_store_no_shingles(spark):
    """Lines that meet under a long passage: what is written stays near the text, eight bytes a character were not."""
    from daybook.llm import common

    rng = plain.random.Random(3)
    made = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    passage, paths = made(700), []
    lines = [passage + made(300) for _ in range(1000)]
    lines[700] = lines[3][:-20] + made(20)
    given = spark.createDataFrame([(i, t, None) for i, t in enumerate(lines)], SCHEMA)
    with common.noted(paths):
        gone = {r.doc_id for r in line_dedup.digest(given).collect() if r.n_removed}
    assert gone == {700}
    folders = [p.removeprefix("file:") for p in paths]
    stored = sum(os.path.getsize(os.path.join(at, f)) for p in folders for at, _, files in os.walk(p) for f in files)
    assert 0 < stored < 3 * sum(map(len, lines))


def test_fuzzy_lines_leave_one_table_and_move_wanted_lines_only(spark, monkeypatch):
    rng = plain.random.Random(4)
    lines = [plain.prose(rng, 40) for _ in range(300)]
    lines += [x + " end" for x in lines[:30]] + [f"start {x} end" for x in lines[:10]]
    path = str(common.work_folder(spark, "given"))
    spark.createDataFrame([(t,) for t in lines], "line string").write.parquet(path)
    given, moved = spark.read.parquet(path), []

    def looked_at(rows, key, wanted, name):
        found = bits.thinned(rows, key, wanted, name)
        moved.append((found.count(), wanted.distinct().count()))
        return found

    monkeypatch.setattr(line_dedup, "thinned", looked_at)
    folder = os.path.dirname(os.path.dirname(path.removeprefix("file:")))
    before, paths = set(os.listdir(folder)), []
    with common.noted(paths):
        roots = line_dedup.similar_lines(given)
    assert roots.count() == 70 and roots.select("root").distinct().count() == 30
    # All of these lines are a few slots of the table, so that lines that are not wanted do not pass.
    assert moved and all(n <= wanted + 1 for n, wanted in moved)
    # Of what is written on the way the result alone is left.
    assert [os.path.basename(os.path.dirname(p)) for p in paths] == list(set(os.listdir(folder)) - before)


def test_thinned_keeps_all_wanted_rows(spark):
    rows = spark.range(1000).select(F.xxhash64("id").alias("k"), F.lit(1).alias("_table")).union(spark.sql("select cast(null as bigint), 1"))
    wanted = rows.where("k % 7 = 0 or k is null")
    kept = bits.thinned(rows, F.col("k"), wanted, "k")
    assert kept.columns == ["k", "_table"]
    assert wanted.where("k is not null").exceptAll(kept).count() == 0 and kept.count() <= wanted.count() + 5
    assert bits.thinned(rows, F.col("k"), wanted.limit(0), "k").count() == 0


def test_fuzzy_lines_of_crowded_bands(docs, rows, monkeypatch):
    monkeypatch.setattr(line_dedup, "CROWDED", 0)
    assert sum(r.n_removed for r in line_dedup.digest(docs).collect()) == len(plain.removed_lines(rows))


def test_decontamination(spark, docs, rows):
    texts = [t for _, t, _ in rows]
    rng = plain.random.Random(5)
    long = texts[30] if len(texts[30] or "") > 400 else next(t for t in texts if t and len(t) > 1000)
    items = [texts[45], "one", None, "", "a b c d", plain.prose(rng, 30), " ".join(long.split()[10:40]), long.upper()]
    benchmark = spark.createDataFrame(list(enumerate([*items, items[0]])), "item_id long, text string")
    expected = plain.leaks(texts, [*items, items[0]])
    got = decontamination.leaks(docs, benchmark).collect()
    assert Counter((r.doc_id, r.item_id, round(r.similarity, 9)) for r in got) == Counter(
        (rows[i][0], j, round(s, 9)) for (i, j), s in expected.items()
    )
    clean = decontamination.clean_documents(docs, benchmark)
    dirty = {i for i, _ in expected}
    assert clean.columns == docs.columns
    assert bag(clean.select("doc_id", "text").collect()) == Counter(r[:2] for i, r in enumerate(rows) if i not in dirty)
    assert decontamination.clean_documents(docs, benchmark.limit(0)).count() == len(rows)


def test_simhash_radius_is_covered():
    assert decontamination.RADIUS == 23 and len(decontamination._NEAR) == 1 + 8 + 28


def test_quality_counts(spark, docs, rows):
    got = quality.judged(docs, spark.createDataFrame([], "doc_id long, quality int")).collect()
    expected = Counter()
    for doc_id, text, _ in rows:
        c = plain.quality_counts(text)
        failed = c[0] < 50 or 100 * c[4] > 50 * c[0]
        expected[doc_id, *c, failed, not failed] += 1
    assert bag(got) == expected


def test_quality_rules_learn(spark):
    rng = plain.random.Random(2)
    data, labels = [], []
    for i in range(300):
        words = plain.prose(rng, rng.randrange(60, 200)).split(" ")
        if i % 5 == 0:
            words = [w + rng.choice(("###", "%%%")) if rng.random() < 0.7 else w for w in words]
        data.append((i, " ".join(words), "s"))
        labels.append((i, 0 if i % 5 == 0 else 1) if i < 240 else (None, 1))
    docs = spark.createDataFrame(data, SCHEMA)
    truth = spark.createDataFrame([*labels, (3, None)], "doc_id long, quality int")
    kept = {r.doc_id for r in quality.kept_documents(docs, truth).collect()}
    # Held out: the last sixty were never seen.
    assert kept == {i for i in range(300) if i % 5}
    assert quality.learn_rules(np.empty((0, len(quality.FEATURES))), np.empty(0, bool)) == []


def test_mixing(spark, docs, rows):
    got = mixing.taken_words(docs).collect()
    size = lambda t: len(plain.WORD.findall(t or ""))
    totals = Counter()
    for _, text, source in rows:
        totals[source] += size(text)
    order = sorted((s for s in totals if s is not None)) + [None] * (None in totals)
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    bounded, target = set(), {}
    while True:
        rest = sum(totals.values()) - sum(3 * totals[s] for s in bounded)
        level = rest / max(1, sum(weight[s] for s in order if s not in bounded))
        target = {s: 3 * totals[s] if s in bounded else level * weight[s] for s in order}
        over = {s for s in order if s not in bounded and target[s] > 3 * totals[s]}
        if not over:
            break
        bounded |= over
    by_size = {(totals[s], round(target[s], 6)) for s in order}
    assert {(r.source_size, round(r.target, 6)) for r in got} == by_size
    assert Counter((r.doc_id, r.size) for r in got) == Counter((d, size(t)) for d, t, _ in rows)
    assert all(r.taken in {k * r.size for k in range(4)} for r in got)
    largest, taken = defaultdict(int), Counter()
    for r in got:
        largest[r.source_size, round(r.target, 6)] = max(largest[r.source_size, round(r.target, 6)], r.size)
        taken[r.source_size, round(r.target, 6)] += r.taken
    assert all(abs(taken[k] - k[1]) <= 2 * largest[k] for k in by_size)
    again = mixing.taken_words(docs.repartition(5)).collect()
    assert bag(got) == bag(again)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert sum(size(r.text) for r in mixed.select("text").collect()) == sum(r.taken for r in got)


@pytest.mark.parametrize("block_rows", [10_000, 5])
def test_sharding(docs, rows, monkeypatch, block_rows):
    monkeypatch.setattr(sharding, "BLOCK_ROWS", block_rows)
    dealt = sharding.shuffled_shards(docs.withColumn("crc", sharding.crc32_of_text(F.col("text"))), 8, seed=4)
    got = dealt.collect()
    assert bag((r.doc_id, r.text) for r in got) == bag(r[:2] for r in rows)
    assert all(r.crc == zlib.crc32((r.text or "").encode()) for r in got)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert sorted(map(len, slots.values())) == sorted(sharding.shard_sizes(len(rows), 8).tolist())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert bag((r.doc_id, r.shard, r.slot) for r in dealt.collect()) == bag((r.doc_id, r.shard, r.slot) for r in got)


def test_shards_are_uniform():
    counts, sizes = np.array([3, 0, 5, 12]), sharding.shard_sizes(20, 3)
    draws = np.array([sharding.communication_matrix(counts, sizes, seed) for seed in range(2000)])
    assert (draws.sum(axis=2) == counts).all() and (draws.sum(axis=1) == sizes).all()
    assert np.allclose(draws.mean(axis=0), np.outer(counts, sizes) / 20, atol=0.15)


PERSONAL = [
    "a@b.c_d@e.f x@y.z..q@r.s.", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.4 1.2.3.4000",
    "4111 1111 1111 1111 4111-1111-1111-1112 +12345678 +1 (226) 555-1909. +49 1", "é 4111111111111111é",
    "x" * 50_000, "9" * 3000, "a@" + "b." * 5000 + "c", "+" + "1 " * 400, None, "",
]


def test_personal_data(spark):
    seeds = [f"ring phone: +1 555 01{i:02d} 999{i % 10} now" for i in range(60)]
    unseen = [f"call phone: 555-01{i:02d}-999 now" for i in range(12)]
    texts = PERSONAL + seeds + unseen
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r for r in pii.digest(docs).collect()}
    for i, text in enumerate(texts):
        base = plain.personal(text)
        kinds = Counter(x.split(":")[0] for x in base)
        r = got[i]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(kinds[k] for k in pii.KINDS)
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        # Contexts of known numbers find the ones without a country code.
        assert r.spans == ("phone:12:24" if text in unseen else ",".join(base))
    masked = {r.doc_id: r.text for r in pii.masked(docs).collect()}
    assert masked[len(texts) - 1] == "call phone: ************ now" and masked[8] is None


def test_identifiers_in_sure_contexts(spark):
    rng = plain.random.Random(12)
    words = lambda n: plain.prose(rng, n)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    texts = [f"{words(3)} mobile number +44 20 {digits(4)} {digits(4)} please {words(2)}" for _ in range(30)]
    texts += [f"{words(3)} write to {words(1)}{i}@example.org today" for i in range(20)]
    texts += [f"{words(2)} server 10.{i}.0.{i} down {words(2)}" for i in range(20)]
    texts += [f"{words(2)} charge 4111 1111 1111 1111 or {words(1)} and visa {digits(3)}" for _ in range(3)]
    unseen = [
        "the mobile number (212) 555-0100 please", "a mobile number 020 7946 0958, please", "mobile number [020] 7946/0958",
        "just write to jo at example dot com today", "write to jo.b (at) mail [dot] example (dot) org.", "server fe80::1:2 down",
        "the number of 12 34 5 things", "mobile number 12", "+44 20 7946 please", "please 3782 822463 10005", "x (555-0100) please",
    ]
    texts += [*unseen, *unseen, None, "", "1 2 3 4 5 6 7 8 please", "mobile number +44 20 7946 0958 111111111111111111 please"]
    texts += [f"{words(rng.randrange(4))} {rng.choice(unseen)} {words(2)}\n{rng.choice(unseen)}" for _ in range(60)]
    texts += [t for t in PERSONAL if t and len(t) < 2000]
    found = pii.digest(spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], SCHEMA).repartition(3)).collect()
    got = {r.doc_id: set(filter(None, r.spans.split(","))) - set(plain.personal(texts[r.doc_id])) for r in found}
    expected = plain.found_personal(texts)
    assert sum(map(len, expected)) > 60
    for i, spans in enumerate(expected):
        assert {tuple(map(int, x.split(":")[1:])) for x in got[i]} == set(spans), texts[i]
        assert all(x.split(":")[0] in spans[tuple(map(int, x.split(":")[1:]))] for x in got[i])
    first = len(texts) - texts[::-1].index(None) - 1 - 2 * len(unseen)
    assert got[first] == {"phone:18:32"} and got[first + 3] == {"email:14:35"}


def test_personal_data_of_a_text_of_numbers(spark):
    many = [" ".join(f"x {10**6 + i}" for i in range(100_000)), "1 " * 100_000 + "2a", "a@b.c " * 50_000]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(many)], SCHEMA)
    begun = time.monotonic()
    got = {r.doc_id: r for r in pii.digest(docs).collect()}
    assert time.monotonic() - begun < 90
    for i, text in enumerate(many):
        assert got[i].spans == ",".join(plain.personal(text))


def test_patterns_are_found_through_long_chains(spark):
    edges, known, sizes = [("p0", f"s{i}", "phone") for i in range(3750)], [], (750, 150, 30, 6, 1)
    for k, n in enumerate(sizes):
        new = [f"x{k}_{i}" for i in range(n)]
        edges += [(f"p{k}", v, None) for v in known + new]
        known = new
    edges += [("none", f"x0_{i}", None) for i in range(4)] + [("half", f"{c}0_{i}", None) for c in "xy" for i in range(6)]
    found = pii.found_patterns(spark.createDataFrame(edges, "left string, value string, seed string"))
    assert sorted((r["left"], r.kind) for r in found.collect()) == [(f"p{k}", "phone") for k in range(len(sizes))]


PAGES = [
    (
        "<html><head><title>T</title><script>x='</p>'</script></head><body><nav><a href=/>The home of it</a></nav>"
        "<div class='ad'>The best of all the offers that you will see in the shop of the town is here now.</div>"
        "<article><h1>A head</h1><p>The day was long and the way to the town was not as it had been for all of them.</p>"
        "<p>Short &amp; sweet.<p>And so on  it\n went, to the end of the road and of the day that was so long for us."
        "<div class=comments><p>The comment that I have to make is that it was not at all as I would have it.</p></div>"
        "</article><footer>&copy; the owner of it all</footer></body></html>",
        "A head\nThe day was long and the way to the town was not as it had been for all of them.\nShort & sweet.\n"
        "And so on it went, to the end of the road and of the day that was so long for us.",
    ),
    (
        "<body><div>Menu</div><div><p>This is the text of the page, and it is as long as it has to be to be seen as such.</p>"
        "<p>Yes.</p><p>There is more of it in the second one, which is just as long as the first one was, or so.</p></div>"
        "<ul><li><a href=x>one link that is here</a></li><li><a href=y>one more of the links</a></li></ul>",
        None,
    ),
    (None, ""), ("", ""), ("<p", ""), ("<script>never closed", ""), ("<!-- never closed", ""),
]


def test_main_text(spark):
    pages = spark.createDataFrame([(i, f"u{i}", h, "x") for i, (h, _) in enumerate(PAGES)], "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in html_text.extracted(pages).collect()}
    for i, (_, expected) in enumerate(PAGES):
        if expected is not None:
            assert got[i].text == expected
        assert got[i].n_chars == len(got[i].text)
    assert "second one" in got[1].text and "Yes." in got[1].text and "link" not in got[1].text


_TEXT = "The first paragraph of the article is long enough to be taken as text that is read by a person."
_REPLY = "I think that this is the reply of a reader and that it is as long as a text has to be to be one."
_HAN = "\u8fd9\u662f\u4e00\u4e2a\u5173\u4e8e\u6570\u636e\u5904\u7406\u7684\u957f\u6bb5\u843d" * 3


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<div class='layout has-sidebar'><div><article><p>{_TEXT}</article></div></div>", _TEXT),
        (f"<div class='content no-sidebar'><p>{_TEXT}</div>", _TEXT),
        (f"<div class='market-share header-fixed'><p>{_TEXT}</div>", _TEXT),
        (f"<form id='page'><div class='widget'><main><p>{_TEXT}</main></div></form>", _TEXT),
        (f"<article><header class='entry-header'><h1>A title</h1></header><p>{_TEXT}</article>", f"A title\n{_TEXT}"),
        (f"<article><div title='a hidden gem'><p>{_TEXT}</div></article>", _TEXT),
        (f"<article><p>{_TEXT}<div hidden><p>{_REPLY}</div></article>", _TEXT),
        (f"<div><p>{_TEXT}</div><div HIDDEN><p>{_REPLY}</div>", _TEXT),
        (f"<div><p>{_TEXT}<p>{_TEXT}</div><article><a href=x>A teaser.</a></article>", f"{_TEXT}\n{_TEXT}"),
        (f"<body><p>{_HAN}</p><ul><li><a href=x>{_HAN}</a></ul>", _HAN),
        (f"<article><p>{_TEXT}</article><ol class='comment-list'><li><article><p>{_REPLY}</article></ol>", _TEXT),
        (f"<div class='site-header'><p>{_REPLY}</div><p>{_TEXT}</p><div class='share-buttons'><p>{_REPLY}</div>", _TEXT),
        (f"<nav>Unclosed<article><p>{_TEXT}</article>", _TEXT),
        (f"<p>{_TEXT}</p>" * 20_000, "\n".join([_TEXT] * 20_000)),
    ],
)
def test_main_text_of_common_pages(page, text):
    assert html_text.main_text(page) == text


def test_licences(spark):
    files = [
        ("LICENSE", "Released under the MIT License."), ("a.py", "x"), ("lib/gpl/COPYING", "This work is licensed under the GNU General Public License, version 3."),
        ("lib/gpl/deep/er/c.py", "z"), ("lib/gpl/d.py", "code\nLicensed under the Apache License, Version 2.0.\nmore"),
        (None, "q"), ("lib/e.py", None), ("lib/gpl2/f.py", "a license for nothing at all"), ("a.py", "x"),
    ]
    got = licences.scanned(spark.createDataFrame(files, "path string, text string")).collect()
    expected = {
        "LICENSE": ("MIT", "header"), "a.py": ("MIT", "inherited"), "lib/gpl/COPYING": ("GPL-3.0", "header"),
        "lib/gpl/deep/er/c.py": ("GPL-3.0", "inherited"), "lib/gpl/d.py": ("Apache-2.0", "header"), None: (None, None),
        "lib/e.py": ("MIT", "inherited"), "lib/gpl2/f.py": ("MIT", "inherited"),
    }
    assert len(got) == len(files)
    assert all(expected[r.path] == (r.licence, r.found) for r in got)


def test_empty_tables(spark, none):
    labels, items = spark.createDataFrame([], "doc_id long, quality int"), spark.createDataFrame([], "item_id long, text string")
    for out in (
        ngram_join.component_ids(none), ngram_join.one_of_each_group(none), suffix_dedup.digest(none),
        line_dedup.digest(none), decontamination.leaks(none, items), quality.kept_documents(none, labels),
        mixing.taken_words(none), mixing.mix(none), sharding.shuffled_shards(none, 8), pii.digest(none),
    ):
        assert out.count() == 0


@pytest.mark.parametrize("given", ["repartitioned", "joined"])
def test_rows_keep_their_numbers(spark, docs, given):
    """Rows that no plain scan numbers alike in two jobs: results are those of the written table."""
    if given == "repartitioned":
        again = docs.repartition(7)
    else:
        again = docs.join(docs.select(F.col("doc_id").alias("other")).distinct(), F.col("doc_id").eqNullSafe(F.col("other"))).drop("other")
    assert bag(line_dedup.digest(again).select("doc_id", "n_lines").collect()) == bag(line_dedup.digest(docs).select("doc_id", "n_lines").collect())
    with_own = docs.select("doc_id", F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("path"), "text", F.lit(1).alias("own"))
    licences_of = lambda rows: bag(licences.scanned(rows).collect())
    shuffled = with_own.repartition(7) if given == "repartitioned" else with_own.join(with_own.select(F.col("doc_id").alias("other")).distinct(), F.col("doc_id").eqNullSafe(F.col("other"))).drop("other")
    assert licences_of(shuffled) == licences_of(with_own)


def test_shards_do_not_depend_on_how_files_are_split(spark, docs):
    dealt = sharding.shuffled_shards(docs.select("doc_id", "text").repartition(9), 3, seed=1)
    first = bag((r.doc_id, r.text, r.shard, r.slot) for r in dealt.collect())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        again = dealt.select("*")
        assert bag((r.doc_id, r.text, r.shard, r.slot) for r in again.collect()) == first
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_scratch_is_released(spark):
    from daybook.llm import common

    paths, left = [], []
    with common.noted(paths):
        first = common.written(spark.range(5), "first")
        second = common.written(first.where("id > 1"), "second")
        with common.noted(left):
            third = common.written(second.limit(1), "third")
    assert len(paths) == 2 and len(left) == 1
    common.release(paths, second)
    assert len(paths) == 1 and second.count() == 3 and third.count() == 1
    common.release(paths, third)
    assert paths == [] and third.count() == 1
    common.release(left, third)
    assert len(left) == 1 and third.count() == 1


def test_licence_scan_of_little(spark):
    files = spark.createDataFrame(
        [(1, None, None), (2, "a/LICENSE", None), (3, "a/b/c", ""), (4, "d", "word " * 200_000), (4, "d", "word " * 200_000)],
        "own long, path string, text string",
    ).withColumns({c: F.lit("x") for c in ("row", "place", "near", "kept", "passages", "passage", "directory")})
    got = licences.scanned(files)
    assert got.columns == [c for c in files.columns if c != "text"] + ["licence", "cosine", "found", "licence_dir"]
    assert [r.licence for r in got.collect()] == [None] * 5
    assert licences.scanned(files.limit(0)).count() == 0


def test_licences_of_the_query_are_inherited(spark, tmp_path):
    """Rows of the registered query against a walk from every path up to the root."""
    gpl, mit = "This work is licensed under the GNU General Public License, version 3.", "Released under the MIT License."
    texts = {1: f"tree\n{gpl}", 2: "a\nb", 1001: f"1\n2\n3\n4\n{mit}", 1002: "c", 2001: "x\n" * 20 + mit, 2002: None, 3001: ""}
    given = [(i, text, "en", "s1", 0) for i, text in texts.items()] + [(5, "alone", "de", "s1", 0), (6, "alone", None, None, 0)]
    spark.createDataFrame(given, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in queries.QUERIES["op1_licence_scan"](spark, str(tmp_path)).collect()}
    assert len(got) == len(given)
    own = {r.path: r.licence for r in got.values() if r.found == "header"}
    assert own == {"s1/en/LICENSE.1": "GPL-3.0", "s1/en/1/LICENSE.1001": "MIT", "s1/en/2/2001": "MIT"}
    owners = {path.rpartition("/")[0]: licence for path, licence in own.items() if "LICENSE" in path}
    for r in got.values():
        if r.path not in own:
            above = r.path.rpartition("/")[0]
            while above not in owners and above:
                above = above.rpartition("/")[0]
            assert (r.licence, r.licence_dir) == (owners.get(above), above if above in owners else None)
            assert r.found == ("inherited" if above in owners else None)
    assert {i for i, r in got.items() if r.found == "inherited"} == {2, 1002, 2002, 3001}
    assert got[1002].licence == "MIT" and got[2].licence == "GPL-3.0"
