"""The stages of the pipeline, each against plain Python over what the one before kept."""

import os
from collections import Counter

import pytest

import corpus_pipeline
from daybook.llm import queries
from tests.llm import plain

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        out = stage(spark, docs, FOLDER)
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        after = docs.collect()
        ids, texts = [r.doc_id for r in before], [r.text for r in before]
        got = Counter(r.doc_id for r in after)
        if name == "quality rules":
            counts = {r.doc_id: plain.quality_counts(r.text) for r in before}
            assert all(c[0] >= 50 and 100 * c[4] <= 50 * c[0] for c in (counts[r.doc_id] for r in after))
            good = {r.doc_id for r in spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality = 1").collect()}
            assert all(got[i] == 1 for i, c in counts.items() if i in good and c[0] >= 50 and 100 * c[4] <= 50 * c[0])
        elif name == "n-gram Jaccard join":
            _, group = plain.near_duplicate_groups(texts)
            assert got == Counter(min(i for i, g in zip(ids, group, strict=True) if g == h) for h in set(group))
        elif name == "benchmark decontamination":
            dirty = {i for i, _ in plain.leaks(texts, items)}
            assert dirty and got == Counter(d for i, d in enumerate(ids) if i not in dirty)
        elif name == "mixing sources":
            assert set(got) <= set(ids) and max(got.values()) <= 3
        else:
            assert got == Counter(ids)
            assert sorted(Counter(r.shard for r in after).values())[-1] - min(Counter(r.shard for r in after).values()) <= 1
        assert docs.columns[: len(columns)] == columns
    assert corpus_pipeline.run(spark, FOLDER).count() == len(after)


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    import duckdb

    connection = duckdb.connect()
    for file in os.listdir(FOLDER):
        connection.sql(f"create view {file.removesuffix('.parquet')} as select * from '{FOLDER}/{file}'")
    got = queries.QUERIES[name](spark, FOLDER).toPandas()
    expected = connection.sql(queries.SQL[name]).df()[got.columns]
    key = list(got.columns)
    assert sorted(map(repr, got[key].values.tolist())) == sorted(map(repr, expected[key].values.tolist()))
