from datetime import date, datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from daybook.operators import merge
from daybook.operators.merge import insert_or_patch, latest_per_key, put_columns, replace_rows

T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
INFO = "row_key string, info struct<status:string,name:string,at:timestamp>"


def as_dict(frame):
    rows = frame.collect()
    found = {r["row_key"]: r.asDict(recursive=True) for r in rows}
    assert len(found) == len(rows), "a key occurs twice"
    return found


def test_key_cases(spark):
    target = spark.createDataFrame(
        [
            ("target only", ("a", "t", T1)),
            ("unchanged", ("a", "t", T1)),
            ("changed", ("a", "t", T1)),
            ("old blank", ("", "t", None)),
            ("old absent", (None, "t", T1)),
            ("blanked", ("a", "t", T1)),
        ],
        INFO,
    )
    batch = spark.createDataFrame(
        [
            ("unchanged", ("a", "b", T1)),
            ("changed", ("b", "b", T2)),
            ("old blank", ("b", "b", T2)),
            ("old absent", ("b", "b", T2)),
            ("blanked", ("", "b", None)),
            ("batch only", ("b", "b", T2)),
        ],
        INFO,
    )
    merged = insert_or_patch(target, batch, "info", ["status", "at"])
    got = {k: (*r["info"].values(),) for k, r in as_dict(merged).items()}
    assert got == {
        "target only": ("a", "t", T1),
        "unchanged": ("a", "t", T1),
        "changed": ("b", "t", T2),
        "old blank": ("", "t", None),
        "old absent": (None, "t", T2),
        "blanked": ("", "t", None),
        "batch only": ("b", "b", T2),
    }
    again = insert_or_patch(merged, batch, "info", ["status", "at"])
    assert as_dict(again) == as_dict(merged), "merging a batch twice changes nothing"
    filled = as_dict(insert_or_patch(target, batch, "info", ["status", "at"], fill=["status", "at"]))
    assert filled["old absent"]["info"]["status"] == "b"
    assert filled["old blank"]["info"] == {"status": "", "name": "t", "at": T2}


CELL = st.sampled_from([None, "", "a", "b"])
SIDE = st.dictionaries(st.sampled_from("klmn"), st.tuples(CELL, CELL), max_size=4)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(SIDE, SIDE)
def test_patch_rule_against_a_row_by_row_model(spark, target, batch):
    ddl = "row_key string, info struct<p:string,f:string>"
    expected = dict(target)
    for key, (p, f) in batch.items():
        if key not in target:
            expected[key] = (p, f)
            continue
        old_p, old_f = target[key]
        expected[key] = (p if old_p not in (None, "") and old_p != p else old_p, f if old_f != "" else old_f)
    merged = insert_or_patch(
        spark.createDataFrame(list(target.items()), ddl),
        spark.createDataFrame(list(batch.items()), ddl),
        "info",
        ["p", "f"],
        fill=["f"],
    )
    assert {k: tuple(r["info"].values()) for k, r in as_dict(merged).items()} == expected


def test_families_are_tested_apart(spark):
    ddl = "row_key string, info struct<a:string>, register struct<b:string>"
    target = spark.createDataFrame([("both", ("1",), ("2",)), ("register only", None, ("2",))], ddl)
    users = spark.createDataFrame(
        [("register only", ("9",)), ("both", ("8",)), ("user only", ("7",))], "row_key string, info struct<a:string>"
    )
    got = as_dict(insert_or_patch(target, users, "info", ["a"]))
    assert got == {
        "both": {"row_key": "both", "info": {"a": "8"}, "register": {"b": "2"}},
        "register only": {"row_key": "register only", "info": {"a": "9"}, "register": {"b": "2"}},
        "user only": {"row_key": "user only", "info": {"a": "7"}, "register": None},
    }


def test_companions_are_inserted_and_never_patched(spark):
    ddl = "row_key string, info struct<a:string>, address struct<c:string>"
    target = spark.createDataFrame([("old", ("1",), ("x",))], ddl)
    batch = spark.createDataFrame([("old", ("2",), ("y",)), ("new", ("2",), ("y",))], ddl)
    got = as_dict(insert_or_patch(target, batch, "info", ["a"], companions=["address"]))
    assert (got["old"]["info"]["a"], got["old"]["address"]["c"]) == ("2", "x")
    assert (got["new"]["info"]["a"], got["new"]["address"]["c"]) == ("2", "y")


def test_status_log(spark):
    ddl = "row_key string, info struct<s:string>, log map<date,string>"
    days = [date(2024, 1, d) for d in (1, 2)]
    target = spark.createDataFrame(
        [("same", ("0",), {days[0]: "0"}), ("moved", ("0",), {days[0]: "0"}), ("twice", ("0",), {days[1]: "0"})], ddl
    )
    batch = spark.createDataFrame(
        [("same", ("0",)), ("moved", ("1",)), ("twice", ("1",)), ("new", ("5",))], "row_key string, info struct<s:string>"
    )
    got = as_dict(insert_or_patch(target, batch, "info", ["s"], history=("log", "s", "2024-01-02")))
    assert {k: r["log"] for k, r in got.items()} == {
        "same": {days[0]: "0"},
        "moved": {days[0]: "0", days[1]: "1"},
        "twice": {days[1]: "1"},
        "new": {days[1]: "5"},
    }


def test_replace_rows(spark):
    ddl = "row_key string, v string"
    target = spark.createDataFrame([("a", "old"), ("b", "old")], ddl)
    batch = spark.createDataFrame([("b", "new"), ("c", "new")], ddl)
    assert sorted(map(tuple, replace_rows(target, batch).collect())) == [("a", "old"), ("b", "new"), ("c", "new")]


def test_put_columns(spark):
    ddl = "row_key string, info struct<a:string>, cert struct<s:string,u:string>"
    target = spark.createDataFrame([("a", ("1",), ("x", "u")), ("b", ("1",), None)], ddl)
    batch = spark.createDataFrame([("a", ("y",)), ("c", (None,))], "row_key string, cert struct<s:string>")
    got = as_dict(put_columns(target, batch, "cert"))
    assert got["a"]["cert"] == {"s": "y", "u": "u"}
    assert got["b"]["cert"] is None
    assert (got["c"]["info"], got["c"]["cert"]) == (None, {"s": None, "u": None})


def test_latest_per_key(spark):
    rows = spark.createDataFrame(
        [("a", T1, "old"), ("a", T2, "b"), ("a", T2, "c"), ("b", None, "x"), ("b", T1, "a")],
        "row_key string, at timestamp, v string",
    )
    got = sorted(map(tuple, latest_per_key(rows, ["at"]).collect()))
    assert got == [("a", T2, "c"), ("b", T1, "a")]


def test_copies_of_a_hot_key_are_collapsed_before_they_meet(spark, monkeypatch):
    rows = spark.range(0, 1000, numPartitions=4).selectExpr(
        "if(id < 900, 'hot', if(id = 999, null, concat('k', id % 50))) as row_key", "id % 300 as at", "id as v"
    )

    def newest():
        best = {}
        for key, at, v in rows.collect():
            best[key] = max(best.get(key, (-1, -1)), (at, v))
        return {(k, *r) for k, r in best.items()}

    def shuffles(frame):
        return frame._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

    plain = latest_per_key(rows, ["at"])
    assert shuffles(plain) == 1, "rows are shuffled once"
    monkeypatch.setattr(merge, "CHUNK", 100)
    dealt = latest_per_key(rows, ["at"])
    assert shuffles(dealt) == 3, "those of the hot key are collapsed by key and chunk before"
    assert set(map(tuple, plain.collect())) == set(map(tuple, dealt.collect())) == newest()

