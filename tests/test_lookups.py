import random

import pytest

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daybook.operators.aliases import fold_aliases
from daybook.operators.lookups import decode_province, decode_status, resolve_area, status_entries
from daybook.plans.labels import Labels
from daybook.plans.locality import explode_areas, locality_snapshot, ward_schema
from daybook.sources.collections import SCHEMAS

LABELS = Labels("Operator", "Service")
AREAS = "position int, code string, name string, other_code string, area_code string, area_name string"


def test_status_first_entry_wins_and_own_text_is_the_fallback(spark):
    dictionary = spark.createDataFrame(
        [
            ("status", "CertOrder", 1, "first", 0),
            ("status", "CertOrder", 1, "second", 1),
            ("status", "Register", 2, "register", 2),
            ("label", "CertOrder", 3, "label", 3),
            ("status", "CertOrder", None, "no code", 4),
        ],
        "type string, table string, code int, description_vi string, position int",
    )
    rows = spark.createDataFrame(
        [(1, "1", "own"), (2, "2", "own"), (3, "3", "None"), (4, "", "own"), (5, "None", None), (6, None, "own"), (7, "x", "own")],
        "i int, status string, own string",
    )
    out = decode_status(rows, status_entries(dictionary, "CertOrder"), F.col("status"), F.col("own"), "reason")
    assert [r.reason for r in out.orderBy("i").collect()] == ["first", "own", "", "own", "", "own", "own"]


def test_province_codes(spark):
    localities = spark.createDataFrame(
        [(7, "HN", 2), (7, "XX", 3), (8, None, 1)], "province_id int, province_code string, ward_id int"
    )
    ids = ["", "None", None, "abc", "7", "007", "8", "9", "99999999999"]
    rows = spark.createDataFrame(list(enumerate(ids)), "i int, id string")
    out = decode_province(rows, localities, F.col("id"), "code")
    assert [r.code for r in out.orderBy("i").collect()] == ["", "", "", "abc", "HN", "HN", "", "", ""]


def test_area_by_code_then_other_code_else_dropped(spark):
    areas = spark.createDataFrame(
        [(0, "A", "a", "X", "1", "one"), (1, "B", "b", "X", "2", "two"), (2, "C", "c", "A", "3", "three")], AREAS
    )
    rows = spark.createDataFrame([(1, "A"), (2, "X"), (3, "Z"), (4, "C"), (5, None)], "i int, code string")
    out = resolve_area(rows, areas, "code").orderBy("i").collect()
    assert [(r.i, r.code, r.area.area_name) for r in out] == [(1, "A", "one"), (2, "A", "one"), (4, "C", "three")]


def model_fold(areas):
    """The fold row by row, over (code, name, other)."""
    kept = {}
    for code, name, other in areas:
        if not name:
            continue
        hits = [k for k, (n, _) in kept.items() if n.lower() in name.lower() or name.lower() in n.lower()]
        if hits:
            kept[hits[0]] = (kept[hits[0]][0], code)
        else:
            kept[code] = (name, other)
    return [(code, name, other) for code, (name, other) in kept.items()]


NAME = st.text("abB", max_size=4)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("123456"), NAME, st.sampled_from(["", "z"])), max_size=9))
def test_fold_against_a_row_by_row_model(spark, areas):
    rows = [(i, c, n, o, "r", "region") for i, (c, n, o) in enumerate(areas)]
    folded = fold_aliases(spark.createDataFrame(rows, AREAS))
    assert [(r.code, r.name, r.other_code) for r in folded.collect()] == model_fold(areas)


def test_fold_of_many_areas(spark):
    """More areas than any task would fold alone, in chains and with repeated codes."""
    rng = random.Random(6)
    areas = [(str(rng.randrange(9000)), f"{rng.randrange(1 << 24):x}", "") for _ in range(12_000)]
    rows = [(i, c, n, o, "r", "region") for i, (c, n, o) in enumerate(areas)]
    folded = fold_aliases(spark.createDataFrame(rows, AREAS)).collect()
    assert [(r.code, r.name, r.other_code) for r in folded] == model_fold(areas)


@pytest.mark.parametrize("codes", [20_000, 1, 7])
def test_fold_of_equal_names(spark, codes):
    """Pairs are those of names; all areas of a name are decided together."""
    areas = [(str(i % codes), "North", "") for i in range(20_000)] + [("x", "south", ""), ("0", "East", ""), ("5", "the north", "")]
    rows = [(i, c, n, o, "r", "region") for i, (c, n, o) in enumerate(areas)]
    folded = fold_aliases(spark.createDataFrame(rows, AREAS)).collect()
    assert [(r.code, r.name, r.other_code) for r in folded] == model_fold(areas)


def test_fold_of_long_names(spark):
    rng = random.Random(8)
    long = ["".join(rng.choice("abcdé ") for _ in range(2_000)) for _ in range(40)]
    names = long + [x[k : k + n] for x in long[:20] for k, n in ((0, 1), (700, 2), (5, 3), (900, 40), (100, 1_900))] + [long[0].upper(), "a" * 2_000]
    areas = [(str(rng.randrange(60)), n, "") for n in rng.sample(names, len(names))]
    rows = [(i, c, n, o, "r", "region") for i, (c, n, o) in enumerate(areas)]
    folded = fold_aliases(spark.createDataFrame(rows, AREAS)).collect()
    assert [(r.code, r.name, r.other_code) for r in folded] == model_fold(areas)


def test_locality_snapshot(spark):
    areas = spark.createDataFrame(
        [
            ("00", "country", [("K", "kept out", "")]),
            ("01", "north", [("HN", "Hanoi", ""), ("HT", "Hanoi west", "")]),
            ("02", "south", [("SG", "Saigon", "SO"), (None, None, None)]),
            (None, "none", None),
        ],
        SCHEMAS["AreaLocal"],
    )
    assert explode_areas(areas).count() == 4
    wards = spark.createDataFrame(
        [
            (1, "p", "HN", 1, "d", 1, 1, "w", 1, True),
            (2, None, "HT", 1, "d", 1, 2, "w", 1, None),
            (3, "p", "SO", 1, "d", 1, 3, "w", 1, False),
            (4, "p", "K", 1, "d", 1, 4, "w", 1, False),
        ],
        ward_schema(LABELS),
    )
    got = {r.ward_id: r for r in locality_snapshot(wards, areas, LABELS).collect()}
    assert set(got) == {1, 2, 3}
    assert (got[1].province_code, got[1].province_other_code, got[1].area_local_name) == ("HN", "HT", "north")
    assert (got[2].province_code, got[2].province_name, got[2].co_tuyen_thu) == ("HN", "", False)
    assert (got[3].province_code, got[3].area_local_code) == ("SG", "02")
