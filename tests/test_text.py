from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daybook.functions import text
from daybook.functions.cells import cell

V = F.col("v")


def test_test_marks_in_three_spellings_only(values):
    names = ["test user", "a Test", "TEST", "tESt", "", None]
    assert values(names, "string", text.mentions_test(V)) == [True, True, True, False, False, False]


def test_subject_needs_the_whole_word(values):
    subjects = ["CN=A Test,O=X", "CN=A TEST,O=X", "CN=A test,O=X", "CN=A Testing,O=X", "CN=Test,O=X", None]
    assert values(subjects, "string", text.subject_mentions_test(V)) == [True, True, True, False, False, False]


def test_blank_encodings(values):
    assert values(["None", "", None, "none", "x"], "string", text.blank_if_absent(V)) == ["", "", "", "none", "x"]


def test_digits(values):
    assert values(["12", "1a", "", None, "12\n", "-1"], "string", text.all_digits(V)) == [
        True, False, False, False, False, False,
    ]


def test_is_space(values):
    items = [" ", "\t \n", " ", "\x1c", "", None, " a"]
    assert values(items, "string", text.is_space(V)) == [i is not None and i.isspace() for i in items]


def test_locality_slice_is_literal(values):
    names = ["OPERx", "aOPERx", "abOPER", "abcOPER", "none", "", None]
    expected = [n[n.index("OPER") : 3] if n and "OPER" in n else "" for n in names]
    assert values(names, "string", text.locality_from_username(V)) == expected


def test_joined_names(values):
    roles = [[("a",), ("b",)], [("a",), None, (None,)], [], None]
    assert values(roles, "array<struct<name:string>>", text.joined_names(V)) == ["a, b", "a, ", "", ""]


def test_cells(values):
    assert values([None, "", "x"], "string", F.expr(cell("v"))) == [None, "", "x"]
    assert values([None, "", "x"], "string", F.expr(cell("v", "blank"))) == ["", "", "x"]
    # A field of a record that is missing is blank, a missing field absent.
    assert values([None, (None,), ("x",)], "struct<s:string>", F.expr(cell("v.s"))) == ["", None, "x"]
    assert values([None, 5], "int", F.expr(cell("v"))) == [None, "5"]
    assert values([None, True, False], "boolean", F.expr(cell("v", "flag"))) == ["", "True", "False"]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.text("aAb", max_size=4), st.text("aAb", max_size=4)), min_size=1, max_size=8))
def test_containment_either_way(spark, pairs):
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    found = rows.orderBy("i").select(text.contain_each_other(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in found] == [a.lower() in b.lower() or b.lower() in a.lower() for a, b in pairs]
