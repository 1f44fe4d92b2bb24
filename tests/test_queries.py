"""Every registered query against its SQL, over the smallest given tables."""

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__
from daybook.verification import catalogue

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(FOLDER):
        name = file.removesuffix(".parquet")
        connection.sql(f"create view {name} as select * from '{FOLDER}/{file}'")
    return connection


def rows_of(table):
    names = sorted(table.column_names)
    return names, sorted(repr(tuple(r[n] for n in names)) for r in table.to_pylist())


def types_of(table):
    return {f.name: str(f.type).replace("large_", "") for f in table.schema}


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    got = __spark_entry__.queries()[name](spark, FOLDER).toArrow()
    expected = duck.sql(__spark_entry__.oracle_sql()[name]).to_arrow_table()
    assert types_of(got) == types_of(expected)
    assert rows_of(got) == rows_of(expected)


def test_fields_the_last_element_lacks_are_blank(spark, tmp_path):
    links = ['<a href="/first"><a href="/b">', '<a href="/b"><a href="/last">', "none", None]
    rows = [(i, "http://a.example", html) for i, html in enumerate(links)] + [(4, "http://spam-farm", links[1])]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = catalogue.QUERIES["last_element_fields"](spark, str(tmp_path)).orderBy("page_id")
    assert [tuple(r)[1:] for r in got.collect()] == [("/b", ""), ("/last", "/last"), ("", ""), ("", ""), ("", "")]


def test_every_query_has_sql():
    assert set(catalogue.SQL) == set(catalogue.QUERIES) <= set(__spark_entry__.queries())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_entry_imports_without_a_session():
    """The entry module may be imported before any session is made."""
    code = "import __spark_entry__ as entry; assert set(entry.oracle_sql()) <= set(entry.queries())"
    folder = os.path.dirname(os.path.abspath(__spark_entry__.__file__))
    subprocess.run([sys.executable, "-c", code], cwd=folder, check=True, timeout=120)
