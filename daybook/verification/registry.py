"""Registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str, text: str = "") -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that must give the same rows.

    ``text`` names numbers that may be absent. They are compared as text on both
    sides, the way keyed tables write them, as data frames differ on how they
    hold an absent integer.
    """
    names = text.split()

    def add(function: Query) -> Query:
        @wraps(function)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(spark, folder).withColumns({n: F.col(n).cast("string") for n in names})

        QUERIES[function.__name__] = run if names else function
        casts = ", ".join(f"cast({n} as varchar) as {n}" for n in names)
        SQL[function.__name__] = f"select * replace ({casts}) from ({sql})" if names else sql
        return function

    return add
