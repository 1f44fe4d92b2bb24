"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings that mark a record as test data.
TEST_MARKS = "test|Test|TEST"
TEST_SUBJECT = "CN=[^,]+ (Test|TEST|test),"
# Fixed value: marker looked for in user names.
OPERATOR_MARK = "OPER"


def mentions(column: Column, pattern: str) -> Column:
    """Null-safe regex search: a null never matches."""
    return F.coalesce(column.rlike(pattern), F.lit(False))


def mentions_test(column: Column) -> Column:
    return mentions(column, TEST_MARKS)


def subject_mentions_test(column: Column) -> Column:
    return mentions(column, TEST_SUBJECT)


def blank_if_absent(column: Column) -> Column:
    """Null, the text ``None`` and the empty string all read as blank."""
    return F.when(column.isNull() | (column == "None"), F.lit("")).otherwise(column)


def all_digits(column: Column) -> Column:
    # \z, not $: Java's $ also matches before a closing line break.
    return mentions(column, r"^[0-9]+\z")


def is_space(column: Column) -> Column:
    """Only white space and at least one character; false for null and ``''``."""
    return mentions(column, r"(?U)^[\s\x1c-\x1f]+\z")


def locality_from_username(username: Column) -> Column:
    """Characters from the operator marker up to position 3; blank when the marker is absent."""
    at = F.instr(username, OPERATOR_MARK)
    length = F.greatest(F.lit(4) - at, F.lit(0))
    return F.when(at > 0, F.substring(username, at, length)).otherwise(F.lit(""))


def joined_names(items: Column) -> Column:
    """The ``name`` fields of an array of structs, comma-joined; null entries are skipped."""
    named = F.transform(
        F.filter(items, lambda item: item.isNotNull()),
        lambda item: F.coalesce(item["name"], F.lit("")),
    )
    return F.coalesce(F.concat_ws(", ", named), F.lit(""))


def contain_each_other(left: Column, right: Column) -> Column:
    """Case-insensitive containment in either direction."""
    a, b = F.lower(left), F.lower(right)
    return F.contains(a, b) | F.contains(b, a)
