"""SQL text of the cells of a keyed table.

Column maps are long; as SQL text a whole family is one parsed expression.
"""

from __future__ import annotations

from daybook.functions.times import NO_DATE

# How a cell is written. "text": string, absent when null, blank when the record it is
# a field of is missing. "blank": string, blank when null. "flag": True/False.
# "instant": timestamp, absent when missing or the sentinel. "as_is": unchanged.
CELLS = {
    "text": "cast({0} as string)",
    "blank": "coalesce(cast({0} as string), '')",
    "flag": "coalesce(initcap(cast({0} as string)), '')",
    "instant": f"nullif(cast({{0}} as timestamp), timestamp'{NO_DATE}')",
    "as_is": "{0}",
}


def cell(source: str, kind: str = "text") -> str:
    parent, dot, _ = source.rpartition(".")
    written = CELLS[kind].format(source)
    return f"if({parent} is null, '', {written})" if dot and kind == "text" else written


def struct_of(cells: dict[str, str]) -> str:
    """SQL text of a struct from column name -> cell text."""
    return "struct(" + ", ".join(f"{text} as `{name}`" for name, text in cells.items()) + ")"
