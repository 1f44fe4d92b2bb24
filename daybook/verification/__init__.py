"""Queries over the given test tables, each with its DuckDB counterpart."""
