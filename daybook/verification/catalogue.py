"""All registered queries."""

from daybook.verification import expressions, flows, lookups, merges, reports, scans, snapshots  # noqa: F401
from daybook.verification.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
