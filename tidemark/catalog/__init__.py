"""Registered queries: each runs library operators over the whole given tables,
and most carry the SQL that must give the same rows."""

from tidemark.catalog import columns, filtering, grouping, joining, reporting, storage, windowing
from tidemark.catalog.base import ENTRIES, Entry

__all__ = [
    "ENTRIES", "Entry", "columns", "filtering", "grouping", "joining", "reporting", "storage", "windowing",
]
