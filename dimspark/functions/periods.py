"""The two period predicates. They differ at both ends and must not be mixed up."""

from __future__ import annotations

from pyspark.sql import Column


def covers_closed_open(at: Column, start: Column, end: Column) -> Column:
    """``at`` in ``[start, end)`` with a NULL end open: used for enrichment."""
    return (start <= at) & (end.isNull() | (end > at))


def covers_open_closed(at: Column, start: Column, end: Column) -> Column:
    """``at`` in ``(start, end]``, NULL never matches: used for fact key lookup."""
    return (at > start) & (at <= end)
