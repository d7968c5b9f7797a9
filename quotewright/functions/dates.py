"""Predicates on closed date intervals."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

Bound = Column | date | str | None


def as_date(bound: Column | date | str) -> Column:
    return bound if isinstance(bound, Column) else F.lit(bound).cast("date")


def in_range(value: Column, start: Bound = None, end: Bound = None) -> Column:
    """True inside the closed interval; a missing bound leaves that side open."""
    inside = F.lit(True)
    if start is not None:
        inside = inside & (value >= as_date(start))
    if end is not None:
        inside = inside & (value <= as_date(end))
    return inside


def overlaps(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Do two closed intervals share a day?  Unparseable or missing dates say no.

    Usable as a filter or inside a join condition; strings are parsed as ISO dates.
    """
    a0, a1, b0, b1 = [c.try_cast("date") for c in (a_start, a_end, b_start, b_end)]
    return F.coalesce((a0 <= b1) & (a1 >= b0), F.lit(False))
