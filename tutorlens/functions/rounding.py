"""Rounding and percentages the way the pandas reports print them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(c: str | Column, digits: int = 3) -> Column:
    """pandas ``Series.round`` is half-to-even (0.0625 -> 0.062)."""
    return F.bround(F.col(c) if isinstance(c, str) else c, digits)


def percent_of(part: str | Column, total: str | Column) -> Column:
    """100 * part / total as a double (null when the total is 0)."""
    p = F.col(part) if isinstance(part, str) else part
    t = F.col(total) if isinstance(total, str) else total
    return F.try_divide(p.cast("double") * F.lit(100.0), t.cast("double"))
