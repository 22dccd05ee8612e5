"""Quoting for Spark SQL expression strings.

Wide projections (one-hot dummies, per-column null counts, report rows) are
written as SQL expressions: one driver call per expression instead of one per
expression node, which matters when a projection has dozens of columns.
"""

from __future__ import annotations

from collections.abc import Iterable


def ident(name: str) -> str:
    """A backtick-quoted column name."""
    return "`" + name.replace("`", "``") + "`"


def literal(value) -> str:
    """A Spark SQL literal for a Python value (str, bool, int, float, None)."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, int):
        return f"{value}L" if abs(value) > 2**31 - 1 else str(value)
    if isinstance(value, float):
        return f"CAST({value!r} AS DOUBLE)"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def null_cells(columns: Iterable[str]) -> str:
    """Expression counting the missing cells over ``columns`` (0 when empty)."""
    terms = [f"count_if({ident(c)} IS NULL)" for c in columns]
    return " + ".join(terms) if terms else "CAST(0 AS BIGINT)"
