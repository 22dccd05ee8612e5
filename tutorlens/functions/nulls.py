"""Missing-value rules, one helper each, so pandas semantics live in one place.

* a double NaN is not null in Spark and compares greater than any number, so
  inputs are normalised NaN -> null at the source (:func:`nan_to_null`);
* pandas group-by drops rows whose key is missing (:func:`drop_null_keys`);
* a pandas group sum over only-missing values is 0, Spark gives null
  (:func:`sum_or_zero`);
* x / 0 raises under ANSI mode; pandas gives inf or NaN, later zero-filled
  (:func:`safe_divide`).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: str | Column) -> Column:
    """Double NaN -> null (null stays null)."""
    return F.nanvl(_col(c), F.lit(None).cast("double"))


def count_missing(c: str | Column) -> Column:
    """Number of missing values of a column, as one aggregate expression."""
    return F.count_if(_col(c).isNull())


def sum_or_zero(c: str | Column) -> Column:
    """Group sum that is 0, not null, when every value is missing."""
    return F.coalesce(F.sum(_col(c)), F.lit(0))


def safe_divide(num: str | Column, den: str | Column) -> Column:
    """Division that yields null instead of raising on a zero divisor."""
    return F.try_divide(_col(num), _col(den))


def drop_null_keys(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Drop rows with a missing group key, as a pandas group-by does."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df if cond is None else df.where(cond)
