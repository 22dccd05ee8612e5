"""Cleaning steps (C1-C4) and their report (M8).

Each step is a lazy ``DataFrame -> DataFrame``; the numbers the notebooks
print before a fill ("n rows updated") come from :func:`cleaning_report`, one
aggregate per table, instead of eager counts in the middle of the pipeline.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tutorlens.functions.nulls import count_missing
from tutorlens.functions.sqltext import ident, literal
from tutorlens.keys import K2
from tutorlens.operators.quantiles import median_of


def fill_constant(df: DataFrame, column: str, value) -> DataFrame:
    """Fill missing values of one column with a constant (``fillna(value)``)."""
    return df.fillna({column: value})


def fill_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Zero-fill after a left join, keeping each column's type."""
    exprs = []
    for c in df.columns:
        if c in columns:
            exprs.append(f"coalesce({ident(c)}, CAST(0 AS {df.schema[c].dataType.simpleString()})) AS {ident(c)}")
        else:
            exprs.append(ident(c))
    return df.selectExpr(*exprs)


def fill_median(df: DataFrame, column: str) -> DataFrame:
    """Fill missing values with the exact median of the non-missing ones.

    The median is selected by a distributed job when this is called, and
    inlined as a literal: the big table is neither joined nor collected.
    """
    med = median_of(df, column)
    return df.withColumn(column, F.coalesce(F.col(column), med.cast(df.schema[column].dataType)))


def fill_from_lookup(
    df: DataFrame, lookup: DataFrame, on: Sequence[str], target: str, source: str
) -> DataFrame:
    """Fill ``target`` from ``lookup.source`` where it is missing (left join on ``on``).

    The lookup is a dimension table (one row per key); the planner broadcasts
    it when its size is under the broadcast threshold.
    """
    right = lookup.select(*on, source)
    joined = df.join(right, list(on), "left")
    filled = F.coalesce(F.col(target), F.col(source).cast(df.schema[target].dataType)).alias(target)
    return joined.select(*[filled if c == target else F.col(c) for c in df.columns])


def clean_assessments(assessments: DataFrame, courses: DataFrame) -> DataFrame:
    """A missing assessment day becomes the course length (final exam)."""
    return fill_from_lookup(assessments, courses, K2, "date", "module_presentation_length")


def clean_student_info(info: DataFrame) -> DataFrame:
    """Missing deprivation band -> 'Unknown'."""
    return fill_constant(info, "imd_band", "Unknown")


def clean_submissions(submissions: DataFrame) -> DataFrame:
    """Drop banked (carried-over) submissions; missing scores are kept."""
    return submissions.where(F.col("is_banked") == 0)


def clean_registration(registration: DataFrame, add_unregistered: bool = True) -> DataFrame:
    """C4: median-fill the registration day; optionally flag withdrawals.

    The median uses every registration row, as the notebooks do.
    """
    out = fill_median(registration, "date_registration")
    if add_unregistered:
        out = out.withColumn("unregistered", F.col("date_unregistration").isNotNull().cast("int"))
    return out


def _stack(df: DataFrame, table: str, names: Sequence[str]) -> DataFrame:
    pairs = ", ".join(f"{literal(n)}, CAST({ident(n)} AS BIGINT)" for n in names)
    return df.selectExpr(f"{literal(table)} AS table_name", f"stack({len(names)}, {pairs}) AS (metric, value)")


def cleaning_report(
    assessments: DataFrame, info: DataFrame, submissions: DataFrame, registration: DataFrame
) -> DataFrame:
    """Rows touched by each cleaning step, one aggregate per raw table.

    Columns: table_name, metric, value.
    """
    a = assessments.agg(count_missing("date").alias("dates_filled_from_course_length"))
    i = info.agg(count_missing("imd_band").alias("imd_band_filled_unknown"))
    s = submissions.agg(
        F.coalesce(F.sum("is_banked"), F.lit(0)).alias("banked_rows_removed"),
        F.count_if((F.col("is_banked") == 0) & F.col("score").isNull()).alias("missing_scores_kept"),
    )
    r = registration.agg(
        count_missing("date_registration").alias("date_registration_filled_median"),
        F.count_if(F.col("date_unregistration").isNotNull()).alias("students_unregistered"),
    )
    return (
        _stack(a, "assessments", ["dates_filled_from_course_length"])
        .unionByName(_stack(i, "student_info", ["imd_band_filled_unknown"]))
        .unionByName(_stack(s, "student_assessment", ["banked_rows_removed", "missing_scores_kept"]))
        .unionByName(
            _stack(r, "student_registration", ["date_registration_filled_median", "students_unregistered"])
        )
    )
