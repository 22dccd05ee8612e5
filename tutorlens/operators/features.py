"""Per-enrolment features (C5-C10) and the master table.

Plan shape: every aggregate is grouped on the enrolment key K3, so its output
is already hash-partitioned on K3; the three left joins of the master table
then reuse that partitioning and only the enrolment table is shuffled once.
Aggregation happens before any join (the click log never meets the enrolment
table row by row), and the cutoff filters sit directly above the scans, where
Catalyst pushes them into the Parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tutorlens.functions.nulls import drop_null_keys, safe_divide, sum_or_zero
from tutorlens.keys import K2, K3
from tutorlens.operators.clean import fill_zero


def clicks_per_student(vle: DataFrame) -> DataFrame:
    """A1/C14: total clicks per student over all course runs (id_student, sum_click)."""
    return (
        drop_null_keys(vle.select("id_student", "sum_click"), ["id_student"])
        .groupBy("id_student")
        .agg(sum_or_zero("sum_click").alias("sum_click"))
    )


def engagement_features(vle: DataFrame, cutoff: int | None = None) -> DataFrame:
    """Click features per enrolment.

    Whole course: ``total_clicks``.  With a cutoff (clicks on days <= cutoff):
    ``total_clicks``, ``active_days`` (distinct days), ``unique_resources``
    (distinct sites), ``clicks_per_day`` (total / cutoff, whatever day the
    student started) and ``days_since_last_click`` (cutoff - last day).  The
    cutoff must be a positive day.

    The early form counts days and sites as the sets that an enrolment's rows
    add up to: they combine before the one shuffle, and hold no more than the
    days and the sites of a course run.  Nothing is expanded.
    """
    if cutoff is not None and cutoff <= 0:
        raise ValueError(f"cutoff must be a positive day, not {cutoff}")
    log = drop_null_keys(vle, K3)
    if cutoff is None:
        return log.groupBy(*K3).agg(sum_or_zero("sum_click").alias("total_clicks"))
    agg = log.where(F.col("date") <= F.lit(cutoff)).groupBy(*K3).agg(
        sum_or_zero("sum_click").alias("total_clicks"),
        F.size(F.collect_set("date")).cast("long").alias("active_days"),
        F.size(F.collect_set("id_site")).cast("long").alias("unique_resources"),
        F.max("date").alias("_last_click_day"),
    )
    return agg.select(
        *K3,
        "total_clicks",
        "active_days",
        "unique_resources",
        (F.col("total_clicks") / F.lit(float(cutoff))).alias("clicks_per_day"),
        (F.lit(cutoff) - F.col("_last_click_day")).cast("int").alias("days_since_last_click"),
    )


def assessments_due(assessments: DataFrame, cutoff: int) -> DataFrame:
    """Assessments due on or before the cutoff, per course run (K2, total_assessments_due)."""
    due = drop_null_keys(assessments.where(F.col("date") <= F.lit(cutoff)), K2)
    return due.groupBy(*K2).agg(F.count("id_assessment").alias("total_assessments_due"))


def scored_submissions(submissions: DataFrame, assessments: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Submissions with the course run of their assessment.

    Rows whose assessment is unknown get a missing course run and would vanish
    in the group-by, so the left join is written as the inner join it becomes.
    """
    lookup = assessments.select("id_assessment", *K2, *extra)
    return submissions.join(lookup, "id_assessment", "inner").where(
        F.col("code_module").isNotNull() & F.col("code_presentation").isNotNull()
    )


def assessment_features(
    submissions: DataFrame, assessments: DataFrame, cutoff: int | None = None
) -> DataFrame:
    """Score features per enrolment.

    ``mean_score`` (missing scores skipped; all-missing -> null) and
    ``num_submissions`` (rows with a score) come from one aggregate.  With a
    cutoff, only submissions *submitted* by that day count, and
    ``submission_rate`` = num_submissions / assessments *due* by that day of
    the course run (0 when nothing is due; may exceed 1).
    """
    merged = scored_submissions(submissions, assessments)
    if cutoff is not None:
        merged = merged.where(F.col("date_submitted") <= F.lit(cutoff))
    per_enrolment = drop_null_keys(merged, K3).groupBy(*K3).agg(
        F.avg("score").alias("mean_score"),
        F.count("score").alias("num_submissions"),
    )
    if cutoff is None:
        return per_enrolment
    due = assessments_due(assessments, cutoff)
    rate = F.coalesce(safe_divide(F.col("num_submissions"), F.col("total_assessments_due")), F.lit(0.0))
    return per_enrolment.join(due, K2, "left").select(
        *K3, "mean_score", "num_submissions", rate.cast("double").alias("submission_rate")
    )


def master_table(
    info: DataFrame,
    engagement: DataFrame,
    assessment: DataFrame,
    registration: DataFrame,
    cutoff: int | None = None,
) -> DataFrame:
    """Enrolments left-joined with the three feature tables, gaps filled.

    Whole course: registration brings ``date_registration`` and
    ``unregistered``; early form: ``date_registration`` and
    ``date_unregistration``.  An enrolment without a registration row keeps a
    null there (the fill happened on the registration table); ``unregistered``
    is then a double, null for those rows.
    """
    reg_cols = ["date_registration", "unregistered"] if cutoff is None else ["date_registration", "date_unregistration"]
    m = (
        info.join(engagement, K3, "left")
        .join(assessment, K3, "left")
        .join(registration.select(*K3, *reg_cols), K3, "left")
    )
    if cutoff is None:
        # Left-joined and never filled: a double with null, as pandas' float NaN.
        m = m.withColumn("unregistered", F.col("unregistered").cast("double"))
        return fill_zero(m, ["total_clicks", "mean_score", "num_submissions"])
    m = fill_zero(
        m,
        ["total_clicks", "clicks_per_day", "active_days", "unique_resources", "mean_score", "num_submissions", "submission_rate"],
    )
    return m.withColumn(
        "days_since_last_click", F.coalesce(F.col("days_since_last_click"), F.lit(cutoff).cast("int"))
    )


def active_mask(cutoff: int):
    """still registered after the cutoff day (leaving on the day counts as gone)."""
    c = F.col("date_unregistration")
    return c.isNull() | (c > F.lit(cutoff))


def active_at(master: DataFrame, cutoff: int) -> DataFrame:
    return master.where(active_mask(cutoff))


def filter_effect(master: DataFrame, cutoff: int) -> DataFrame:
    """Rows before, removed and after the active filter, in one pass."""
    mask = active_mask(cutoff)
    return master.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(~mask).alias("rows_removed"),
        F.count_if(mask).alias("rows_after"),
    )
