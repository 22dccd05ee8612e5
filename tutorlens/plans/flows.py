"""End-to-end flows: whole course, early prediction, exploration.

``tables`` is the registry of source tables (see ``tutorlens.sources``):
student_info, courses, assessments, student_assessment,
student_registration, student_vle, vle.  A flow writes its master table once
(``materialize``: to ``path``, or to the shared checkpoint folder) and everything
it returns reads that table.  ``levels`` declares the categories of the wide
encodings; without them they are listed from the written table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tutorlens.functions.lookup import CLASS_NAMES
from tutorlens.functions.sqltext import ident, literal, null_cells
from tutorlens.keys import K3
from tutorlens.operators import clean, distributions, encode, features, profile, split
from tutorlens.session import materialize
from tutorlens.sources.buckets import write_all_bucketed
from tutorlens.sources.readers import read_table, write_table
from tutorlens.sources.schemas import STUDENT_VLE_SMALL

DROP_WHOLE = ["id_student", "final_result"]
DROP_EARLY = ["id_student", "final_result", "date_unregistration"]


def cleaned(tables: Mapping[str, DataFrame], add_unregistered: bool) -> dict[str, DataFrame]:
    """C1-C4 applied to the registry."""
    return {
        "assessments": clean.clean_assessments(tables["assessments"], tables["courses"]),
        "student_info": clean.clean_student_info(tables["student_info"]),
        "student_assessment": clean.clean_submissions(tables["student_assessment"]),
        "student_registration": clean.clean_registration(tables["student_registration"], add_unregistered),
        "student_vle": tables["student_vle"],
    }


def whole_course_master(tables: Mapping[str, DataFrame]) -> DataFrame:
    """C9 + P9: enrolments with whole-course features and the class code."""
    t = cleaned(tables, add_unregistered=True)
    eng = features.engagement_features(t["student_vle"])
    asf = features.assessment_features(t["student_assessment"], t["assessments"])
    master = features.master_table(t["student_info"], eng, asf, t["student_registration"])
    return encode.encode_target(master)


def early_master(tables: Mapping[str, DataFrame], cutoff: int) -> DataFrame:
    """C10 before the active filter: enrolments with features up to ``cutoff``."""
    t = cleaned(tables, add_unregistered=False)
    eng = features.engagement_features(t["student_vle"], cutoff)
    asf = features.assessment_features(t["student_assessment"], t["assessments"], cutoff)
    return features.master_table(t["student_info"], eng, asf, t["student_registration"], cutoff)


def early_sample(tables: Mapping[str, DataFrame], cutoff: int) -> DataFrame:
    """C10 + F5 + P9: enrolments still active after ``cutoff``, with the class code."""
    return encode.encode_target(features.active_at(early_master(tables, cutoff), cutoff))


def encoded_forms(
    feats: DataFrame,
    levels: Mapping[str, Sequence] | None = None,
    categories: Sequence[str] = encode.CATEGORY_COLUMNS,
) -> tuple[DataFrame, DataFrame]:
    """C11: (linear, tree) one-hot forms sharing one level list."""
    lv = dict(levels) if levels is not None else encode.discover_levels(feats, categories)
    return encode.one_hot(feats, lv, categories, drop_first=True), encode.one_hot(feats, lv, categories)


def final_report(
    master: DataFrame,
    linear: DataFrame,
    tree: DataFrame,
    feats: DataFrame,
    label: str = "target",
) -> DataFrame:
    """Shapes, class balance, null totals and verdict as (item, value) rows, and the features.

    ``feature <name>`` gives the place of each column of ``feats`` before the
    encoding, ``feature_cols`` their number.

    One aggregate over the tree form (same rows as the master and the linear
    form; its columns include every linear column).
    """
    lab = ident(label)
    aggs = [
        "CAST(COUNT(1) AS DOUBLE) AS rows",
        f"CAST({null_cells(linear.columns)} AS DOUBLE) AS nulls_linear",
        f"CAST({null_cells(tree.columns)} AS DOUBLE) AS nulls_tree",
        f"CAST(COUNT({lab}) AS DOUBLE) AS _labelled",
    ] + [f"CAST(count_if({lab} = {code}) AS DOUBLE) AS _c{code}" for code in CLASS_NAMES]
    one = tree.agg(*[F.expr(a) for a in aggs])
    items = [
        ("master_rows", "rows"),
        ("master_cols", f"CAST({len(master.columns)} AS DOUBLE)"),
        ("feature_rows", "rows"),
        ("feature_cols", f"CAST({len(feats.columns)} AS DOUBLE)"),
        ("linear_rows", "rows"),
        ("linear_cols", f"CAST({len(linear.columns)} AS DOUBLE)"),
        ("tree_rows", "rows"),
        ("tree_cols", f"CAST({len(tree.columns)} AS DOUBLE)"),
        ("nulls_linear", "nulls_linear"),
        ("nulls_tree", "nulls_tree"),
        ("all_clear", "CAST(nulls_linear = 0 AND nulls_tree = 0 AS DOUBLE)"),
    ]
    for code, cname in CLASS_NAMES.items():
        items.append((f"share {cname}", f"bround(try_divide(_c{code}, _labelled), 3)"))
    items += [(f"feature {c}", str(i)) for i, c in enumerate(feats.columns)]
    pairs = ", ".join(f"{literal(n)}, CAST({e} AS DOUBLE)" for n, e in items)
    return one.selectExpr(f"stack({len(items)}, {pairs}) AS (item, value)")


def whole_course(
    tables: Mapping[str, DataFrame], levels: Mapping[str, Sequence] | None = None, path: str | None = None
) -> dict[str, DataFrame]:
    """Whole course: master, features, two encodings, report.

    The master table is written once, so the click-log aggregation and the joins
    run once, and a lost executor re-reads the files instead of the log.
    """
    master = materialize(whole_course_master(tables), path)
    feats = master.drop(*DROP_WHOLE)
    linear, tree = encoded_forms(feats, levels)
    return {
        "master": master,
        "features": feats,
        "encoded_linear": linear,
        "encoded_tree": tree,
        "report": final_report(master, linear, tree, feats),
    }


def early_prediction(
    tables: Mapping[str, DataFrame],
    cutoff: int = 90,
    levels: Mapping[str, Sequence] | None = None,
    path: str | None = None,
) -> dict[str, DataFrame]:
    """Early prediction at ``cutoff``: as :func:`whole_course`, plus the filter
    effect and the duplicate check.  The pre-filter master is written once."""
    pre = materialize(early_master(tables, cutoff), path)
    sample = encode.encode_target(features.active_at(pre, cutoff))
    feats = sample.drop(*DROP_EARLY)
    linear, tree = encoded_forms(feats, levels)
    return {
        "master_pre_filter": pre,
        "master": sample,
        "features": feats,
        "encoded_linear": linear,
        "encoded_tree": tree,
        "filter_effect": features.filter_effect(pre, cutoff),
        "duplicates": profile.duplicate_keys(pre, K3),
        "report": final_report(sample, linear, tree, feats),
    }


def training_splits(
    master: DataFrame,
    drop: Sequence[str],
    levels: Mapping[str, Sequence] | None = None,
    seed: int = 42,
    label: str = "target",
) -> DataFrame:
    """The tree encoding with a 70/15/15 ``split`` column.

    The split is drawn on the enrolment key, before the id is dropped.
    """
    lv = dict(levels) if levels is not None else encode.discover_levels(master)
    with_split = split.stratified_split(master, label=label, key=K3, seed=seed)
    return encode.one_hot(with_split.drop(*drop), lv)


#: Columns of the enrolment key's tables that the whole-course master is joined from.
STORED = ("info", "engagement", "assessment", "registration")


def store_features(tables: Mapping[str, DataFrame], folder: str, prefix: str, buckets: int) -> dict[str, DataFrame]:
    """The four tables of the whole-course master, stored bucketed by enrolment (``folder``/<name>, table <prefix>_<name>)."""
    t = cleaned(tables, add_unregistered=True)
    parts = {
        "info": t["student_info"],
        "engagement": features.engagement_features(t["student_vle"]),
        "assessment": features.assessment_features(t["student_assessment"], t["assessments"]),
        "registration": t["student_registration"],
    }
    return write_all_bucketed(parts, prefix, K3, buckets, folder)


def master_of_stored(stored: Mapping[str, DataFrame]) -> DataFrame:
    """C9 + P9 from stored tables: three joins by enrolment that shuffle nothing."""
    return encode.encode_target(features.master_table(*[stored[name] for name in STORED]))


def unfilled_master(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The whole-course master with its registration days as they are, for a preparation that is fitted."""
    raw = tables["student_registration"].withColumn("unregistered", F.col("date_unregistration").isNotNull().cast("int"))
    submissions = clean.clean_submissions(tables["student_assessment"])
    assessments = clean.clean_assessments(tables["assessments"], tables["courses"])
    return features.master_table(
        clean.clean_student_info(tables["student_info"]),
        features.engagement_features(tables["student_vle"]),
        features.assessment_features(submissions, assessments),
        raw,
    )


def registry(tables: Mapping[str, DataFrame], clicks: DataFrame) -> dict[str, DataFrame]:
    """The seven tables of the exploration under their published names; ``clicks`` stands for the click log."""
    return {
        "studentInfo": tables["student_info"],
        "studentAssessment": tables["student_assessment"],
        "assessments": tables["assessments"],
        "studentVle_small": clicks,
        "courses": tables["courses"],
        "studentRegistration": tables["student_registration"],
        "vle": tables["vle"],
    }


def engaged(info: DataFrame, clicks: DataFrame) -> DataFrame:
    """J8 + M2: enrolments with their student's clicks, 0 where there are none."""
    return info.join(clicks, "id_student", "left").fillna(0, subset=["sum_click"])


class _Explored:
    """What the exploration reports read; the click totals are written when the first report asks for them."""

    def __init__(self, tables: Mapping[str, DataFrame], path: str | None):
        self.tables, self.path = tables, path
        self.info, self.submissions = tables["student_info"], tables["student_assessment"]

    @cached_property
    def clicks(self) -> DataFrame:
        return shrink_clicks(self.tables["student_vle"], self.path)

    @cached_property
    def registry(self) -> dict[str, DataFrame]:
        return registry(self.tables, self.clicks)

    @cached_property
    def engaged(self) -> DataFrame:
        return engaged(self.info, self.clicks)


_DESCRIBED = ("studentInfo", "studentAssessment", "studentVle_small")
_COUNTED = ["final_result", "age_band", "gender", "highest_education", "num_of_prev_attempts"]

#: The exploration reports, in the order of the flow.
REPORTS: dict[str, Callable[[_Explored], DataFrame]] = {
    "profile": lambda x: profile.table_profile(x.registry),
    "previews": lambda x: profile.previews(x.registry),
    "null_counts": lambda x: profile.registry_null_counts(x.registry),
    "describe": lambda x: profile.describe_tables({n: x.registry[n] for n in _DESCRIBED}),
    "value_counts": lambda x: profile.multi_value_counts(x.info, _COUNTED),
    "histogram_credits": lambda x: distributions.histogram(x.info, "studied_credits"),
    "histogram_score": lambda x: distributions.histogram(x.submissions, "score"),
    "histogram_clicks": lambda x: distributions.histogram(x.clicks, "sum_click"),
    "density_score": lambda x: distributions.density_curve(x.submissions, "score"),
    "density_clicks": lambda x: distributions.density_curve(x.clicks, "sum_click"),
    "engagement_by_result": lambda x: profile.group_summary(x.engaged, "sum_click", "final_result"),
    "box_clicks_by_result": lambda x: distributions.box_stats(x.engaged, "sum_click", ["final_result"]),
    "score_by_result": lambda x: score_by_result(x.submissions, x.info),
    "box_score_by_result": lambda x: box_score_by_result(x.submissions, x.info),
    "category_by_result": lambda x: profile.multi_cross_counts(x.info, ["highest_education", "age_band"], "final_result"),
}


def explore(tables: Mapping[str, DataFrame], path: str | None = None, reports: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """The exploration reports (no charts; their data), all of ``REPORTS`` or those named.

    The click log is read once: its totals by student are written (to ``path``)
    and all reports read those.  Where no report named needs them, the log is not
    read and nothing is written.
    """
    names = list(REPORTS) if reports is None else list(reports)
    unknown = [n for n in names if n not in REPORTS]
    if unknown:
        raise ValueError(f"no such report: {', '.join(unknown)}; there are {', '.join(REPORTS)}")
    read = _Explored(tables, path)
    return {n: REPORTS[n](read) for n in names}


def _enrolments_per_student(info: DataFrame) -> DataFrame:
    return (
        info.where(F.col("id_student").isNotNull() & F.col("final_result").isNotNull())
        .groupBy("id_student", "final_result")
        .agg(F.count(F.lit(1)).alias("_e"))
    )


def score_by_result(submissions: DataFrame, info: DataFrame, digits: int | None = 6) -> DataFrame:
    """J9 + A9 + O2: mean score per final result, sorted by it, over submissions x enrolments of the
    same student (a student with k enrolments counts k times).

    The fan-out is never built: scores are summed per student first, then
    weighted by the number of that student's enrolments per result.
    """
    per_student = submissions.groupBy("id_student").agg(F.sum("score").alias("_s"), F.count("score").alias("_n"))
    joined = per_student.join(_enrolments_per_student(info), "id_student")
    # A result whose submissions all lack a score keeps its row, with a null mean.
    out = joined.groupBy("final_result").agg(
        F.try_divide(F.sum(F.col("_s") * F.col("_e")), F.sum(F.col("_n") * F.col("_e")).cast("double")).alias("mean_score")
    )
    if digits is not None:
        out = out.select("final_result", F.round("mean_score", digits).alias("mean_score"))
    return out.orderBy("final_result")


def box_score_by_result(submissions: DataFrame, info: DataFrame, digits: int | None = 6) -> DataFrame:
    """J9 + A24: box statistics of the fan-out, from weighted value counts."""
    per_value = (
        submissions.where(F.col("score").isNotNull())
        .groupBy("id_student", "score")
        .agg(F.count(F.lit(1)).alias("_k"))
    )
    weighted = (
        per_value.join(_enrolments_per_student(info), "id_student")
        .groupBy("final_result", "score")
        .agg(F.sum(F.col("_k") * F.col("_e")).alias("_w"))
    )
    return distributions.box_stats(weighted, "score", ["final_result"], weight="_w", digits=digits)


def shrink_clicks(vle: DataFrame, path: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Write the per-student click totals once and read them back.

    Later steps read this small table instead of the raw click log; ``fmt``
    'csv' writes a header row and no index, as ``to_csv(index=False)``.
    """
    clicks = features.clicks_per_student(vle)
    if fmt == "parquet":
        return materialize(clicks, path)
    write_table(clicks, path, fmt=fmt)
    return read_table(vle.sparkSession, path, STUDENT_VLE_SMALL, fmt=fmt)
