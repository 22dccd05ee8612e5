"""Registered queries: each takes (spark, sf_dir) and returns a lazy DataFrame.

All of them run over the whole fixture tables derived from the generated test
data (no id subsets, no row caps); the SQL twins live in
:mod:`tutorlens.plans.oracle`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tutorlens.functions.lookup import CLASS_LABELS, CLASS_NAMES, map_lookup
from tutorlens.functions.sqltext import ident
from tutorlens.keys import K3
from tutorlens.operators import clean, distributions, encode, features, increments, profile, split
from tutorlens.operators.prepare import Preparation, PreparationModel
from tutorlens.plans import flows
from tutorlens.session import materialize, shared_folder
from tutorlens.sources import read_parted, read_table, write_table
from tutorlens.sources.fixtures import CUTOFF_DAY, LEVELS, fixture_tables, read_raw
from tutorlens.sources.schemas import STUDENT_REGISTRATION

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return fixture_tables(spark, sf_dir)


def _clicks(t: dict[str, DataFrame]) -> DataFrame:
    return features.clicks_per_student(t["student_vle"])


def _engaged(t: dict[str, DataFrame]) -> DataFrame:
    return flows.engaged(t["student_info"], _clicks(t))


def _exploration_registry(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return flows.registry(t, _clicks(t))


# --- cleaning -------------------------------------------------------------

def clicks_per_student(spark, sf_dir):
    return features.clicks_per_student(_t(spark, sf_dir)["student_vle"])


def clicks_by_enrolment(spark, sf_dir):
    return features.engagement_features(_t(spark, sf_dir)["student_vle"])


def assessment_dates_filled(spark, sf_dir):
    t = _t(spark, sf_dir)
    return clean.clean_assessments(t["assessments"], t["courses"])


def info_imd_filled(spark, sf_dir):
    return clean.clean_student_info(_t(spark, sf_dir)["student_info"])


def submissions_not_banked(spark, sf_dir):
    return clean.clean_submissions(_t(spark, sf_dir)["student_assessment"])


def registration_median_filled(spark, sf_dir):
    return clean.clean_registration(_t(spark, sf_dir)["student_registration"], add_unregistered=True)


def cleaning_report(spark, sf_dir):
    t = _t(spark, sf_dir)
    return clean.cleaning_report(t["assessments"], t["student_info"], t["student_assessment"], t["student_registration"])


# --- features ---------------------------------------------------------------

def early_engagement(spark, sf_dir):
    return features.engagement_features(_t(spark, sf_dir)["student_vle"], CUTOFF_DAY)


def scores_by_enrolment(spark, sf_dir):
    t = flows.cleaned(_t(spark, sf_dir), add_unregistered=True)
    return features.assessment_features(t["student_assessment"], t["assessments"])


def assessments_due(spark, sf_dir):
    t = flows.cleaned(_t(spark, sf_dir), add_unregistered=False)
    return features.assessments_due(t["assessments"], CUTOFF_DAY)


def early_assessment(spark, sf_dir):
    t = flows.cleaned(_t(spark, sf_dir), add_unregistered=False)
    return features.assessment_features(t["student_assessment"], t["assessments"], CUTOFF_DAY)


def master_whole_course(spark, sf_dir):
    return flows.whole_course_master(_t(spark, sf_dir))


def master_early(spark, sf_dir):
    return flows.early_master(_t(spark, sf_dir), CUTOFF_DAY)


def active_students(spark, sf_dir):
    return flows.early_sample(_t(spark, sf_dir), CUTOFF_DAY)


def active_filter_effect(spark, sf_dir):
    return features.filter_effect(flows.early_master(_t(spark, sf_dir), CUTOFF_DAY), CUTOFF_DAY)


def target_encoded(spark, sf_dir):
    info = _t(spark, sf_dir)["student_info"].select(*K3, "final_result")
    return encode.encode_target(info)


def class_balance(spark, sf_dir):
    master = flows.whole_course_master(_t(spark, sf_dir))
    vc = profile.value_counts(master, "target", normalize="share")
    return vc.select(
        F.col("value").alias("target"),
        map_lookup(F.col("value"), CLASS_NAMES).alias("class_name"),
        "count",
        "share",
    )


# --- profiling ----------------------------------------------------------------

def value_counts_percent(spark, sf_dir):
    info = _t(spark, sf_dir)["student_info"]
    return profile.multi_value_counts(
        info, ["final_result", "age_band", "gender", "highest_education", "num_of_prev_attempts"]
    )


def null_counts(spark, sf_dir):
    return profile.registry_null_counts(_exploration_registry(_t(spark, sf_dir)))


def master_null_columns(spark, sf_dir):
    return profile.null_counts(flows.whole_course_master(_t(spark, sf_dir)), only_missing=True)


def _events(spark, sf_dir):
    return read_raw(spark, sf_dir, "events")


def duplicate_keys(spark, sf_dir):
    return profile.duplicate_keys(_events(spark, sf_dir), ["user_id", "event_type"])


def duplicate_key_groups(spark, sf_dir):
    return profile.duplicate_key_groups(_events(spark, sf_dir), ["user_id", "event_type"])


def enrolment_duplicates(spark, sf_dir):
    return profile.duplicate_keys(flows.early_master(_t(spark, sf_dir), CUTOFF_DAY), K3)


def table_profile(spark, sf_dir):
    return profile.table_profile(_exploration_registry(_t(spark, sf_dir)))


def preview(spark, sf_dir):
    return profile.preview(_t(spark, sf_dir)["student_info"], K3, 5)


def previews(spark, sf_dir):
    return profile.previews(_exploration_registry(_t(spark, sf_dir)), 5)


def describe_clicks(spark, sf_dir):
    return profile.describe_numeric(_clicks(_t(spark, sf_dir)), ["sum_click"])


def education_by_result(spark, sf_dir):
    info = _t(spark, sf_dir)["student_info"]
    return profile.cross_counts(info, "highest_education", "final_result", list(CLASS_LABELS.values()))


def describe_numeric(spark, sf_dir):
    reg = _exploration_registry(_t(spark, sf_dir))
    return profile.describe_tables({n: reg[n] for n in ("studentInfo", "studentAssessment", "studentVle_small")})


def engagement_by_result(spark, sf_dir):
    return profile.group_summary(_engaged(_t(spark, sf_dir)), "sum_click", "final_result")


def score_by_result(spark, sf_dir):
    t = _t(spark, sf_dir)
    return flows.score_by_result(t["student_assessment"], t["student_info"])


def category_by_result(spark, sf_dir):
    return profile.multi_cross_counts(_t(spark, sf_dir)["student_info"], ["highest_education", "age_band"], "final_result")


# --- distributions ------------------------------------------------------------

def histogram_score(spark, sf_dir):
    return distributions.histogram(_t(spark, sf_dir)["student_assessment"], "score")


def histogram_clicks(spark, sf_dir):
    return distributions.histogram(features.clicks_per_student(_t(spark, sf_dir)["student_vle"]), "sum_click")


def histogram_credits(spark, sf_dir):
    return distributions.histogram(_t(spark, sf_dir)["student_info"], "studied_credits")


def density_score(spark, sf_dir):
    return distributions.density_curve(_t(spark, sf_dir)["student_assessment"], "score")


def density_clicks(spark, sf_dir):
    return distributions.density_curve(features.clicks_per_student(_t(spark, sf_dir)["student_vle"]), "sum_click")


def box_clicks_by_result(spark, sf_dir):
    return distributions.box_stats(_engaged(_t(spark, sf_dir)), "sum_click", ["final_result"])


def box_score_by_result(spark, sf_dir):
    t = _t(spark, sf_dir)
    return flows.box_score_by_result(t["student_assessment"], t["student_info"])


# --- encoding and split ---------------------------------------------------------

def one_hot_tree(spark, sf_dir):
    return flows.whole_course(_t(spark, sf_dir), LEVELS)["encoded_tree"]


def one_hot_linear(spark, sf_dir):
    return flows.whole_course(_t(spark, sf_dir), LEVELS)["encoded_linear"]


def one_hot_tree_early(spark, sf_dir):
    return flows.early_prediction(_t(spark, sf_dir), CUTOFF_DAY, LEVELS)["encoded_tree"]


def one_hot_linear_early(spark, sf_dir):
    return flows.early_prediction(_t(spark, sf_dir), CUTOFF_DAY, LEVELS)["encoded_linear"]


def one_hot_vector(spark, sf_dir):
    master = materialize(flows.whole_course_master(_t(spark, sf_dir)))
    wide = encode.one_hot_positions(master.withColumn("run", F.concat_ws("|", *K3[:2])))
    return wide.select("run", "id_student", "target", F.array_join("positions", ",").alias("positions"))


def training_frame_whole(spark, sf_dir):
    master = materialize(flows.whole_course_master(_t(spark, sf_dir)))
    return flows.training_splits(master, flows.DROP_WHOLE, LEVELS)


def training_frame_early(spark, sf_dir):
    sample = materialize(flows.early_sample(_t(spark, sf_dir), CUTOFF_DAY))
    return flows.training_splits(sample, flows.DROP_EARLY, LEVELS)


def training_part_early(spark, sf_dir):
    """The features and label of the early training rows (P10)."""
    part = encode.split_views(training_frame_early(spark, sf_dir))["train"]
    return part.select(*[ident(c) for c in encode.feature_columns(part)], "target")


def encoded_null_columns(spark, sf_dir):
    """Missing values of the encoded frame, column by column."""
    return profile.null_counts(one_hot_tree(spark, sf_dir), only_missing=True)


def _split(spark, sf_dir):
    master = materialize(flows.whole_course_master(_t(spark, sf_dir)).select(*K3, "target"))
    return split.stratified_split(master, label="target", key=K3, seed=42)


def stratified_split(spark, sf_dir):
    return _split(spark, sf_dir).select(*K3, "target", "split")


def split_sizes(spark, sf_dir):
    return split.split_sizes(_split(spark, sf_dir))


def split_class_shares(spark, sf_dir):
    return split.split_class_shares(_split(spark, sf_dir))


# --- reports of the two end-to-end flows ----------------------------------------

def report_whole_course(spark, sf_dir):
    return flows.whole_course(_t(spark, sf_dir), LEVELS)["report"]


def report_early(spark, sf_dir):
    out = flows.early_prediction(_t(spark, sf_dir), CUTOFF_DAY, LEVELS)
    effect = out["filter_effect"].select(
        F.explode(
            F.array(
                F.struct(F.lit("rows_before_filter").alias("item"), F.col("rows_before").cast("double").alias("value")),
                F.struct(F.lit("rows_removed").alias("item"), F.col("rows_removed").cast("double").alias("value")),
            )
        ).alias("r")
    ).select("r.item", "r.value")
    dups = out["duplicates"].select(F.lit("duplicate_keys").alias("item"), F.col("n_duplicates").cast("double").alias("value"))
    return out["report"].unionByName(effect).unionByName(dups)


def registrations_through_csv(spark, sf_dir):
    """Written as CSV (header, no index) and read back into the schema."""
    path = f"{shared_folder(spark)}/tutorlens/{uuid.uuid4().hex}"
    write_table(_t(spark, sf_dir)["student_registration"], path, fmt="csv")
    return read_table(spark, path, STUDENT_REGISTRATION, fmt="csv")


def clicks_written(spark, sf_dir):
    """C14/S3: the click totals as later steps read them."""
    return flows.shrink_clicks(_t(spark, sf_dir)["student_vle"])


def explore_clicks(spark, sf_dir):
    """Clicks by result over the written click totals, as the exploration flow reads them (S3)."""
    t = _t(spark, sf_dir)
    return profile.group_summary(flows.engaged(t["student_info"], flows.shrink_clicks(t["student_vle"])), "sum_click", "final_result")


# --- stored, incremental and fitted forms -----------------------------------------

def _folder(spark) -> str:
    return f"{shared_folder(spark)}/tutorlens/{uuid.uuid4().hex}"


def master_of_buckets(spark, sf_dir):
    """C9 from feature tables stored bucketed by enrolment."""
    stored = flows.store_features(_t(spark, sf_dir), _folder(spark), f"tutorlens_{uuid.uuid4().hex}", buckets=8)
    return flows.master_of_stored(stored)


def clicks_incremental(spark, sf_dir):
    """C14: totals of clicks that came in four batches: late ones, out of order, some twice, with a compaction between."""
    log, store = _t(spark, sf_dir)["student_vle"], _folder(spark)
    batch = F.pmod(F.hash("id_student", "date", "id_site"), F.lit(4))
    for number in (2, 0, 2, 3, None, 1, 0, 3):
        if number is None:
            increments.compact(spark, store)
        else:
            increments.add_batch(log.where(batch == number), store, f"day-{number}")
    return increments.click_totals(spark, store)


def next_term_prepared(spark, sf_dir):
    """The last presentation, prepared as was learned from the ones before it; the model goes through its files."""
    master = materialize(flows.unfilled_master(_t(spark, sf_dir)))
    last = master.agg(F.max("code_presentation")).first()[0]
    path = _folder(spark)
    Preparation().fit(master.where(F.col("code_presentation") < F.lit(last))).write().overwrite().save(path)
    return PreparationModel.load(path).transform(master.where(F.col("code_presentation") == F.lit(last)))


def _parted_registrations(spark, sf_dir):
    """The registrations as CSV, among them lines cut short, with a field too many, and with a day that is no number."""
    table, path = _t(spark, sf_dir)["student_registration"], _folder(spark)
    write_table(table, f"{path}/registrations", fmt="csv")
    fields = "code_module, code_presentation, CAST(id_student AS STRING)"
    bad = table.where("id_student % 5 = 0").selectExpr(
        f"""CASE pmod(id_student, 3) WHEN 0 THEN concat_ws(',', {fields})
        WHEN 1 THEN concat_ws(',', {fields}, '1', '2', '3') ELSE concat_ws(',', {fields}, 'soon', '') END AS value"""
    )
    header = spark.createDataFrame([(",".join(table.columns),)], "value string")
    header.unionAll(bad).coalesce(1).write.mode("append").text(f"{path}/registrations")
    return read_parted(spark, f"{path}/registrations", STUDENT_REGISTRATION, f"{path}/parted")


def registrations_good(spark, sf_dir):
    """The good rows of a CSV table with bad lines."""
    return _parted_registrations(spark, sf_dir).good


def registrations_bad(spark, sf_dir):
    """The bad lines put aside, with their reasons."""
    return _parted_registrations(spark, sf_dir).bad.select("line", "reason")


def _explored(report: str) -> Query:
    """One report of the exploration flow, as the flow itself makes it (from the written click totals)."""

    def query(spark, sf_dir):
        return flows.explore(_t(spark, sf_dir), reports=[report])[report]

    query.__name__ = f"explored_{report}"
    return query


#: The reports of the exploration flow, each with the query that has the same SQL.
EXPLORED = {
    "profile": "table_profile",
    "previews": "previews",
    "null_counts": "null_counts",
    "describe": "describe_numeric",
    "value_counts": "value_counts_percent",
    "histogram_credits": "histogram_credits",
    "histogram_score": "histogram_score",
    "histogram_clicks": "histogram_clicks",
    "density_score": "density_score",
    "density_clicks": "density_clicks",
    "engagement_by_result": "engagement_by_result",
    "box_clicks_by_result": "box_clicks_by_result",
    "score_by_result": "score_by_result",
    "box_score_by_result": "box_score_by_result",
    "category_by_result": "category_by_result",
}


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in [
        clicks_per_student, clicks_by_enrolment, assessment_dates_filled, info_imd_filled,
        submissions_not_banked, registration_median_filled, cleaning_report, early_engagement,
        scores_by_enrolment, assessments_due, early_assessment, master_whole_course, master_early,
        active_students, active_filter_effect, target_encoded, class_balance, value_counts_percent,
        null_counts, master_null_columns, duplicate_keys, duplicate_key_groups, enrolment_duplicates,
        table_profile, preview, describe_numeric, engagement_by_result, score_by_result,
        category_by_result, histogram_score, histogram_clicks, histogram_credits, density_score,
        density_clicks, box_clicks_by_result, box_score_by_result, one_hot_tree, one_hot_linear,
        one_hot_vector, stratified_split, split_sizes, split_class_shares, report_whole_course,
        report_early, previews, describe_clicks, education_by_result, one_hot_tree_early, one_hot_linear_early,
        training_frame_whole, training_frame_early, training_part_early, encoded_null_columns, explore_clicks,
        registrations_through_csv, clicks_written, master_of_buckets, clicks_incremental, next_term_prepared,
        registrations_good, registrations_bad,
        *map(_explored, EXPLORED),
    ]
}
