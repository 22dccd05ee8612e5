"""The pandas-vs-Spark rules, each on a few hand-made rows."""

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tutorlens.functions import map_lookup, nan_to_null, round_half_even, safe_divide, sum_or_zero
from tutorlens.functions.lookup import TARGET_CODES
from tutorlens.operators import encode, features, profile
from tutorlens.operators.clean import fill_median


def test_nan_becomes_null_so_cutoff_filters_it(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 100.0), (3, 5.0)], "id int, d double")
    raw = df.where(F.col("d") > 90).count()
    clean = df.select("id", nan_to_null("d").alias("d")).where(F.col("d") > 90).count()
    assert raw == 2  # NaN > 90 is true in Spark
    assert clean == 1  # as in pandas


def test_group_by_drops_missing_keys(spark):
    vle = spark.createDataFrame(
        [("A", "P", 1, 1, 0, 3), (None, "P", 1, 1, 0, 4), ("A", "P", 1, 2, 1, 5)],
        "code_module string, code_presentation string, id_student long, id_site long, date int, sum_click long",
    )
    out = features.engagement_features(vle).collect()
    assert [(r.code_module, r.total_clicks) for r in out] == [("A", 8)]


def test_sum_of_all_missing_is_zero(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 3)], "k int, v long")
    got = {r.k: r.s for r in df.groupBy("k").agg(sum_or_zero("v").alias("s")).collect()}
    assert got == {1: 0, 2: 3}


def test_mean_of_all_missing_keeps_group(spark):
    sub = spark.createDataFrame(
        [(10, 1, 5, 0, None), (10, 1, 6, 0, None), (11, 2, 5, 0, 40.0)],
        "id_assessment long, id_student long, date_submitted int, is_banked int, score double",
    )
    ass = spark.createDataFrame(
        [("A", "P", 10, "TMA", 5.0), ("A", "P", 11, "TMA", 9.0)],
        "code_module string, code_presentation string, id_assessment long, assessment_type string, date double",
    )
    got = {r.id_student: (r.mean_score, r.num_submissions) for r in features.assessment_features(sub, ass).collect()}
    assert got == {1: (None, 0), 2: (40.0, 1)}


def test_half_even_rounding(spark):
    df = spark.createDataFrame([(0.0625,), (0.0635,), (2.5,)], "x double")
    got = [r.r for r in df.select(round_half_even("x", 3).alias("r")).collect()]
    assert got == [0.062, 0.064, 2.5]
    assert round(pd.Series([0.0625]).round(3)[0], 3) == 0.062


def test_value_counts_order_and_share(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,), ("c",), ("c",)], "x string")
    rows = profile.value_counts(df, "x", normalize="share").collect()
    assert [(r.value, r["count"], r.share) for r in rows] == [("b", 2, 0.4), ("c", 2, 0.4), ("a", 1, 0.2)]
    expected = pd.Series(["a", "b", "b", None, "c", "c"]).value_counts(normalize=True)
    assert math.isclose(expected["b"], 0.4)


def test_duplicates_treat_missing_keys_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2), (3, 4), (3, 4), (3, 4)], "a int, b int")
    row = profile.duplicate_keys(df, ["a", "b"]).first()
    pdf = pd.DataFrame({"a": [1, 1, 1, 3, 3, 3], "b": [None, None, 2, 4, 4, 4]})
    assert row.n_duplicates == int(pdf.duplicated(subset=["a", "b"]).sum()) == 3
    assert (row.n_rows, row.n_keys) == (6, 3)


def test_unknown_label_maps_to_null(spark):
    df = spark.createDataFrame([("Pass",), ("Withdrawn",), ("Other",), (None,)], "final_result string")
    got = [r.t for r in df.select(map_lookup("final_result", TARGET_CODES).alias("t")).collect()]
    assert got == [0, 3, None, None]


def test_safe_divide_gives_null_not_error(spark):
    df = spark.createDataFrame([(3, 0), (3, 2), (1, None)], "a long, b long")
    got = [r.q for r in df.select(safe_divide("a", "b").alias("q")).collect()]
    assert got == [None, 1.5, None]


def test_one_hot_matches_get_dummies(spark):
    rows = [("x", "b", 1.0, None), ("y", "a", 2.0, "k"), ("x", None, 3.0, "m"), ("z", "b", 4.0, "k")]
    schema = "c1 string, c2 string, num double, c3 string"
    df = spark.createDataFrame(rows, schema)
    pdf = pd.DataFrame(rows, columns=["c1", "c2", "num", "c3"])
    cols = ["c1", "c2", "c3"]
    for drop_first in (False, True):
        got = encode.one_hot(df, encode.discover_levels(df, cols), cols, drop_first=drop_first).toPandas()
        want = pd.get_dummies(pdf, columns=["c1", "c2", "c3"], drop_first=drop_first)
        assert list(got.columns) == list(want.columns)
        for c in want.columns:
            assert list(got[c]) == list(want[c]), c


def test_one_hot_positions_carry_the_same_information(spark):
    rows = [("x", "b"), ("y", "a"), ("x", None), ("z", "b")]
    df = spark.createDataFrame(rows, "c1 string, c2 string").withColumn("id", F.monotonically_increasing_id())
    cols = ["c1", "c2"]
    for drop_first in (False, True):
        wide = encode.one_hot(df, encode.discover_levels(df, cols), cols, drop_first).orderBy("id").collect()
        got = encode.one_hot_positions(df, cols, drop_first).orderBy("id").collect()
        for w, v in zip(wide, got):
            assert [k for k, flag in enumerate(w[1:]) if flag] == list(v.positions)


def test_one_hot_positions_of_many_levels(spark):
    df = spark.range(10000).selectExpr("id", "IF(id % 3 = 0, 'hot', concat('v', id % 5000)) AS c", "CAST(id % 2 AS STRING) AS d")
    levels = sorted({"hot", *(f"v{i % 5000}" for i in range(10000) if i % 3)})
    place = {v: k for k, v in enumerate(levels)}
    got = encode.one_hot_positions(df, ["c", "d"])
    for r in got.collect():
        want = "hot" if r.id % 3 == 0 else f"v{r.id % 5000}"
        assert r.positions == [place[want], len(levels) + r.id % 2]


def test_median_fill_uses_exact_interpolated_median(spark):
    df = spark.createDataFrame([(1.0,), (None,), (4.0,), (10.0,), (2.0,)], "d double")
    got = sorted(r.d for r in fill_median(df, "d").collect())
    assert got == sorted([1.0, 3.0, 4.0, 10.0, 2.0])  # median of 1,2,4,10 = 3


def test_left_join_of_enrolment_keeps_row_count(spark, sf001):
    from tutorlens.plans import flows
    from tutorlens.sources.fixtures import fixture_tables

    t = fixture_tables(spark, sf001)
    master = flows.whole_course_master(t)
    assert master.count() == t["student_info"].count()
    filled = ["total_clicks", "mean_score", "num_submissions"]
    assert master.where(" OR ".join(f"{c} IS NULL" for c in filled)).count() == 0


def test_submission_rate_can_exceed_one(spark, sf001):
    from tutorlens.plans import flows
    from tutorlens.sources.fixtures import fixture_tables

    t = flows.cleaned(fixture_tables(spark, sf001), add_unregistered=False)
    rates = features.assessment_features(t["student_assessment"], t["assessments"], 14)
    assert rates.where(F.col("submission_rate") > 1).count() == 34


def test_schema_types(spark):
    sch = T.StructType([T.StructField("x", T.DoubleType())])
    df = spark.createDataFrame([(float("nan"),)], sch)
    assert df.select(nan_to_null("x")).first()[0] is None


def test_ties_rank_numbers_as_numbers(spark):
    df = spark.createDataFrame([(10, "b"), (2, "a"), (2, "b"), (10, "a")], "n int, s string")
    rows = profile.multi_value_counts(df, ["n", "s"]).collect()
    assert [(r.variable, r.value) for r in rows] == [("n", "2"), ("n", "10"), ("s", "a"), ("s", "b")]


def test_label_with_only_missing_values_keeps_its_row(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None)], "k string, v double")
    got = {r.k: (r.mean_value, r.median_value) for r in profile.group_summary(df, "v", "k").collect()}
    assert got == {"a": (2.0, 2.0), "b": (None, None)}


def test_names_with_quotes(spark):
    df = spark.createDataFrame([(1, None), (None, 2.5)], "`it's` int, `a``b` double")
    assert [(r.column_name, r.null_count) for r in profile.null_counts(df).orderBy("position").collect()] == [("it's", 1), ("a`b", 1)]
    assert profile.describe_tables({"t's": df}).count() == 2


def test_cutoff_must_be_positive(spark, sf001):
    from tutorlens.sources.fixtures import fixture_tables

    with pytest.raises(ValueError):
        features.engagement_features(fixture_tables(spark, sf001)["student_vle"], 0)


@pytest.mark.parametrize("folder", ["sf001", "sf01"])
def test_every_click_of_a_known_student_counts(spark, request, folder):
    from tutorlens.sources.fixtures import fixture_tables

    t = fixture_tables(spark, request.getfixturevalue(folder))
    known = t.raw("events").join(t.raw("customer").selectExpr("c_custkey AS user_id"), "user_id", "left_semi").count()
    assert t["student_vle"].count() == known > 0


def test_explore_outputs_run(spark, sf001):
    from tutorlens.plans import flows
    from tutorlens.sources.fixtures import fixture_tables

    out = flows.explore(fixture_tables(spark, sf001))
    for name, df in out.items():
        assert df.count() >= 1, name
