"""Quantiles, histogram, density and box statistics against brute force (numpy)."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tutorlens.operators import distributions, profile
from tutorlens.operators.quantiles import median_of, quantiles


def _np_box(x, whis=1.5):
    x = np.asarray(sorted(x), dtype=float)
    q1, med, q3 = np.percentile(x, [25, 50, 75])
    iqr = q3 - q1
    lo, hi = q1 - whis * iqr, q3 + whis * iqr
    inside_hi = x[x <= hi]
    whi = q3 if len(inside_hi) == 0 or inside_hi.max() < q3 else inside_hi.max()
    inside_lo = x[x >= lo]
    wlo = q1 if len(inside_lo) == 0 or inside_lo.min() > q1 else inside_lo.min()
    out = int(((x < wlo) | (x > whi)).sum())
    return q1, med, q3, wlo, whi, out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_quantiles_match_numpy(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for g in ["a", "b", "c"]:
        n = rnd.randint(1, 400)
        for _ in range(n):
            kind = rnd.random()
            v = rnd.randint(-50, 50) if kind < 0.5 else rnd.gauss(0, 1e6) if kind < 0.8 else 7.0
            rows.append((g, float(v)))
        rows.append((g, None))
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {r.g: r for r in quantiles(df, "v", probs, by=["g"], buckets=64).collect()}
    for g in ["a", "b", "c"]:
        xs = [v for gg, v in rows if gg == g and v is not None]
        want = np.percentile(xs, [p * 100 for p in probs])
        for i, w in enumerate(want):
            assert math.isclose(got[g][f"q{i}"], w, rel_tol=1e-12, abs_tol=1e-9), (g, probs[i])


def test_global_median_and_single_value(spark):
    df = spark.createDataFrame([(5.0,)], "v double")
    assert spark.range(1).select(median_of(df, "v")).first()[0] == 5.0
    df2 = spark.createDataFrame([(float(i),) for i in [3, 1, 2, 10]], "v double")
    assert spark.range(1).select(median_of(df2, "v")).first()[0] == 2.5


def test_hot_group_quantiles(spark):
    # One group holds most rows; the answer must not depend on it fitting one task.
    rows = [("hot", float(i % 997)) for i in range(20000)] + [("cold", 1.0), ("cold", 3.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.q0 for r in quantiles(df, "v", [0.5], by=["g"], buckets=16).collect()}
    assert got["cold"] == 2.0
    assert got["hot"] == np.percentile([v for g, v in rows if g == "hot"], 50)


def test_histogram_matches_numpy(spark):
    rnd = random.Random(7)
    xs = [rnd.choice([0.0, 100.0]) if i % 50 == 0 else rnd.uniform(0, 100) for i in range(3000)] + [None]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = distributions.histogram(df, "x").orderBy("bin").collect()
    counts, edges = np.histogram([x for x in xs if x is not None], bins=30)
    assert [r["count"] for r in got] == list(counts)
    assert [r.bin_start for r in got] == list(edges[:-1])
    assert got[-1].bin_end == edges[-1]
    assert sum(r["count"] for r in got) == len(xs) - 1


def test_histogram_constant_column(spark):
    df = spark.createDataFrame([(4.0,), (4.0,)], "x double")
    got = distributions.histogram(df, "x").orderBy("bin").collect()
    counts, edges = np.histogram([4.0, 4.0], bins=30)
    assert [r["count"] for r in got] == list(counts)
    assert got[0].bin_start == edges[0] == 3.5


def test_density_matches_gaussian_kde(spark):
    rnd = random.Random(3)
    xs = [float(rnd.randint(0, 40)) for _ in range(500)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = distributions.density_curve(df, "x", digits=None).orderBy("point").collect()
    a = np.asarray(xs)
    n, sd = len(a), a.std(ddof=1)
    h = sd * n ** (-0.2)
    grid = np.linspace(a.min(), a.max(), 200)
    pdf = np.exp(-0.5 * ((grid[:, None] - a[None, :]) / h) ** 2).sum(axis=1) / (n * h * math.sqrt(2 * math.pi))
    assert len(got) == 200
    for r, g, d in zip(got, grid, pdf):
        assert math.isclose(r.x, g, rel_tol=1e-12, abs_tol=1e-12)
        assert math.isclose(r.density, d, rel_tol=1e-9)
        assert math.isclose(r.scaled, d * n * (a.max() - a.min()) / 30, rel_tol=1e-9)


def test_density_singular_sample_is_empty(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert distributions.density_curve(df, "x").count() == 0


def test_box_stats_match_matplotlib_rule(spark):
    rnd = random.Random(11)
    rows = [("a", float(rnd.randint(0, 30))) for _ in range(300)] + [("a", 500.0), ("a", -300.0)]
    rows += [("b", float(v)) for v in [1, 2, 3, 4, 100]]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r for r in distributions.box_stats(df, "v", ["g"], digits=None).collect()}
    for g in ["a", "b"]:
        q1, med, q3, wlo, whi, out = _np_box([v for gg, v in rows if gg == g])
        r = got[g]
        assert (r.q1, r.median, r.q3, r.whisker_low, r.whisker_high, r.n_outliers) == (q1, med, q3, wlo, whi, out)


def test_describe_numeric_matches_pandas(spark):
    import pandas as pd

    pdf = pd.DataFrame({"a": [1, 2, 3, 4, 100], "b": [0.5, None, 2.5, 2.5, 9.0]})
    # Built from tuples: a pandas NaN would arrive as a double NaN, not a null.
    rows = [(1, 0.5), (2, None), (3, 2.5), (4, 2.5), (100, 9.0)]
    df = spark.createDataFrame(rows, "a long, b double")
    got = {r.column_name: r for r in profile.describe_numeric(df, digits=None).collect()}
    want = pdf.describe()
    for c in ["a", "b"]:
        w = want[c]
        r = got[c]
        assert r["count"] == w["count"]
        for k, kk in [("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")]:
            assert math.isclose(r[k], w[kk], rel_tol=1e-12), (c, k)


def test_cross_counts_wide_fills_zero(spark):
    df = spark.createDataFrame([("x", "Pass"), ("x", "Fail"), ("y", "Pass")], "cat string, final_result string")
    wide = {r.cat: r for r in profile.cross_counts(df, "cat", "final_result", ["Pass", "Fail"]).collect()}
    assert (wide["y"].Pass, wide["y"].Fail) == (1, 0)


def test_values_are_not_collected(spark):
    # Plans for quantiles contain no collect_list/percentile over raw values.
    df = spark.range(1000).select((F.col("id") % 37).cast("double").alias("v"))
    plan = quantiles(df, "v", [0.5])._jdf.queryExecution().executedPlan().toString()
    assert "percentile(" not in plan
