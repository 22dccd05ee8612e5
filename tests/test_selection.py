"""Rank selection, fast Gauss sums and grouping sets against brute force, and what they shuffle."""

import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from tutorlens.operators import distributions, features, profile, selection
from tutorlens.operators.quantiles import quantiles
from test_plans import _count, _nodes


def order_form(v):
    """The bit pattern of a double as an integer in the order of the numbers."""
    (bits,) = struct.unpack(">q", struct.pack(">d", abs(v)))
    return -bits - 1 if v < 0 else bits


def odd_doubles():
    rnd = random.Random(5)
    out = [0.0, 1.0, 0.1, 100.0, 5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, 2.0**53, 2.0**53 + 2, 1e300, 1e-300]
    for e in (-1074, -1073, -1050, -1022, -1021, -500, -60, -1, 0, 1, 10, 52, 53, 62, 63, 64, 500, 1023):
        p = math.ldexp(1.0, e)
        out += [p, math.nextafter(p, 0), math.nextafter(p, math.inf)]
    out += [struct.unpack(">d", struct.pack(">q", rnd.getrandbits(63) % 0x7FEFFFFFFFFFFFFF))[0] for _ in range(3000)]
    return out + [-v for v in out if v]


def test_order_form_is_the_bit_pattern(spark):
    values = odd_doubles()
    df = spark.createDataFrame([(v,) for v in values] + [(math.inf,), (-math.inf,), (math.nan,), (-0.0,), (None,)], "_v double")
    got = {r["_v"]: (r["_k"], r["_o"], r["_b1"]) for r in selection.with_order_bits(df, moments=True).collect() if r["_v"] is not None and not math.isnan(r["_v"])}
    for v in values:
        assert got[v][0] == order_form(v), v
        # the value that the bucket's values have in common: the low bits of the mantissa cut
        e = max(-1022, math.frexp(v)[1] - 1) if v else -1022
        low = selection.FIRST if e >= selection.UNITS else min(selection.FIRST, 52 - e)
        assert got[v][2] == order_form(v) >> low << low
        cut = order_form(abs(v)) >> low << low
        assert got[v][1] == math.copysign(struct.unpack(">d", struct.pack(">q", cut))[0], v) or got[v][1] == 0 == cut
    assert got[math.inf][0] == order_form(math.inf) and got[-math.inf][0] == order_form(-math.inf) and got[0.0][0] == 0
    rest = [r["_k"] for r in selection.with_order_bits(df).where("isnan(_v) OR _v IS NULL").collect()]
    assert sorted(rest, key=lambda k: k is None) == [order_form(math.inf) + 1, None]


PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


def check_quantiles(spark, rows, many_groups=False, weight=None):
    df = spark.createDataFrame(rows, "g string, v double, w long").repartition(4)
    got = {r.g: r for r in quantiles(df, "v", PROBS, by=["g"], weight=weight, moments=True, many_groups=many_groups).collect()}
    want = {}
    for g, v, w in rows:
        if g is not None and v is not None:
            want.setdefault(g, []).extend([v] * (w if weight else 1))
    assert got.keys() == want.keys()
    for g, xs in want.items():
        xs = np.sort(np.array(xs))
        for i, p in enumerate(PROBS):
            at = (len(xs) - 1) * p
            lo, hi = xs[math.floor(at)], xs[math.ceil(at)]
            assert got[g][f"q{i}"] == lo + (hi - lo) * (at - math.floor(at)), (g, p)
        assert (got[g]["n"], got[g]["min"], got[g]["max"]) == (len(xs), xs[0], xs[-1])
        assert math.isclose(got[g]["mean"], xs.mean(), rel_tol=1e-12, abs_tol=1e-12 * np.abs(xs).max())
        if len(xs) > 1:
            # (the value counts' buckets are wide where other values are far apart)
            assert math.isclose(got[g]["std"], xs.std(ddof=1), rel_tol=1e-9, abs_tol=(1e-7 if many_groups else 1e-12) * np.abs(xs).max())
        else:
            assert got[g]["std"] is None


def test_selected_quantiles_match_sorting(spark):
    rnd = random.Random(1)
    rows = []
    for i in range(600):
        rows += [("far", rnd.choice([-1, 1]) * 10.0 ** rnd.uniform(-200, 100), 1), ("ints", float(rnd.randint(-5, 5)), rnd.randint(1, 4))]
        # values that agree in the first 24 bits, and some in the first 44
        rows += [("close", 1000.0 + rnd.random() * 1e-3, 2), ("closest", 1.0 + rnd.randint(0, 400) * 2.0**-50, 1), ("ids", 1e9 + i, 1)]
    rows += [("one", -3.5, 3), ("none", None, 1), (None, 1.0, 1), ("none", None, 2), ("zeros", 0.0, 1), ("zeros", -0.0, 1), ("ints", None, 1)]
    check_quantiles(spark, rows)
    check_quantiles(spark, rows, weight="w")
    check_quantiles(spark, rows, many_groups=True)


def test_groups_without_values_and_too_many_groups(spark, monkeypatch):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.5), ("b", None)], "g string, v double")
    got = {r.g: r.q0 for r in quantiles(df, "v", [0.5], by=["g"], keep_groups=True).collect()}
    assert got == {"a": 1.75, "b": None}
    assert quantiles(df.where("v IS NULL"), "v", [0.5]).collect() == []
    wide = spark.range(400).selectExpr("id % 50 AS g", "1000 + CAST(id AS DOUBLE) / 1e6 AS v")
    few = selection.selected_quantiles(wide, "v", [0.5], by=["g"], max_groups=50)
    assert few.count() == 50
    with pytest.raises(Exception, match="more than 49 groups"):
        selection.selected_quantiles(wide, "v", [0.25], by=["g"], max_groups=49).collect()


def test_whole_numbers_have_a_bucket_each(spark):
    n = 1 << selection.UNITS
    df = spark.range(-n, n).selectExpr("CAST(id AS DOUBLE) AS _v")
    assert selection.with_order_bits(df).select("_b1").distinct().count() == 2 * n
    far = spark.range(n, 9 * n).selectExpr("CAST(id AS DOUBLE) AS _v")
    assert selection.with_order_bits(far).select("_b1").distinct().count() <= 4 * 4096


def written(spark, tmp_path, sql, n=400_000):
    path = str(tmp_path / "t")
    spark.range(0, n, 1, 8).selectExpr(sql).write.parquet(path)
    return spark.read.parquet(path)


def shuffled(nodes):
    """Rows that exchanges wrote."""
    return sum(n.metrics().apply("shuffleRecordsWritten").value() for n in nodes if n.nodeName() == "Exchange")


class Jobs:
    """Plans that run below, and the rows that their exchanges write."""

    def __init__(self, monkeypatch):
        from pyspark.sql.classic.dataframe import DataFrame

        self.nodes, collect = [], DataFrame.collect

        def watched(df):
            out = collect(df)
            with monkeypatch.context() as m:
                m.setattr(DataFrame, "collect", lambda df: out)
                self.nodes.append(_nodes(df))
            return out

        monkeypatch.setattr(DataFrame, "collect", watched)


def test_distinct_ids_are_not_shuffled(spark, tmp_path, monkeypatch):
    n = 400_000
    df = written(spark, tmp_path, "CAST(id * 7919 % 400009 AS DOUBLE) * 1024 + 1e9 AS v", n)
    jobs = Jobs(monkeypatch)
    q = quantiles(df, "v", [0.25, 0.5, 0.75], moments=True)
    values = np.sort((np.arange(n) * 7919 % 400009) * 1024.0 + 1e9)
    assert list(q.first())[:3] == list(np.quantile(values, [0.25, 0.5, 0.75]))
    passes = [nodes for nodes in jobs.nodes if _count(nodes, "Scan parquet")]
    assert 1 < len(passes) <= 3
    # a few thousand buckets for each of 8 tasks, where the value counts alone would be 400,000 rows
    assert sum(map(shuffled, passes)) < 60_000
    old = quantiles(df, "v", [0.25, 0.5, 0.75], moments=True, many_groups=True)
    assert shuffled(_nodes(old)) > n


def test_later_passes_take_bits_of_open_buckets_only(spark, monkeypatch):
    """With the bits as keys of a semi join, the optimizer put their whole expression, many times over, into every row's path."""
    from pyspark.sql.classic.dataframe import DataFrame

    rnd = random.Random(9)
    rows = [("ids", float(400_000 + i * 7 % 5003)) for i in range(5003)]
    rows += [("low", -(1.0 + rnd.randint(0, 900) * 2.0**-50)) for _ in range(700)]  # the third pass, below zero
    rows += [("odd", v) for v in [math.inf] * 4 + [math.nan] * 3 + [0.0, -0.0, 5e-324]] + [("nan", math.nan)] * 3
    plans, collect = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda df: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), collect(df))[1])
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    probs = [0.0, 0.25, 0.5, 1.0]
    got = {r.g: list(r)[1:5] for r in selection.selected_quantiles(df, "v", probs, by=["g"]).collect()}
    for g in ("ids", "low"):
        xs = np.sort(np.array([v for k, v in rows if k == g]))
        assert got[g] == list(np.quantile(xs, probs))
    assert got["odd"][:2] == [0.0, math.inf] or math.isnan(got["odd"][1])  # (infinity less infinity)
    assert math.isnan(got["odd"][3]) and all(map(math.isnan, got["nan"]))
    passes = [p for p in plans if "LOG2" in p.upper()]
    assert len(passes) == 3
    assert all(p.upper().count("LOG2") == 1 for p in passes)


def test_explored_describe_of_large_ids(spark, monkeypatch):
    """Ids from 2^17 on need the second pass, which computes the bits once for each row of an open bucket."""
    from pyspark.sql.classic.dataframe import DataFrame
    from tutorlens.plans import flows

    n = 3000
    some = spark.range(n).selectExpr("id * 911 % 3001 + 500000 AS id_student", "CAST(id % 7 AS DOUBLE) AS score", "id % 5 AS sum_click")
    names = ("student_info", "student_assessment", "assessments", "courses", "student_registration", "vle")
    tables = {name: some.select("id_student", "score") for name in names} | {"student_vle": some.select("id_student", "sum_click")}
    plans, collect = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda df: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), collect(df))[1])
    got = {(r.table_name, r.column_name): r for r in flows.explore(tables, reports=["describe"])["describe"].collect()}
    ids = np.arange(n) * 911 % 3001 + 500000.0
    for table in ("studentInfo", "studentAssessment", "studentVle_small"):
        r = got[table, "id_student"]
        assert (r["count"], r["min"], r["max"]) == (n, ids.min(), ids.max())
        assert [r.p25, r.p50, r.p75] == list(np.quantile(ids, [0.25, 0.5, 0.75]))
    assert len(got) == 6
    passes = [p for p in plans if "LOG2" in p.upper()]
    assert len(passes) == 2 and all(p.upper().count("LOG2") <= 3 for p in passes)  # once for each of the stacked tables


def test_few_values_need_one_pass(spark, tmp_path, monkeypatch):
    df = written(spark, tmp_path, "CAST(id % 321 AS DOUBLE) AS v", 5000)
    for by in ([], ["v"]):
        jobs = Jobs(monkeypatch)
        quantiles(df, "v", [0.25, 0.5], by=by, names=["a", "b"])
        assert len(jobs.nodes) == 1


def test_density_of_far_and_many_values(spark, tmp_path):
    rnd = np.random.default_rng(3)
    for xs in (rnd.normal(size=3000), np.append(rnd.normal(size=2000), [60.0, -45.0, 1000.0]), rnd.integers(0, 5, 800) * 1.0, 1e9 + rnd.random(500)):
        df = spark.createDataFrame([(float(x),) for x in xs] + [(None,)], "v double")
        got = distributions.density_curve(df, "v", digits=None).orderBy("point").collect()
        n, h = len(xs), xs.std(ddof=1) * len(xs) ** -0.2
        grid = np.linspace(xs.min(), xs.max(), 200)
        want = np.exp(-0.5 * ((grid[:, None] - xs[None, :]) / h) ** 2).sum(axis=1) / (n * h * math.sqrt(2 * math.pi))
        assert np.abs(np.array([r.density for r in got]) - want).max() <= 1e-12 * want.max() + 1e-7 * (xs.max() > 1e8)


def test_density_shuffles_cells_not_values(spark, tmp_path):
    df = written(spark, tmp_path, "CAST(hash(id) AS DOUBLE) AS v", 200_000)
    nodes = _nodes(distributions.density_curve(df, "v"))
    assert _count(nodes, "Scan parquet") == 1  # beside the pass for the range and spread
    assert shuffled(nodes) < 20_000


def test_hermite_polynomials():
    rows = distributions._hermite(6)
    assert rows == [[1], [0, 1], [-1, 0, 1], [0, -3, 0, 1], [3, 0, -6, 0, 1], [0, 15, 0, -10, 0, 1]]


def test_early_engagement_expands_nothing(spark):
    df = spark.createDataFrame(
        [("A", "P", 1, 5, 3, 2), ("A", "P", 1, 5, 4, 1), ("A", "P", 1, 6, 4, None), ("A", "P", 1, None, None, 9), ("A", "P", 2, 7, -3, 1), ("A", "P", 2, 7, 15, 1)],
        "code_module string, code_presentation string, id_student long, id_site long, date int, sum_click long",
    )
    out = features.engagement_features(df, 14)
    got = {r.id_student: tuple(r)[3:] for r in out.collect()}
    assert got == {1: (3, 2, 2, 3 / 14.0, 10), 2: (1, 1, 1, 1 / 14.0, 17)}
    nodes = _nodes(out)
    assert _count(nodes, "Expand") == 0 and _count(nodes, "Exchange") == 1


def test_column_counts_match_plain_counts(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice(["x", "y", None]), rnd.choice([2, 10, None]), rnd.choice(["P", "F", None])) for _ in range(500)]
    df = spark.createDataFrame(rows, "a string, b int, h string").repartition(4)
    got = sorted((r["variable"], r["value"], r["count"]) for r in profile.column_counts(df, ["a", "b", "h"]).collect())
    want = sorted((c, str(v), sum(r[i] == v for r in rows)) for i, c in enumerate("abh") for v in {r[i] for r in rows} - {None})
    assert got == want
    both = profile.multi_cross_counts(df, ["a", "b"], "h").collect()
    want = [(c, str(v), h, sum(r[i] == v and r[2] == h for r in rows)) for i, c in enumerate("ab") for v in sorted({r[i] for r in rows} - {None}) for h in ("F", "P")]
    assert [tuple(r) for r in both] == want  # in this order: 2 before 10
    nodes = _nodes(profile.column_counts(df, ["a", "b", "h"]))
    assert _count(nodes, "Expand") == 1 and _count(nodes, "Generate") == 0


def test_group_reports_are_sorted(spark):
    rows = [("c", "x", 1.0), ("a", "y", 2.0), ("b", "x", None), ("a", "x", 4.0)]
    df = spark.createDataFrame(rows, "g string, h string, v double").repartition(4)
    assert [tuple(r) for r in profile.group_summary(df, "v", "g").collect()] == [("a", 3.0, 3.0), ("b", None, None), ("c", 1.0, 1.0)]
    assert [tuple(r) for r in profile.cross_counts(df, "g", "h").collect()] == [("a", "x", 1), ("a", "y", 1), ("b", "x", 1), ("c", "x", 1)]
    assert [r["g"] for r in profile.cross_counts(df, "g", "h", ["x", "y"]).collect()] == ["a", "b", "c"]
    from tutorlens.plans.flows import score_by_result

    sub = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 40.0)], "id_student long, score double")
    info = spark.createDataFrame([(1, "W"), (2, "D"), (3, "P"), (1, "D")], "id_student long, final_result string")
    assert [tuple(r) for r in score_by_result(sub, info).collect()] == [("D", 15.0), ("P", 40.0), ("W", 10.0)]
