"""Plan-level checks: pushdown, pruning, shuffle count, no Python or Cartesian nodes."""

import contextlib
import io
import os
import tempfile

import pytest

from tutorlens.keys import K3
from tutorlens.operators import features
from tutorlens.plans import flows, queries
from tutorlens.sources import read_table, write_table
from tutorlens.sources import schemas
from tutorlens.sources.fixtures import fixture_tables


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def stored(spark, sf001):
    """The fixture course tables written once as Parquet, as real inputs would be."""
    out = tempfile.mkdtemp(prefix="tutorlens-stored-")
    t = fixture_tables(spark, sf001)
    paths = {}
    for name, df in t.items():
        stem, _ = schemas.TABLES[name]
        paths[name] = os.path.join(out, f"{stem}.parquet")
        write_table(df, paths[name])
    tables = {}
    for name, p in paths.items():
        schema = schemas.TABLES[name][1]
        tables[name] = read_table(spark, p, schema, fmt="parquet")
    return tables


def test_cutoff_reaches_the_scan_and_columns_are_pruned(spark, stored):
    text = _plan(features.engagement_features(stored["student_vle"], 14))
    assert "LessThanOrEqual(date,14)" in text
    whole = _plan(features.engagement_features(stored["student_vle"]))
    scan = [line for line in whole.splitlines() if line.startswith("ReadSchema")]
    assert scan and "id_site" not in scan[0] and "date" not in scan[0]


def test_master_shuffles_each_input_once(spark, stored):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        master = flows.whole_course_master(stored)
        text = _plan(master)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    k3 = [line for line in text.splitlines() if line.strip().startswith("Arguments: hashpartitioning(code_module") and "id_student" in line]
    # enrolments, click aggregate, score aggregate, registrations: one K3 exchange each;
    # the three joins reuse that layout.
    assert len(k3) == 4, text


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_no_python_udf_and_no_cartesian(spark, sf001, name):
    text = _plan(queries.QUERIES[name](spark, sf001))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text, (name, bad)


def test_enrolment_key_unique_in_master(spark, stored):
    master = flows.early_master(stored, 14)
    assert master.groupBy(*K3).count().where("count > 1").count() == 0


def test_quantile_plan_scans_its_input_once(spark):
    """The value counts feed two branches; their exchange must be reused."""
    from pyspark.sql import functions as F

    from tutorlens.operators.quantiles import quantiles

    df = spark.range(50000).select((F.col("id") % 3).cast("string").alias("g"), (F.col("id") % 997).cast("double").alias("v"))
    for by in (["g"], []):
        q = quantiles(df, "v", [0.25, 0.5], by=by, moments=True, many_groups=True)
        assert _count(_nodes(q), "Range") == 1, by


def _nodes(df) -> list:
    """Nodes of the plan that ran, subqueries included; what is reused counts once."""
    df.collect()
    out, stack, seen = [], [df._jdf.queryExecution().executedPlan()], set()
    while stack:
        n = stack.pop()
        name = n.nodeName()
        if name.startswith("Reused") or n.id() in seen:
            continue
        seen.add(n.id())
        for i in range(n.subqueries().size()):
            stack.append(n.subqueries().apply(i))
        if name.startswith("AdaptiveSparkPlan"):
            stack.append(n.executedPlan())
        elif "QueryStage" in name:
            stack.append(n.plan())
        else:
            out.append(n)
            for i in range(n.children().size()):
                stack.append(n.children().apply(i))
    return out


def _count(nodes, start: str) -> int:
    return sum(n.nodeName().startswith(start) for n in nodes)


def test_split_shuffles_no_row(spark):
    from tutorlens.operators.split import stratified_split

    path = os.path.join(tempfile.mkdtemp(prefix="tutorlens-split-"), "t")
    spark.range(20000).selectExpr("id", "CAST(id % 4 AS INT) AS target", "repeat('x', 20) AS wide").write.parquet(path)
    out = stratified_split(spark.read.parquet(path), key=["id"], hex_digits=2)
    nodes = _nodes(out)
    # thresholds are literals by now: the rows are compared where they stand
    assert {n.nodeName() for n in nodes if not n.nodeName().startswith("WholeStage")} <= {"Scan parquet", "Scan parquet ", "Project", "ColumnarToRow", "InputAdapter", "Filter"}
    assert _count(nodes, "Scan parquet") == 1


def test_histogram_reads_its_input_once(spark):
    from tutorlens.operators import distributions

    path = os.path.join(tempfile.mkdtemp(prefix="tutorlens-chart-"), "t")
    spark.range(5000).selectExpr("CAST(id % 321 AS DOUBLE) AS v").write.parquet(path)
    df = spark.read.parquet(path)
    assert _count(_nodes(distributions.histogram(df, "v")), "Scan parquet") == 1


def test_an_outlier_leaves_no_heavy_window(spark):
    """200,000 different values and one of 1e12: the values ranked in one window stay few."""
    import numpy as np
    from pyspark.sql import functions as F

    from tutorlens.operators import quantiles as Q

    for low in (0.0, 1e9):
        df = spark.range(200000).select((F.col("id") + low).cast("double").alias("v")).unionAll(spark.range(1).select(F.lit(1e12).alias("v")))
        got = Q.quantiles(df, "v", [0.25, 0.5, 0.75], many_groups=True)
        values = np.append(np.arange(200000) + low, 1e12)
        assert list(got.first()) == pytest.approx(list(np.quantile(values, [0.25, 0.5, 0.75])), rel=1e-15)
        nodes = _nodes(got)
        assert _count(nodes, "Range") == 2  # the two branches of the union
        sizes = [_rows_into(n) for n in nodes if n.nodeName() == "Window"]
        assert sizes and max(sizes) <= 3 * 4096, sizes


def _rows_into(node) -> int:
    """Rows that the nearest counting node below has given out."""
    while not node.metrics().contains("numOutputRows"):
        node = node.plan() if "QueryStage" in node.nodeName() else node.children().apply(0)
    return node.metrics().apply("numOutputRows").value()
