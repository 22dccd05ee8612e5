"""Bucketed tables, incremental totals, the fitted preparation and parted CSV files."""

import os
import random
import shutil
import uuid

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel

from tutorlens.keys import K3
from tutorlens.operators import encode, features, increments
from tutorlens.operators.prepare import Preparation, PreparationModel
from tutorlens.plans import flows
from tutorlens.sources import bad_row_report, load_tables, read_parted, read_table, schemas
from tutorlens.sources.buckets import drop_bucketed, write_bucketed
from tutorlens.sources.fixtures import fixture_tables
from test_plans import _count, _nodes


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def test_master_of_stored_tables_shuffles_nothing(spark, sf001, tmp_path):
    tables, prefix = fixture_tables(spark, sf001), f"t{uuid.uuid4().hex}"
    stored = flows.store_features(tables, str(tmp_path), prefix, buckets=5)
    files = [f for f in os.listdir(tmp_path / "info") if f.endswith(".parquet")]
    assert 1 <= len(files) <= 5  # a file for each bucket with rows
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        master = flows.master_of_stored(stored)
        nodes = _nodes(master)
        assert _count(nodes, "Exchange") == 0 and _count(nodes, "SortMergeJoin") == 3
        plain = _nodes(flows.whole_course_master(tables))
        assert _count(plain, "Exchange") >= 4
        assert rows(master) == rows(flows.whole_course_master(tables))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    drop_bucketed(spark, prefix, flows.STORED)
    assert not spark.catalog.tableExists(f"{prefix}_info")
    with pytest.raises(ValueError, match="bucket"):
        write_bucketed(tables["courses"], "t", ["code_module"], 0, str(tmp_path / "none"))


CLICKS = "code_module string, code_presentation string, id_student long, id_site long, date int, sum_click long"


def some_clicks(n=400, seed=1):
    rnd = random.Random(seed)
    return [
        (rnd.choice(["A", "B", None]), "P", rnd.choice([1, 2, 3, None]), rnd.randint(0, 9), rnd.choice([None, *range(-5, 30)]), rnd.choice([None, 1, 5]))
        for _ in range(n)
    ]


def test_batches_in_any_order_give_the_recomputed_totals(spark, tmp_path):
    data = some_clicks()
    parts = {f"b{i}": data[i::5] for i in range(5)}
    frame = lambda d: spark.createDataFrame(d, CLICKS)
    rnd, store = random.Random(3), str(tmp_path / "store")
    assert increments.click_totals(spark, store).collect() == [] and increments.compact(spark, store) == 0
    calls = [*parts, *parts, *parts]
    rnd.shuffle(calls)
    seen = []
    for k, name in enumerate(calls):
        assert increments.add_batch(frame(parts[name]), store, name) == (name not in seen)
        seen.append(name) if name not in seen else None
        if k in (2, 7, 11):
            increments.compact(spark, store)
        sofar = frame([r for b in seen for r in parts[b]])
        assert rows(increments.click_totals(spark, store)) == rows(features.engagement_features(sofar))
        assert increments.batches(spark, store) == sorted(seen)
    early = features.engagement_features(frame(data), 14).select(*K3, "total_clicks")
    assert rows(increments.click_totals(spark, store, cutoff=14)) == rows(early)
    # an empty batch is a batch
    assert increments.add_batch(frame([]), store, "none") and not increments.add_batch(frame(data), store, "none")
    assert rows(increments.click_totals(spark, store)) == rows(features.engagement_features(frame(data)))
    with pytest.raises(ValueError, match="batch id"):
        increments.add_batch(frame(data), store, "../x")


def test_interrupted_writes_lose_and_double_nothing(spark, tmp_path):
    data, store = some_clicks(200, 2), str(tmp_path / "store")
    frame = spark.createDataFrame(data, CLICKS)
    half = spark.createDataFrame(data[:100], CLICKS), spark.createDataFrame(data[100:], CLICKS)
    for i in (0, 1):
        increments.add_batch(half[i], store, f"b{i}")
    want = rows(features.engagement_features(frame))
    # a partial without its success mark does not count, and is written anew
    os.remove(f"{store}/partials/batch_id=b1/_SUCCESS")
    assert rows(increments.click_totals(spark, store)) == rows(features.engagement_features(half[0]))
    assert increments.add_batch(half[1], store, "b1") and rows(increments.click_totals(spark, store)) == want
    # a compaction that stopped before its list of batches, or before the partials went
    shutil.copytree(f"{store}/partials", str(tmp_path / "partials"))
    assert increments.compact(spark, store) == 1
    shutil.copytree(str(tmp_path / "partials"), f"{store}/partials", dirs_exist_ok=True)
    assert rows(increments.click_totals(spark, store)) == want and not increments.add_batch(half[0], store, "b0")
    os.makedirs(f"{store}/generations/2/sums")
    assert rows(increments.click_totals(spark, store)) == want
    assert increments.add_batch(half[0], store, "again") and increments.compact(spark, store) == 2
    assert rows(increments.click_totals(spark, store)) == rows(features.engagement_features(frame.unionAll(half[0])))
    assert sorted(os.listdir(f"{store}/generations")) == ["2"]


def test_stream_of_click_files(spark, tmp_path):
    source, store, checkpoint = (str(tmp_path / x) for x in ("in", "store", "checkpoint"))
    data = some_clicks(300, 5)
    for k in range(3):
        spark.createDataFrame(data[k::3], CLICKS).coalesce(1).write.mode("append").parquet(source)
        for _ in range(2):  # a call that finds nothing new adds nothing
            query = increments.follow(spark, source, spark.createDataFrame([], CLICKS).schema, store, checkpoint)
            assert query.awaitTermination(120) and query.exception() is None
        sofar = [r for j in range(k + 1) for r in data[j::3]]
        assert rows(increments.click_totals(spark, store)) == rows(features.engagement_features(spark.createDataFrame(sofar, CLICKS)))
    assert len(increments.batches(spark, store)) == 3


TERMS = "id long, day double, gender string, band int, final_result string"
LAST = [(1, 5.0, "F", 1, "Pass"), (2, None, "M", 2, "Fail"), (3, 1.0, None, 1, "Withdrawn"), (4, 100.0, "F", None, "Distinction"), (5, 2.0, "M", 1, "Pass")]
NEXT = [(6, None, "X", 1, "Pass"), (7, 7.0, "F", 3, "Unknown"), (8, None, None, None, None), (9, -1.0, "M", 2, "Fail")]


def prepared(drop_first=False):
    return Preparation(medianColumns=["day"], categoryColumns=["gender", "band"], dropFirst=drop_first)


def test_preparation_learns_and_applies(spark, tmp_path):
    last, later = spark.createDataFrame(LAST, TERMS), spark.createDataFrame(NEXT, TERMS)
    model = prepared().fit(last)
    median = float(np.median([5.0, 1.0, 100.0, 2.0]))
    assert model.getOrDefault("medians") == {"day": median} and model.getOrDefault("levels") == {"gender": ["F", "M"], "band": ["1", "2"]}
    got = model.transform(later)
    assert got.columns == ["id", "day", "gender_F", "gender_M", "band_1", "band_2", "n_unseen", "target"]
    assert sorted(tuple(r) for r in got.select("id", "day", "n_unseen").collect()) == [(6, median, 1), (7, 7.0, 1), (8, median, 0), (9, -1.0, 0)]
    flags = {r.id: (r.gender_F, r.gender_M, r.band_1, r.band_2) for r in got.collect()}
    assert flags == {6: (False, False, True, False), 7: (True, False, False, False), 8: (False,) * 4, 9: (False, True, False, True)}
    assert {r.id: r.target for r in got.collect()} == {6: 0, 7: None, 8: None, 9: 2}
    # on the rows it was fitted on it equals the plain steps
    levels = encode.discover_levels(last, ["gender", "band"])
    plain = encode.one_hot(last.fillna(median, ["day"]).drop("final_result"), levels, ["gender", "band"])
    assert rows(model.transform(last).drop("n_unseen", "target")) == rows(plain)
    model.write().overwrite().save(str(tmp_path / "model"))
    assert rows(PreparationModel.load(str(tmp_path / "model")).transform(later)) == rows(got)
    est = prepared(drop_first=True)
    est.write().overwrite().save(str(tmp_path / "estimator"))
    again = Preparation.load(str(tmp_path / "estimator")).fit(last).transform(later)
    assert again.columns == ["id", "day", "gender_M", "band_2", "n_unseen", "target"]


def test_preparation_in_a_pipeline_and_its_bounds(spark, tmp_path):
    last, later = spark.createDataFrame(LAST, TERMS), spark.createDataFrame(NEXT, TERMS)
    pipe = Pipeline(stages=[prepared()]).fit(last)
    pipe.write().overwrite().save(str(tmp_path / "pipe"))
    assert rows(PipelineModel.load(str(tmp_path / "pipe")).transform(later)) == rows(prepared().fit(last).transform(later))
    with pytest.raises(ValueError, match="more than 3 levels"):
        Preparation(medianColumns=[], categoryColumns=["gender", "band"], maxLevels=3).fit(last)
    empty = prepared().fit(last.limit(0))
    got = empty.transform(later)
    assert got.columns == ["id", "day", "n_unseen", "target"] and got.where("day IS NULL").count() == 2
    assert {r.id: r.n_unseen for r in got.collect()} == {6: 2, 7: 2, 8: 0, 9: 2}


LINES = """id_student,sum_click,note
1,5,a
2,,b
3
4,7,c,d

x5,1,e
6,NaN,f
7,8,"quoted, with comma"
8,many,g
9999999999999999999999,1,h
"""


def test_bad_lines_are_put_aside(spark, tmp_path):
    source = tmp_path / "studentVle_small.csv"
    os.makedirs(source)
    (source / "a.csv").write_text(LINES)
    (source / "b.csv").write_text("id_student,sum_click,note\n10,1,z\n")
    got = read_parted(spark, str(source), schemas.STUDENT_VLE_SMALL, str(tmp_path / "parted"))
    assert rows(got.good) == sorted([(1, 5), (2, None), (6, None), (7, 8), (10, 1)], key=repr)
    bad = {r["line"]: (os.path.basename(r["file"]), r["reason"]) for r in got.bad.collect()}
    assert bad == {
        "3": ("a.csv", "number of fields"),
        "4,7,c,d": ("a.csv", "number of fields"),
        "x5,1,e": ("a.csv", "id_student: x5"),
        "8,many,g": ("a.csv", "sum_click: many"),
        "9999999999999999999999,1,h": ("a.csv", "id_student: 9999999999999999999999"),
    }
    counts = {os.path.basename(r["file"]): (r["good_rows"], r["bad_rows"]) for r in got.counts.collect()}
    lines = [x for x in LINES.splitlines()[1:] if x]
    assert counts == {"a.csv": (4, 5), "b.csv": (1, 0)} and sum(counts["a.csv"]) == len(lines)
    # without a folder for them a bad line still ends the job
    with pytest.raises(Exception, match="(?i)malformed|cast|column"):
        read_table(spark, str(source), schemas.STUDENT_VLE_SMALL).collect()
    with pytest.raises(ValueError, match="final_result"):
        read_parted(spark, str(source), schemas.STUDENT_INFO, str(tmp_path / "other"))


def test_registry_with_bad_lines(spark, tmp_path):
    header = "code_module,code_presentation,module_presentation_length\n"
    os.makedirs(tmp_path / "in")
    (tmp_path / "in" / "courses.csv").write_text(header + "A,2013J,260\nB,2013J\nC,2014J,long\n")
    loaded = load_tables(spark, str(tmp_path / "in"), names=["courses"], bad_rows=str(tmp_path / "bad"))
    assert rows(loaded["courses"]) == [("A", "2013J", 260)]
    report = bad_row_report(spark, str(tmp_path / "bad"), ["courses"])
    assert [tuple(r) for r in report.collect()] == [("courses", "module_presentation_length", 1), ("courses", "number of fields", 1)]
