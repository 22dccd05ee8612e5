"""Stratified split: exact quotas, partition of rows, determinism."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tutorlens.operators import split


def _approx_mode(counts, draws):
    """scikit-learn's allocation with ties broken by class order (brute force)."""
    total = sum(counts.values())
    cont = {k: c / total * draws for k, c in counts.items()}
    floor = {k: math.floor(v) for k, v in cont.items()}
    need = draws - sum(floor.values())
    order = sorted(counts, key=lambda k: (-(cont[k] - floor[k]), k))
    for k in order[:need]:
        floor[k] += 1
    return floor


def _expected(counts, test=0.15, val=0.15):
    n = sum(counts.values())
    n_test = math.ceil(test * n)
    rest = _approx_mode(counts, n - n_test)
    m = sum(rest.values())
    n_val = math.ceil(val / (1 - test) * m)
    train = _approx_mode(rest, m - n_val)
    return {k: (train[k], rest[k] - train[k], counts[k] - rest[k]) for k in counts}


def _frame(spark, counts, seed=0):
    rows = []
    rnd = random.Random(seed)
    i = 0
    for label, c in counts.items():
        for _ in range(c):
            rows.append(("M", "P", i, label))
            i += 1
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, "code_module string, code_presentation string, id_student long, target int")


@pytest.mark.parametrize(
    "counts",
    [
        {0: 750, 1: 150, 2: 375, 3: 600},
        {0: 25, 1: 25, 2: 25, 3: 25},  # n = 100: 16 validation rows (0.15/0.85 in doubles)
        {0: 1, 1: 2, 2: 3, 3: 997},
        {0: 7, 1: 7, 2: 7, 3: 7},  # ties in remainders
    ],
)
def test_quotas_are_exact(spark, counts):
    df = _frame(spark, counts)
    out = split.stratified_split(df, hex_digits=1)
    got = {}
    for r in out.groupBy("target", "split").count().collect():
        got.setdefault(r.target, {})[r.split] = r["count"]
    want = _expected(counts)
    for k, (tr, va, te) in want.items():
        assert (got[k].get("train", 0), got[k].get("validation", 0), got[k].get("test", 0)) == (tr, va, te)
    assert out.count() == sum(counts.values())


def test_hundred_rows_give_sixteen_validation(spark):
    df = _frame(spark, {0: 100})
    sizes = {r.split: r.n_rows for r in split.split_sizes(split.stratified_split(df)).collect()}
    assert sizes == {"train": 69, "validation": 16, "test": 15}


def test_split_is_deterministic(spark):
    counts = {0: 300, 1: 80, 2: 120, 3: 200}
    a = _frame(spark, counts, seed=1)
    b = _frame(spark, counts, seed=2).repartition(5)
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    sa = {(r.id_student, r.split) for r in split.stratified_split(a).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    sb = {(r.id_student, r.split) for r in split.stratified_split(b, hex_digits=2).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sa == sb
    ids = [i for i, _ in sa]
    assert len(ids) == len(set(ids)) == sum(counts.values())


def test_buckets_of_many_rows_are_narrowed(spark, monkeypatch):
    df = spark.range(0, 30000, 1, 8).selectExpr("'M' AS code_module", "'P' AS code_presentation", "id AS id_student", "CAST(pmod(hash(id), 4) AS INT) AS target")
    whole = {(r.id_student, r.split) for r in split.stratified_split(df).collect()}
    monkeypatch.setattr(split, "CANDIDATES", 3)
    assert {(r.id_student, r.split) for r in split.stratified_split(df, hex_digits=1).collect()} == whole
    rank, sizes = {}, {}
    rows = df.selectExpr("id_student", "target", "md5(concat_ws('|', '42', 'M', 'P', CAST(id_student AS STRING))) AS h").collect()
    for r in sorted(rows, key=lambda r: (r.h, r.id_student)):
        rank[r.id_student] = (r.target, sizes.get(r.target, 0))
        sizes[r.target] = sizes.get(r.target, 0) + 1
    want = _expected(sizes)
    for i, part in whole:
        c, k = rank[i]
        assert part == ("train" if k < want[c][0] else "validation" if k < want[c][0] + want[c][1] else "test")


def test_split_of_few_or_no_rows(spark):
    schema = "code_module string, code_presentation string, id_student long, target int"
    assert split.stratified_split(spark.createDataFrame([], schema)).collect() == []
    got = split.stratified_split(spark.createDataFrame([("M", "P", 1, 2), ("M", "P", 2, 2)], schema)).collect()
    assert sorted(r.split for r in got) == ["test", "validation"]


def test_other_seed_moves_rows_not_sizes(spark):
    df = _frame(spark, {0: 200, 1: 100})
    a = {(r.id_student, r.split) for r in split.stratified_split(df, seed=42).collect()}
    b = {(r.id_student, r.split) for r in split.stratified_split(df, seed=7).collect()}
    assert a != b
    size = lambda s: sorted((x, sum(1 for _, y in s if y == x)) for x in split.SPLITS)
    assert size(a) == size(b)


def test_missing_label_fails(spark):
    df = spark.createDataFrame([("M", "P", 1, None), ("M", "P", 2, 0)], "code_module string, code_presentation string, id_student long, target int")
    with pytest.raises(Exception, match="stratified_split"):
        split.stratified_split(df).collect()


def test_class_shares_report(spark):
    df = _frame(spark, {0: 750, 1: 150, 2: 375, 3: 600})
    rows = split.split_class_shares(split.stratified_split(df)).where(F.col("split") == "test").collect()
    shares = {r.class_name: r.share for r in rows}
    want = _expected({0: 750, 1: 150, 2: 375, 3: 600})
    n_test = sum(te for _, _, te in want.values())
    names = {0: "Pass", 1: "Distinction", 2: "Fail", 3: "Withdrawn"}
    assert shares == {names[k]: round(te / n_test, 3) for k, (_, _, te) in want.items()}
    assert shares == {"Pass": 0.401, "Distinction": 0.082, "Fail": 0.199, "Withdrawn": 0.319}
