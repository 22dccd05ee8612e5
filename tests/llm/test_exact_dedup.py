import hashlib
import re
from collections import defaultdict

import numpy as np

from tutorlens.llm import exact_dedup as exact_dedup_module
from tutorlens.llm.exact_dedup import drop_copies, exact_dedup, fingerprint_counts
from tutorlens.llm.quotient_filter import CountingQuotientFilter

ODD = [
    (5, "a  b\n\tc"), (3, "a b c"), (9, "a b c"), (9, "a b c"), (4, " a b c"), (7, None), (8, ""), (None, "a\x0bb c"),
    (None, "only without id"), (None, "only without id"), (11, "x" * 200_000), (12, "x" * 200_000), (13, "é b"), (14, "é b"),
    (2, "y"), (2, "y"), (1, "z"), (1, "other text of 1"),
]


def brute(pairs):
    groups = defaultdict(list)
    for i, t in pairs:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    out = []
    for i, t in pairs:
        norm = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        keep = min((x for x in groups[norm] if x is not None), default=None)
        out.append((i, keep, len(groups[norm]), i == keep, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_odd_rows_match_brute_force(table_of):
    got = exact_dedup(table_of(ODD)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(ODD)


def test_drop_copies_keeps_all_columns_and_each_document_once(table_of):
    docs = table_of(ODD)
    kept = drop_copies(docs)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=repr)
    assert ids == sorted([3, 4, 7, 11, 13, 14, 2, 1, 1, None], key=repr)


def test_empty_table(table_of):
    assert exact_dedup(table_of([])).collect() == []
    assert drop_copies(table_of([])).collect() == []


def test_one_text_with_most_rows(spark):
    docs = spark.range(0, 5000, 1, 16).selectExpr("id AS doc_id", "IF(id % 3 = 0, concat('row ', id), 'hot text') AS text")
    got = exact_dedup(docs).where("group_size > 1").selectExpr("min(keep_id)", "max(keep_id)", "count(*)", "max(group_size)").first()
    assert tuple(got) == (1, 1, 3333, 3333)


def test_hot_text_without_broadcast(spark):
    docs = spark.range(0, 5000, 1, 16).selectExpr("id AS doc_id", "IF(id % 3 = 0, concat('row ', id), 'hot text') AS text")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        seen, write = [], exact_dedup_module.staged

        def watched(df, name):
            seen.append((name, df._jdf.queryExecution().sparkPlan().toString(), df._jdf.queryExecution().executedPlan().toString()))
            return write(df, name)

        exact_dedup_module.staged = watched
        got = exact_dedup(docs).where("group_size > 1").selectExpr("min(keep_id)", "count(*)").first()
    finally:
        exact_dedup_module.staged = write
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert tuple(got) == (1, 3333)
    (plan,) = [p for name, _, p in seen if name == "dedup-groups"]
    # from the top: final aggregate, exchange of the texts, partial aggregate, join
    places = [plan.index(x) for x in ("Exchange hashpartitioning(norm", "partial_min", "SortMergeJoin")]
    assert places == sorted(places)


def test_filter_round_trip_and_merge():
    draw = np.random.default_rng(3)
    pool = draw.integers(0, 1 << 62, 4000, dtype=np.uint64)
    parts = [draw.choice(pool, 3000) for _ in range(5)]
    filters = [CountingQuotientFilter.of_sorted(*np.unique(p, return_counts=True)) for p in parts]
    packed = [CountingQuotientFilter.unpack(f.quotient_bits, *f.pack()) for f in filters]
    for f, p in zip(packed, parts):
        assert np.array_equal(f.fingerprints(), np.unique(p))
    merged = CountingQuotientFilter.merge(packed)
    want, counts = np.unique(np.concatenate(parts), return_counts=True)
    assert np.array_equal(merged.fingerprints(), want) and np.array_equal(merged.counts, counts)


def test_merge_tree(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup_module, "FILTER_ROWS", 500)
    monkeypatch.setattr(exact_dedup_module, "FAN_BITS", 2)
    assert exact_dedup_module.levels_of(7) == [2, 2, 2, 1] and exact_dedup_module.levels_of(0) == [0]
    df = spark.range(0, 40000, 1, 16).selectExpr("IF(id % 3 = 0, 12345, xxhash64(id % 15000)) AS fingerprint")
    want = {r[0]: r[1] for r in df.groupBy("fingerprint").count().where("count > 1").collect()}
    for block_bits in (0, 2, 5, 7):
        got = {r["fingerprint"]: r["n"] for r in fingerprint_counts(df, block_bits).collect()}
        assert got == want


def test_counts_over_partitions(spark):
    df = spark.range(0, 20000, 1, 7).selectExpr("xxhash64(id % 15000) AS fingerprint")
    got = {r["fingerprint"]: r["n"] for r in fingerprint_counts(df, 3).collect()}
    want = {r[0]: 2 for r in spark.range(5000).selectExpr("xxhash64(id)").collect()}
    assert got == want
