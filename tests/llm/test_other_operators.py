import re

import numpy as np
import pytest

from tutorlens.llm import extendible_sharding as X
from tutorlens.llm import license_scan as L
from tutorlens.llm import projected_neighbours as N
from tutorlens.llm import quotation_linking as K


def test_shards_fit_and_only_full_buckets_split(table_of):
    docs = [(i, "x" * (i % 97)) for i in range(2000)] + [(9000, "y" * 50_000), (None, "n"), (9001, None)]
    got = X.assign_shards(table_of(docs), 4000).collect()
    assert sorted((r["doc_id"] for r in got), key=repr) == sorted((i for i, _ in docs), key=repr)
    sizes, count = {}, {}
    for r in got:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["bytes"]
        count[r["shard"]] = count.get(r["shard"], 0) + 1
    assert all(n <= 4000 or count[s] == 1 for s, n in sizes.items())
    assert all((r["shard_bytes"], r["shard_docs"]) == (sizes[r["shard"]], count[r["shard"]]) for r in got)
    for s in sizes:  # a parent bucket is too large, else it would not have split
        if s:
            assert sum(n for t, n in sizes.items() if t.startswith(s[:-1])) > 4000
    assert {r["shard"] for r in X.assign_shards(table_of(docs), 1 << 40).collect()} == {""}
    assert X.assign_shards(table_of([]), 10).collect() == []


def test_rows_of_one_key_are_cut(table_of):
    docs = [(1, "x" * 30)] * 100 + [(2, "z")]
    got = X.assign_shards(table_of(docs).repartition(4), 100).collect()
    sizes = {}
    for r in got:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["bytes"]
    assert len(got) == 101 and max(sizes.values()) <= 100 and sum(sizes.values()) == 3001


def test_written_shards(spark, table_of, tmp_path):
    docs = table_of([(i, "x" * 50) for i in range(100)])
    X.write_shards(docs, str(tmp_path / "s"), 1000)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == 100
    assert all(r["n"] * 50 <= 1000 for r in back.groupBy("_shard").count().withColumnRenamed("count", "n").collect())


LICENSES = [
    (1, "A.\nLicensed under the Apache License, Version 2.0.\nz"),
    (2, "cc by cc BY cc\nby"),
    (3, None),
    (4, ""),
    (5, "All rights\n reserved. GENERAL public-license; allrights reserved"),
    (6, "é all rights reservedé"),
    (7, "released under mit license terms"),  # 4 of 5 words
    (8, "under mit license"),
    (None, "Released under the MIT License."),
    (9, "Released under the MIT License."),
    (9, "plain"),
    (10, "w " * 50_000 + "cc by"),
]


def test_license_scan(table_of):
    got = {}
    for r in L.scan(table_of(LICENSES)).collect():
        got.setdefault(r["doc_id"], []).append(r)
    one = lambda i: got[i][0]
    assert (one(1)["labels"], one(1)["base_labels"], one(1)["score"], one(1)["n_base"]) == ("apache-2.0", "", 1.0, 0)
    assert (one(2)["n_words"], one(2)["n_base"], one(2)["first_word"], one(2)["last_word"]) == (6, 3, 0, 4)
    assert [(one(i)["n_words"], one(i)["first_word"], one(i)["labels"], one(i)["score"]) for i in (3, 4)] == [(0, None, "", 0.0)] * 2
    assert (one(5)["base_labels"], one(5)["first_word"], one(5)["last_word"]) == ("gpl,reserved", 0, 3)
    assert one(6)["n_base"] == 0 and one(8)["labels"] == ""
    assert (one(7)["labels"], one(7)["score"]) == ("mit", 0.8)
    assert one(None)["labels"] == "mit" and sorted(r["labels"] for r in got[9]) == ["", "mit"]
    assert (one(10)["first_word"], one(10)["n_words"]) == (50_000, 50_002)
    assert L.scan(table_of([])).collect() == []


def plain_blocks(text, templates, threshold):
    """{label: (containment, places)} by trying every window of every paragraph."""
    out = {}
    for label, notice in templates.items():
        words, width = {*notice.split()}, int(len(notice.split()) / threshold + 1e-9)
        best, places = 0, 0
        for paragraph in re.split(r"\n(?:[^\S\n]*\n)+", text):
            tokens, reach = paragraph.split(), -1
            for i, w in enumerate(tokens):
                common = {*tokens[i : i + width]} & words
                if w in words and len(common) >= threshold * len(words) - 1e-9:
                    best, places = max(best, len(common) / len(words)), places + (i > reach)
                    reach = max(j for j in range(i, min(i + width, len(tokens))) if tokens[j] in words)
        if best:
            out[label] = best, places
    return out


def test_filters_lose_no_block(table_of):
    draw = np.random.default_rng(1)
    words = [f"w{k}" for k in range(30)]
    templates = {f"t{k}": " ".join(draw.choice(words, draw.integers(1, 12), replace=False)) for k in range(12)}
    docs = [(i, "\n".join(" ".join(draw.choice(words, draw.integers(0, 25))) for _ in range(draw.integers(1, 7)))) for i in range(150)]
    vocabulary = sorted({w for t in templates.values() for w in t.split()})
    for threshold in (0.5, 0.8, 1.0):
        texts = L.folded_texts(table_of(docs), {"cc by": "x"}, templates, threshold)
        for order in (L.word_order(texts, vocabulary), {w: k for k, w in enumerate(vocabulary)}):
            got = {(r["doc_id"], r["label"]): (r["containment"], r["n_blocks"]) for r in L.blocks(texts, templates, threshold, order).collect()}
            want = {(i, label): found for i, text in docs for label, found in plain_blocks(text, templates, threshold).items()}
            assert got == want


def test_words_far_apart_are_no_notice(table_of):
    far = " ".join(f"{w} " + "x " * 40 for w in "released under the mit license".split())
    near = "a b " * 1000 + "released under the new mit license " + "c " * 1000
    docs = [(1, far), (2, near), (3, far * 300), (4, "released under the mit \n\n mit license released under")]
    got = {r["doc_id"]: (r["labels"], r["score"], r["n_blocks"]) for r in L.scan(table_of(docs)).collect()}
    assert got == {1: ("", 0.0, 0), 2: ("mit", 1.0, 1), 3: ("", 0.0, 0), 4: ("mit", 0.8, 2)}


def test_folding(table_of):
    texts = ["A-B  c\t\tD", "\x1c\x7fK Kelvin É İstanbul", "", " ", "a,b\n\nC , d\r\ne", "x" * 9 + " " * 5, "1·2", "ǅ ﬁ"]
    rows = L.folded_texts(table_of(list(enumerate(texts))), L.BASE_PHRASES, L.TEMPLATES, 0.8).collect()
    fold = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t))
    assert {r["doc_id"]: r["n_words"] for r in rows} == {i: len(fold(t)) for i, t in enumerate(texts)}
    df = table_of([(1, "cc by"), (2, "CC BY"), (3, "cc bY, ccİ by CC\nBY")])
    got = {r["doc_id"]: (r["n_base"], r["first_word"], r["last_word"]) for r in L.scan(df).collect()}
    assert got == {1: (1, 0, 0), 2: (1, 0, 0), 3: (2, 0, 4)}
    kelvin = table_of([(1, "by Kelvin cc by \u212a"), (2, "wor\u212a licensed under")])
    assert [r["labels"] for r in L.scan(kelvin).orderBy("doc_id").collect()] == ["cc-by", ""]



def vectors(n=1500, size=12, seed=2):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n, size)) * draw.uniform(0.2, 3, size=(n, 1))
    x[100:400] = x[7]  # copies
    return x


def brute(x, ids, k=20):
    out = {}
    for n in np.flatnonzero(ids % 20 == 0):
        score = (x * x[n]).sum(axis=1)
        order = np.lexsort((ids, -score))
        out[int(ids[n])] = [int(ids[o]) for o in order if o != n][:k]
    return out


@pytest.mark.parametrize("cell, queries, sample", [(16384, 16384, 32768), (100, 10, 32768), (60, 10, 32)])
def test_neighbours_against_brute_force(spark, monkeypatch, cell, queries, sample):
    monkeypatch.setattr(N, "CELL_ROWS", cell)
    monkeypatch.setattr(N, "SAMPLE_ROWS", sample)
    monkeypatch.setattr(N, "QUERIES_AT_ONCE", queries)
    x = vectors()
    ids = np.arange(len(x))
    odd = [(20_000, None), (20_020, [0.0] * 12), (20_040, [float("nan")] * 12), (20_060, [None] + [1.0] * 11), (20_080, [1.0]), (None, [1.0] * 12), (0, x[0].tolist())]
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)] + odd, "vec_id long, embedding array<double>")
    df = df.selectExpr("*", "1 AS qid", "'a' AS vec", "2 AS cell")
    got = {}
    for r in N.nearest(df, "vec_id % 20 = 0").orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    want = brute(x, ids)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {*want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)
    for q, found in got.items():
        assert [s for _, s in found] == pytest.approx([float((x[i] * x[q]).sum()) for i, _ in found], rel=1e-12)
        assert found == sorted(found, key=lambda p: (-p[1], p[0]))
    # the copies of a query: the smallest ids first
    if np.argmax((x * x[7]).sum(axis=1)) in (7, *range(100, 400)):
        assert [i for i, _ in got[120]] == want[120]


def test_few_or_no_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.0]), (20, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert [r[:3] for r in rows_in_order(N.nearest(df, "vec_id % 20 = 0"))] == [(0, 1, 1), (0, 2, 20), (20, 1, 0), (20, 2, 1)]
    assert N.nearest(df.limit(0), "vec_id % 20 = 0").collect() == []


def test_lengths_and_ids_of_several_vectors(spark):
    draw = np.random.default_rng(3)
    rows = [(i, draw.normal(size=5 if i % 3 else 9).round(2).tolist()) for i in range(240)]
    rows += [(20, [1.0] * 5), (20, [1.0] * 5), (20, [2.0] * 9), (21, [3.0] * 5), (40, rows[100][1]), (7, rows[40][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = {}
    for r in N.nearest(df, "vec_id % 20 = 0", k=6).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want, distinct = {}, sorted({(i, tuple(v)) for i, v in rows})
    for i, v in distinct:
        if i % 20 == 0:
            others = [(-sum(a * b for a, b in zip(v, w)), j) for j, w in distinct if len(w) == len(v) and (j, w) != (i, v)]
            want.setdefault(i, []).extend((n, j, -s) for n, (s, j) in enumerate(sorted(others)[:6], 1))
    key = lambda rows: sorted((n, j, round(s, 9)) for n, j, s in rows)
    assert {i: key(x) for i, x in found.items()} == {i: key(x) for i, x in want.items()}


def rows_in_order(df):
    return [tuple(r) for r in df.orderBy("query_id", "rank").collect()]


def test_recall_on_the_table(spark, sf001):
    emb = spark.read.parquet(f"{sf001}/embeddings.parquet")
    local = emb.orderBy("vec_id").collect()
    ids, x = np.array([r["vec_id"] for r in local]), np.array([r["embedding"] for r in local], dtype=float)
    want, got = brute(x, ids), {}
    for r in N.nearest(emb, "vec_id % 20 = 0").collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert sum(len(got[q] & {*want[q]}) for q in want) >= 0.9 * sum(map(len, want.values()))


def test_quotes_of_some_lines_of_a_paragraph(spark):
    rows = [
        (1, 0, "One.\nTwo  words.\nThree.\nFour.\n\nOther"),
        (1, 1, "Two words.\nFour.\nFive."),
        (1, 2, "nothing"),
        (1, 3, "> two words.\n> Three.\nyes"),  # two of four lines of turn 0
        (1, 4, "> Two words.\n> Four.\nno\n\n> Three.\n> Five."),  # the latest that wrote both; no turn wrote these two
        (1, 5, "> Four.\n> Other\nlines of two paragraphs"),
        (1, 6, "Two words.\nThree.\n> Two words.\n> Three."),  # its own lines do not count
        (2, 7, "> Two words.\n> Three."),  # another conversation
    ]
    df = spark.createDataFrame([(c, t, "u", x) for c, t, x in rows], "conv_id long, turn long, role string, text string")
    got = {r["turn"]: (r["reply_to"], r["linked"], r["n_quotes"], r["n_linked"]) for r in K.link(df).collect()}
    assert got[3] == (0, True, 1, 1) and got[4] == (1, True, 2, 1)
    assert got[5] == (0, True, 1, 1) and got[6] == (0, True, 1, 1)
    assert got[7] == (None, False, 1, 0) and got[2] == (1, False, 0, 0)


def test_lines_quoted_and_written_many_times(spark):
    rows = [(1, t, "u", "> again\n> and again\nsure" if t % 2 else "again\nand again\nmore") for t in range(400)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = K.link(df).where("turn % 2 = 1").collect()
    assert len(got) == 200 and all(r["linked"] and r["reply_to"] == r["turn"] - 1 for r in got)


def test_notices_over_line_ends(table_of):
    bsd = "# Redistribution and use in source and binary forms, with or without\n# modification, are permitted"
    isc = "Permission to use, copy, modify, and/or distribute this software for any\r\npurpose with or without fee is hereby granted"
    docs = [
        (1, f"text\n{bsd} provided\n\n{bsd}"),
        (2, f"{isc}, provided"),
        (3, "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated\ndocumentation files"),
        (4, "the terms of the Mozilla Public\nLicense, v. 2.0. This Source Code Form is subject to the"),
        (5, bsd.replace("without\n", "without\n\n")),  # two paragraphs
        (6, bsd.replace("without\n", "without\n" + "other words here " * 5)),  # too far apart
        (7, "the\nReleased under the MIT License.\nunder the"),  # one line meets it alone
        (8, "Released under\nthe MIT License. Released under the\nMIT License"),
        (None, f"{bsd}"),
    ]
    got = {r["doc_id"]: (r["labels"], r["score"], r["n_blocks"]) for r in L.scan(table_of(docs)).collect()}
    assert got[1] == ("bsd", 1.0, 2) and got[None] == ("bsd", 1.0, 1)
    assert got[2] == ("isc", 1.0, 1) and got[3] == ("mit-text", 1.0, 1) and got[4] == ("mpl-2.0", 1.0, 1)
    assert got[5] == got[6] == ("", 0.0, 0)
    assert got[7] == ("mit", 1.0, 1) and got[8][:2] == ("mit", 1.0)
