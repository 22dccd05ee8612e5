import random

import numpy as np
import pytest
import xxhash

from tutorlens.llm import simhash_near_dedup as S


def slow_fingerprint(text, width=4):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or ([b" ".join(words)] if words else [])
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def reach(fps, most):
    """Smallest number of the component of each fingerprint, by brute force."""
    values = np.array(fps, dtype=np.uint64)
    label = list(range(len(fps)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= most):
            a, b = find(i), find(int(j))
            label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def flipped(value, draw, n):
    for b in draw.sample(range(64), n):
        value ^= 1 << b
    return value


def test_every_near_pair_meets_at_a_home():
    draw = random.Random(5)
    for blocks in (1, 2, 3, 5):
        for _ in range(60 if blocks > 1 else 3):
            a = draw.getrandbits(64)
            b = flipped(a, draw, draw.randint(0, 4) if blocks > 1 else draw.randint(0, 1))
            anchors, fps, home = S.anchored(np.array([a, b], dtype=np.uint64), 4 if blocks > 1 else 1, blocks)
            homes = {int(x) for x, f, h in zip(anchors, fps, home) if h and int(f) == a}
            assert homes & {int(x) for x, f in zip(anchors, fps) if int(f) == b}


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def test_components_match_brute_force(spark, monkeypatch):
    draw = random.Random(9)
    fps = [draw.getrandbits(64) for _ in range(200)]
    for _ in range(600):  # chains and dense groups
        fps.append(flipped(draw.choice(fps), draw, draw.randint(1, 5)))
    fps = list(dict.fromkeys(fps))
    label = reach(fps, 4)
    want = {}
    for f, r in zip(fps, label):
        want.setdefault(r, set()).add(f)
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long").repartition(5)
    for rows in (1 << 15, 8):  # small cells: crowded anchors become grids
        monkeypatch.setattr(S, "CELL_ROWS", rows)
        found = {r["u"]: r["root"] for r in S.components(S.stars(df)).collect()}
        got = {}
        for f in fps:
            got.setdefault(found.get(signed(f), signed(f)), set()).add(f)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_fingerprints_and_edge_rows(table_of):
    texts = [(4, None), (2, ""), (9, "\n \t"), (5, "One two"), (6, "one TWO"), (7, "É é a b c"), (8, "w " * 70_000), (8, "w " * 70_000), (None, "One two"), (30, "a b c d e f g")]
    got = S.near_dedup(table_of(texts)).collect()
    assert len(got) == len(texts)
    by_id = {r["doc_id"]: r for r in got}
    for i, t in texts:
        if i is not None:
            assert int(by_id[i]["fingerprint"], 16) == slow_fingerprint(t or "")
    assert {by_id[i]["component_id"] for i in (2, 4, 9)} == {2} and by_id[6]["component_id"] == 5 == by_id[None]["component_id"]
    assert S.near_dedup(table_of([])).collect() == []
    kept = S.keep_representatives(table_of(texts))
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted([2, 5, 7, 8, 30], key=repr)
    assert kept.columns == table_of([]).columns


A, B, C = "one two three four five six", "red green blue cyan grey pink", "sun moon star sky rain snow"


@pytest.mark.parametrize(
    ("pairs", "want"),
    [
        ([(1, A), (2, A), (2, B), (3, B)], [(1, A), (2, B)]),
        ([(None, A), (None, A), (None, B)], [(None, A), (None, B)]),
        ([(None, A), (7, A), (7, A), (7, B)], [(7, A), (7, B)]),
        ([(1, A), (1, A.upper()), (1, B), (None, ""), (None, None)], [(1, None), (1, B), (None, "")]),
        ([(5, A), (4, A + "\n"), (4, A), (5, C), (5, C)], [(4, None), (5, C)]),
    ],
)
def test_one_row_of_each_group_stays(table_of, pairs, want):
    got = [(r["doc_id"], r["text"]) for r in S.keep_representatives(table_of(pairs)).collect()]
    # None in ``want``: either text of the component
    key = lambda rows: sorted(((i, A if t is None or t.strip().lower() == A else t) for i, t in rows), key=repr)
    empty = lambda rows: [(i, "" if t is None else t) for i, t in rows]
    assert key(empty(got)) == key(want)


def test_whole_table_matches_brute_force(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    local = sorted((r["doc_id"], S.fingerprint(r["text"] or "")) for r in docs.collect())
    ids, fps = zip(*local)
    want = dict(zip(ids, (ids[r] for r in reach(fps, 4))))
    assert {r["doc_id"]: r["component_id"] for r in S.near_dedup(docs).collect()} == want
