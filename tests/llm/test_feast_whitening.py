"""Whitening by contour integration against dense eigenvalues and plain integers."""

import math

import numpy as np
import pytest

from tutorlens.llm import feast_whitening as w


def symmetric(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values),) * 2))
    m = (q * np.asarray(values, dtype=float)) @ q.T
    return (m + m.T) / 2


SPECTRA = {
    "spread": np.arange(1, 41) ** 2.0,
    "close": 1000 + np.linspace(0, 1, 64),
    "repeated": [5.0] * 6 + [3.0] * 7 + [1.0] * 20,
    "all equal": [2.0] * 12,
    "low rank": [9.0, 4.0, 1.0] + [0.0] * 30,
    "far apart": 10.0 ** -np.arange(0, 11.0),
    "one": [7.0],
    "few": [3.0, 2.0, 1.0],
    "pairs": np.repeat(np.arange(1, 21.0), 2),
    "many": np.random.default_rng(3).gamma(2.0, size=200),
}


@pytest.mark.parametrize("name", SPECTRA)
def test_leading_eigenpairs(name):
    m = symmetric(SPECTRA[name])
    true = np.sort(np.linalg.eigvalsh(m))[::-1]
    number = min(8, int((true > w.NOTHING * np.trace(m)).sum()))
    values, vectors = w.leading_eigenpairs(m, 8)
    scale = np.abs(m).sum(axis=1).max()
    assert len(values) == number and np.all(np.diff(values) <= 1e-13 * scale)
    assert np.abs(values - true[:number]).max() <= 1e-13 * scale
    assert np.abs(vectors.T @ vectors - np.eye(number)).max() < 1e-12
    assert np.abs(m @ vectors - vectors * values).max() <= 1e-12 * scale


@pytest.mark.parametrize("seed", range(6))
def test_inertia_counts(seed):
    rng = np.random.default_rng(seed)
    m = rng.normal(size=(30, 30))
    m = m + m.T
    if seed == 5:
        np.fill_diagonal(m, 0.0)  # needs double pivots
    true = np.linalg.eigvalsh(m)
    for shift in [*rng.normal(scale=5, size=10), 0.0, -1e6, 1e6]:
        assert w.eigenvalues_above(m, shift) == int((true > shift).sum())


def test_projection_keeps_only_the_interval():
    m = symmetric(SPECTRA["spread"])
    values, vectors = np.linalg.eigh(m)
    kept = np.linalg.norm(vectors.T @ w.project(m, 1200.0, 1700.0, np.eye(len(m))), axis=1)
    inside = (values > 1200) & (values < 1700)
    assert np.allclose(kept[inside], 1, atol=0.1) and kept[(values < 1000) | (values > 1900)].max() < 1e-3


def test_missed_eigenvalues_raise():
    with pytest.raises(w.EigenvaluesMissed):
        w.eigenpairs_between(symmetric(np.arange(1, 9)), 2.5, 4.5, 3)


def plain(rows):
    """Whitened rows by a dense solver, and exact deviations, for each length."""
    out = {}
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) and abs(c) < w.LARGEST for c in v)]
    for size in {len(v) for _, v in good}:
        x = [(i, [math.floor(1024 * float(np.float32(c))) + 100000 for c in v]) for i, v in good if len(v) == size]
        n, sums = len(x), [sum(c) for c in zip(*(v for _, v in x))]
        y = np.array([[c - s / n for c, s in zip(v, sums)] for _, v in x])
        values, vectors = np.linalg.eigh(y.T @ y / n)
        values, vectors = values[::-1], vectors[:, ::-1]
        for (i, v), row in zip(x, y):
            deviation = sum((n * c - s) ** 2 for c, s in zip(v, sums))
            for k in range(min(8, int((values > 1e-12 * values.sum()).sum()))):
                white = abs(row @ vectors[:, k]) / math.sqrt(values[k])
                out.setdefault((i, size, k + 1, n, deviation if deviation < 2**63 else None), []).append((white, values[k] / values.sum()))
    return out


def check(spark, rows, extra=()):
    names = "vec_id long, embedding array<float>, x string, i int, v int, component string, n string"
    df = spark.createDataFrame([(i, v, "x", 1, 2, "y", "z") for i, v in rows], names)
    got = w.whiten(df.repartition(4)).collect()
    want = plain(rows)
    assert len(got) == sum(map(len, want.values()))
    sizes = {}
    for key, found in want.items():
        sizes[key[3]] = key[1]
    seen = {}
    for r in got:
        seen.setdefault((r["vec_id"], sizes[r["n"]], r["component"], r["n"], r["deviation"]), []).append((abs(r["whitened"]), r["explained"]))
        assert r["identity_error"] < 1e-4
    assert seen.keys() == want.keys()
    for key, found in seen.items():
        assert np.allclose(sorted(found), sorted(want[key]), atol=1e-7, rtol=1e-7)
    return got


def test_whiten_matches_a_dense_solver(spark):
    rng = np.random.default_rng(1)
    scale = np.linspace(0.2, 2, 20)
    rows = [(i, [float(c) for c in rng.normal(size=20) * scale]) for i in range(300)]
    rows += [(7, rows[7][1]), (7, rows[8][1]), (None, rows[9][1]), (None, [0.0] * 20)]
    rows += [(400, None), (401, []), (402, [math.nan] * 20), (403, [1.0] * 19 + [math.inf]), (404, [1.0] * 19 + [None]), (405, [1e30] * 20)]
    # other lengths are fits of their own; one vector alone has no component
    rows += [(500 + i, [float(c) for c in rng.normal(size=3)]) for i in range(40)] + [(600, [1.0] * 5)]
    got = check(spark, rows)
    assert {r["n"] for r in got} == {304, 40}


def test_exact_deviations_beyond_doubles(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=4) * [1, 1e3, 1e6, 1e9]]) for i in range(50)]
    model = w.Whitening(3, [10, 20], np.ones(1), np.ones((2, 1)), 1.0)
    assert model.deviations(np.array([[2**29, 1], [2**40, 5]])) == [(3 * 2**29 - 10) ** 2 + 289, None]
    assert model.deviations(np.array([[2**25, 1]])) == [(3 * 2**25 - 10) ** 2 + 289]
    check(spark, rows[:0] + [(i, v[:2]) for i, v in rows])


def test_deviations_of_many_vectors():
    # far from zero, close to the mean: only the differences need to fit, not the sums squared
    rng = np.random.default_rng(4)
    x = np.vstack([rng.integers(99_000, 101_000, size=(60, 16)), [[2**40] * 16], [[100_000] * 15 + [2**28]]])
    sums = [60_000 * 100_000 + j for j in range(16)]
    model = w.Whitening(60_000, sums, np.ones(1), np.ones((16, 1)), 1.0)
    want = [sum((60_000 * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
    assert model.deviations(x) == [v if v < 2**63 else None for v in want]
    assert model.deviations(x)[60:] == [None, None] and None not in model.deviations(x[:60])
    huge = w.Whitening(2**40, [2**57] * 2, np.ones(1), np.ones((2, 1)), 1.0)
    assert huge.deviations(np.array([[2**17, 2**17], [2**17, 2**17 + 1], [2**40, 0]])) == [0, None, None]
    assert model.deviations(np.empty((0, 16), dtype=np.int64)) == []


def test_nothing_to_whiten(spark):
    schema = "vec_id long, embedding array<float>"
    assert w.whiten(spark.createDataFrame([], schema)).collect() == []
    assert w.whiten(spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], schema)).collect() == []
    # a length of which no vector takes part, beside one of which some do
    rows = [(1, [math.nan, 1.0, 2.0]), (2, [math.inf] * 3), (3, [None] * 3), *((i, [float(i), float(i % 3)]) for i in range(4, 12))]
    assert {r["n"] for r in check(spark, rows)} == {8}
    assert w.whiten(spark.createDataFrame([(1, None)], schema)).columns[:3] == ["vec_id", "component", "n"]
