"""Operator 12: embedding whitening by contour integration (FEAST).

Spark gathers the exact sums and the centred covariance of all vectors; what the
driver holds is that d x d matrix, whatever the number of vectors.  Inertia
counts (of an LDL^T factorisation) bracket the largest eigenvalues and cut the
bracket into intervals of a few.  For each interval a quadrature of complex
shifted solves around it projects a small random block onto its eigenvectors,
Rayleigh-Ritz extracts them, and the block is projected again until the
residuals vanish.  The inertia counts then say whether any was missed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries become the integers floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Larger entries leave no room for exact sums; their vectors take no part.
LARGEST = 2.0**40
#: Eigenvalues in an interval, nodes of its half circle, and projections at most.
BLOCK, NODES, ROUNDS = 4, 12, 30
#: Eigenvalues below this share of the trace count as zero.
NOTHING = 1e-12
LONG = 2**63 - 1


class EigenvaluesMissed(ArithmeticError):
    """The projections found another number of eigenvalues in an interval than its inertia counts."""


def eigenvalues_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix exceed ``shift``: the positive inertia of matrix - shift.

    Symmetric elimination with complete pivoting: a single pivot counts by its
    sign, a double one (taken where the diagonal is small) has one of each sign.
    """
    a = matrix - shift * np.eye(len(matrix))
    count, enough = 0, (1 + 17**0.5) / 8
    while len(a):
        size = np.abs(a)
        r = int(np.argmax(size.diagonal()))
        single = size[r, r]
        np.fill_diagonal(size, 0.0)
        i, j = divmod(int(np.argmax(size)), len(a))
        if single == 0.0 and size[i, j] == 0.0:
            break  # what is left is zero
        if single >= enough * size[i, j]:
            pivots, more = [r], a[r, r] > 0
        else:
            pivots, more = [i, j], 1
        rest = np.delete(np.arange(len(a)), pivots)
        across = a[np.ix_(pivots, rest)]
        a = a[np.ix_(rest, rest)] - across.T @ np.linalg.solve(a[np.ix_(pivots, pivots)], across)
        a = (a + a.T) / 2
        count += int(more)
    return count


def clear_cut(matrix: np.ndarray, low: float, high: float, wanted) -> tuple[float, int] | None:
    """A shift between ``low`` and ``high``, with its count of eigenvalues above, that ``wanted`` accepts.

    Halves the bracket; a cut with an eigenvalue close by is moved, since the
    projection separates badly there.  None where the bracket holds no such cut
    (a cluster of eigenvalues).
    """
    for _ in range(60):
        width, best = high - low, None
        for share in (0.5, 0.42, 0.58, 0.35, 0.65):
            at = low + share * width
            counts = [eigenvalues_above(matrix, at + part * width) for part in (-0.03, 0.0, 0.03)]
            if best is None or counts[0] == counts[2]:
                best = at, counts[1]
            if counts[0] == counts[2]:
                break
        verdict = wanted(best[1])
        if verdict == 0:
            return best
        low, high = (best[0], high) if verdict > 0 else (low, best[0])
        if high - low <= 1e-13 * max(abs(low), abs(high)):
            return None
    return None


def project(matrix: np.ndarray, low: float, high: float, block: np.ndarray) -> np.ndarray:
    """The quadrature of the resolvent around (low, high), applied to ``block``."""
    centre, radius = (low + high) / 2, (high - low) / 2
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    angles = np.pi / 2 * (1 - nodes)  # the upper half circle; the lower one is its conjugate
    out, one = np.zeros_like(block), np.eye(len(matrix))
    for angle, weight in zip(angles, weights):
        turn = radius * np.exp(1j * angle)
        out += weight / 2 * (turn * np.linalg.solve((centre + turn) * one - matrix, block)).real
    return out


def rayleigh_ritz(matrix: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ritz values, rising, and vectors in the span of ``block``."""
    u, s, _ = np.linalg.svd(block, full_matrices=False)
    q = u[:, s > 1e-14 * s[0]]
    small = q.T @ matrix @ q
    values, turned = np.linalg.eigh((small + small.T) / 2)
    return values, q @ turned


def eigenpairs_between(matrix: np.ndarray, low: float, high: float, number: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The ``number`` eigenvalues in (low, high] and their vectors."""
    d, scale = len(matrix), np.abs(matrix).sum(axis=1).max()
    columns = min(d, max(2 * number, number + 4))
    while True:
        block = np.random.default_rng(seed).normal(size=(d, columns))
        best = np.inf
        for _ in range(ROUNDS):
            values, vectors = rayleigh_ritz(matrix, project(matrix, low, high, block))
            inside = (values > low) & (values <= high)
            residual = np.linalg.norm(matrix @ vectors - vectors * values, axis=0)[inside].max(initial=0.0) / scale
            if inside.sum() == number and (residual <= 4 * np.finfo(float).eps or residual <= 1e-13 and residual > best / 2):
                return values[inside], vectors[:, inside]
            best, block = min(best, residual), vectors
        if columns == d:
            raise EigenvaluesMissed(f"{int(inside.sum())} of {number} eigenvalues between {low} and {high}")
        columns = min(d, 2 * columns)


def leading_eigenpairs(matrix: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``number`` largest eigenvalues above zero (fewer, if there are fewer), falling, and unit vectors as columns.

    Each vector's largest entry is positive.
    """
    trace = float(np.trace(matrix))
    zero = NOTHING * trace
    number = min(number, eigenvalues_above(matrix, zero)) if trace > 0 else 0
    if not number:
        return np.zeros(0), np.zeros((len(matrix), 0))
    # the norm bounds the largest; the cut leaves those wanted above it and few others
    top = float(np.abs(matrix).sum(axis=1).max()) * (1 + 1e-9)
    few = lambda count: 1 if count > number + BLOCK - 1 else -1 if count < number else 0
    found = clear_cut(matrix, zero, top, few) or (zero, eigenvalues_above(matrix, zero))
    waiting, pairs = [(found[0], top, found[1])], []
    while waiting:
        low, high, count = waiting.pop()
        above = eigenvalues_above(matrix, high)
        cut = None
        if count > BLOCK:
            cut = clear_cut(matrix, low, high, lambda n: 1 if n - above >= count else -1 if n == above else 0)
        if cut:
            waiting += [(low, cut[0], count - (cut[1] - above)), (cut[0], high, cut[1] - above)]
        elif count:
            pairs.append(eigenpairs_between(matrix, low, high, count))
    values, vectors = rayleigh_ritz(matrix, np.concatenate([v for _, v in pairs], axis=1))
    if len(values) != found[1]:
        raise EigenvaluesMissed(f"{len(values)} of {found[1]} eigenvalues above {found[0]}")
    values, vectors = values[::-1][:number], vectors[:, ::-1][:, :number]
    vectors = vectors / np.linalg.norm(vectors, axis=0)
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(number)])
    return values, vectors * signs


@dataclass
class Whitening:
    """A fit: ``n`` vectors with the integer ``sums``, eigenvalues and vectors of their covariance, and its trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([float(Fraction(s, self.n)) for s in self.sums])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Rows of integers on the components, scaled to variance one."""
        return (x - self.mean) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The exact sum of (n x - S)^2 of each row; null where it fits no long."""
        sums, size = self.sums, len(self.sums)
        if max(map(abs, sums)) + self.n * int(np.abs(x).max(initial=0)) <= LONG:
            apart = self.n * x - np.array(sums, dtype=np.int64)
            narrow = np.abs(apart).max(axis=1, initial=0) <= math.isqrt(LONG // size)
            out = (np.where(narrow[:, None], apart, 0) ** 2).sum(axis=1).tolist()
        else:  # the differences themselves need more than 64 bits
            apart = [[self.n * v - s for v, s in zip(row, sums)] for row in x.tolist()]
            narrow, out = np.zeros(len(x), dtype=bool), [None] * len(x)
        for i in np.flatnonzero(~narrow):
            exact = sum(int(v) ** 2 for v in apart[i])
            out[i] = exact if exact <= LONG else None
        return out


def vectors_of(embeddings: DataFrame) -> DataFrame:
    """vec_id, vec (doubles), of the rows whose vector is neither null nor empty."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec"))
    return rows.where("vec IS NOT NULL AND size(vec) > 0")


def integers(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors of ``size`` entries take part, and the integer form of those that do.

    Vectors that hold a null or non-finite entry, or one of ``LARGEST`` or more,
    do not.
    """
    c = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)  # nulls become NaN
    good = (np.abs(c) < LARGEST).all(axis=1)
    return good, np.floor(SCALE * c[good]).astype(np.int64) + SHIFT


def summed(rows: DataFrame, size: int, partial, kind: str) -> pa.Table:
    """i, j, v: entry by entry sums of the small matrices that ``partial`` makes of each batch; a row for each entry and task.

    ``partial`` maps integers (rows x size) to a matrix of ``kind`` numbers.
    """
    text = kind.startswith("decimal")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            _, x = integers(batch.column(0), size)
            if len(x):
                part = partial(x)
                total = part if total is None else total + part
        if total is not None:
            i, j = (a.ravel() for a in np.indices(total.shape))
            values = pa.array([str(v) for v in total.ravel()] if text else total.ravel())
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), values], ["i", "j", "v"])

    parts = rows.select("vec").mapInArrow(run, f"i int, j int, v {'string' if text else kind}")
    # as many rows as the matrix has entries, of 16 bytes each
    return parts.groupBy("i", "j").agg(F.sum(F.col("v").cast(kind)).alias("v")).toArrow()


def as_matrix(entries: pa.Table, rows: int, columns: int) -> np.ndarray:
    out = np.zeros((rows, columns))
    out[entries["i"].to_numpy(), entries["j"].to_numpy()] = entries["v"].to_numpy()
    return out


def fit(rows: DataFrame, size: int, components: int = COMPONENTS) -> Whitening | None:
    """Fit on all rows (vec_id, vec) of vectors of ``size`` entries; None where none takes part."""

    def first(x):  # exact whatever the number of rows: integers without bound
        return np.concatenate([[len(x)], x.astype(object).sum(axis=0) if np.abs(x).max() > 2**40 else x.sum(axis=0)]).astype(object)[None, :]

    got = summed(rows, size, first, "decimal(38,0)")
    if not len(got):
        return None
    n, *sums = (int(v) for _, v in sorted(zip(got["j"].to_pylist(), got["v"].to_pylist())))
    mean = np.array([float(Fraction(s, n)) for s in sums])

    def second(x):  # centred before multiplying
        apart = x - mean
        return apart.T @ apart

    covariance = as_matrix(summed(rows, size, second, "double"), size, size) / n
    covariance = (covariance + covariance.T) / 2
    values, vectors = leading_eigenpairs(covariance, components)
    return Whitening(n, sums, values, vectors, float(np.trace(covariance)))


def identity_error(rows: DataFrame, size: int, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened rows minus the identity, from the rows themselves."""
    k = len(model.values)

    def moments(x):
        w = model.whitened(x)
        return np.concatenate([w.T @ w, w.sum(axis=0)[None, :]])

    got = as_matrix(summed(rows, size, moments, "double"), k + 1, k) / model.n
    return float(np.abs(got[:k] - np.outer(got[k], got[k]) - np.eye(k)).max())


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each usable vector and component.

    Vectors of different lengths cannot share a covariance: each length is a fit
    of its own, with its own n.  Eigenvalues that are zero (beside the trace)
    have no component, so equal vectors, or a single one, give no rows; so does
    an empty table.  Rows that repeat count, and return, as often as they stand;
    a null vec_id stays null; extra columns are not read.  deviation is null
    where the exact value fits no long.
    """
    spark, out = embeddings.sparkSession, None
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    names = [f.strip().split()[0] for f in schema.split(",")]
    rows = vectors_of(embeddings)
    for size in sorted(r["size"] for r in rows.select(F.size("vec").alias("size")).distinct().collect()):
        same = rows.where(F.size("vec") == size)
        model = fit(same, size, components)
        k = len(model.values) if model else 0
        if not k:
            continue
        error, explained = identity_error(same, size, model), model.values / model.trace

        def score(batches, size=size, model=model, k=k, error=error, explained=explained):
            for batch in batches:
                good, x = integers(batch.column(1), size)
                each = np.repeat(np.arange(len(x)), k)
                columns = [
                    batch.column(0).filter(pa.array(good)).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(each), model.n)),
                    pa.array(model.deviations(x), pa.int64()).take(pa.array(each)),
                    pa.array(model.whitened(x).ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(each), error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

        part = same.mapInArrow(score, schema)
        out = part if out is None else out.unionAll(part)
    return spark.createDataFrame([], schema) if out is None else out
