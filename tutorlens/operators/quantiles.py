"""Exact quantiles (linear interpolation, as pandas and numpy) without one big task.

``F.percentile`` keeps a value -> count map of the whole group in one task, which
is unbounded for wide-ranged columns (ids, clicks).  ``quantiles`` selects by rank
with counts only (:mod:`tutorlens.operators.selection`).  There the driver holds a
few rows for each group, so the number of groups is bounded; for any number of
groups (``many_groups=True``) the plan below is lazy and collects nothing:

1. value counts ``(group, v, c)``: a distributed aggregate with map-side combine,
   so a hot group of a third of all rows is absorbed before the shuffle;
2. buckets of equal width on a logarithmic scale over the values of all groups
   (a few far values leave the others spread over many buckets); counts per
   (group, bucket), and one window over that compact table, say which buckets
   hold the order statistics ``floor(p(n-1))`` / ``ceil(p(n-1))``;
3. those few buckets are cut again, into sub-buckets of equal width between
   their own smallest and largest value;
4. only the value counts of the sub-buckets that hold a wanted rank are ranked,
   by a window per sub-bucket, and one final aggregate interpolates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tutorlens.functions.sqltext import ident
from tutorlens.operators.selection import selected_quantiles

DEFAULT_BUCKETS = 1 << 12


def value_counts_of(
    df: DataFrame, value: str, by: Sequence[str] = (), weight: str | None = None, keep_missing: bool = False
) -> DataFrame:
    """Distinct values with multiplicity: (by..., _v, _c); a missing value has a row only with ``keep_missing``."""
    v = F.col(value).cast("double")
    w = F.lit(1).cast("long") if weight is None else F.col(weight).cast("long")
    return (
        (df if keep_missing else df.where(v.isNotNull()))
        .groupBy(*[F.col(b) for b in by], v.alias("_v"))
        .agg(F.sum(w).alias("_c"))
    )


def quantiles_from_counts(
    vc: DataFrame,
    probs: Sequence[float],
    by: Sequence[str] = (),
    names: Sequence[str] | None = None,
    buckets: int = DEFAULT_BUCKETS,
    moments: bool = False,
) -> DataFrame:
    """Quantiles from value counts ``(by..., _v, _c)``; one row per group (a missing key is none).

    With ``moments`` the row also carries ``n``, ``mean``, ``std`` (sample),
    ``min`` and ``max`` of the group, folded through the same stages (no extra
    pass).
    """
    names = list(names) if names is not None else [f"q{i}" for i in range(len(probs))]
    keys = list(by)
    quoted = [ident(k) for k in keys]
    part = f"PARTITION BY {', '.join(quoted)}" if keys else ""

    # The joins below need keys; saying so here keeps all copies of vc alike.
    for k in keys:
        vc = vc.where(F.col(ident(k)).isNotNull())
    # A monotone scale without overflow; its bounds over all groups are one row,
    # a scalar subquery.  Every reader of vc counts or sums _c, so column pruning
    # leaves all copies of vc alike and its exchange is reused: one scan.
    scale = "(signum(_v) * log1p(abs(_v)))"
    b = vc.agg(F.expr(f"struct(min({scale}) AS lo, max({scale}) AS hi, count(_c) AS nd)")).scalar()
    vb = vc.where("_v IS NOT NULL").select(
        *keys, "_v", "_c", b["lo"].alias("_lo"), b["hi"].alias("_hi")
    )
    vb = vb.selectExpr(
        *quoted, "_v", "_c", "_lo", "_hi",
        f"CAST(IF(_hi > _lo, LEAST(FLOOR(({scale} - _lo) / (_hi - _lo) * {buckets}), {buckets - 1}), 0) AS INT) AS _b",
    )

    # Deviations are taken from the bucket's own start, so the sums of squares
    # stay small and the variance is exact to double precision even for large
    # values with a small spread (ids).
    start = f"(_lo + CAST(_b AS DOUBLE) * (_hi - _lo) / {buckets})"
    origin = f"(signum({start}) * expm1(abs({start})))"
    per_bucket = vb.groupBy(*keys, "_b", "_lo", "_hi").agg(
        F.expr("SUM(_c) AS _bn"),
        F.expr("MIN(_v) AS _blo"),
        F.expr("MAX(_v) AS _bhi"),
        F.expr("SUM(_v * _c) AS _bs"),
        F.expr(f"SUM((_v - {origin}) * _c) AS _d1"),
        F.expr(f"SUM((_v - {origin}) * (_v - {origin}) * _c) AS _d2"),
    )
    running = per_bucket.selectExpr(
        *quoted, "_b", "_bn", "_blo", "_bhi",
        f"SUM(_bn) OVER ({part} ORDER BY _b) - _bn AS _before",
        f"SUM(_bn) OVER ({part}) AS _n",
        f"MIN(_blo) OVER ({part}) AS _min",
        f"MAX(_bhi) OVER ({part}) AS _max",
        f"SUM(_bs) OVER ({part}) AS _sum",
        f"{origin} + _d1 / _bn AS _bmean",
        "_d2 - _d1 * _d1 / _bn AS _bm2",
    ).selectExpr(
        "*",
        # Chan et al.: within-bucket squares plus between-bucket spread.
        f"SUM(_bm2 + _bn * (_bmean - _sum / _n) * (_bmean - _sum / _n)) OVER ({part}) AS _m2",
    )
    # Every wanted order statistic as (_pi, _which, _k, _frac); _which 0/1 = floor/ceil.
    wanted = []
    for i, p in enumerate(probs):
        pos = f"(CAST(_n - 1 AS DOUBLE) * CAST({float(p)!r} AS DOUBLE))"
        for which, k in ((0, f"FLOOR({pos})"), (1, f"CEIL({pos})")):
            wanted.append(
                f"named_struct('_pi', {i}, '_which', {which}, '_k', CAST({k} AS BIGINT), '_frac', {pos} - FLOOR({pos}))"
            )
    within = "t -> t._k >= {0} AND t._k < {0} + {1}"
    carried = ["_n", "_sum", "_m2", "_min", "_max"]
    # One row per bucket holding a wanted rank (a handful per group).
    hits = running.selectExpr(
        *quoted, "_b", "_before", "_blo", "_bhi", *carried,
        f"filter(array({', '.join(wanted)}), {within.format('_before', '_bn')}) AS _hits",
    ).where("size(_hits) > 0")

    # The values of those buckets, in sub-buckets between the bucket's own bounds.
    sub = vb.select(*keys, "_b", "_v", "_c").join(hits.select(*keys, "_b", "_blo", "_bhi"), [*keys, "_b"])
    sub = sub.selectExpr(
        *quoted, "_b", "_v", "_c",
        f"CAST(IF(_bhi > _blo, LEAST(FLOOR((_v - _blo) / (_bhi - _blo) * {buckets}), {buckets - 1}), 0) AS INT) AS _s",
    )
    per_sub = sub.groupBy(*keys, "_b", "_s").agg(F.expr("SUM(_c) AS _sn"))
    bucket = f"PARTITION BY {', '.join([*quoted, '_b'])}"
    per_sub = per_sub.selectExpr("*", f"SUM(_sn) OVER ({bucket} ORDER BY _s) - _sn AS _sbefore")
    sub_hits = per_sub.join(hits.select(*keys, "_b", "_before", "_hits", *carried), [*keys, "_b"]).selectExpr(
        *quoted, "_b", "_s", "_before + _sbefore AS _before", *carried,
        f"filter(_hits, {within.format('(_before + _sbefore)', '_sn')}) AS _hits",
    ).where("size(_hits) > 0")

    ranked = sub.join(sub_hits, [*keys, "_b", "_s"])
    cell = f"PARTITION BY {', '.join([*quoted, '_b', '_s'])}"
    picked = (
        ranked.selectExpr(*quoted, "_v", "_c", f"_before + SUM(_c) OVER ({cell} ORDER BY _v) AS _upto", *carried, "_hits")
        .selectExpr(*quoted, "_v", "_c", "_upto", *carried, "explode(_hits) AS h")
        .where("h._k < _upto AND h._k >= _upto - _c")
    )
    aggs = [f"MAX({c}) AS {c}" for c in carried]
    for i in range(len(names)):
        aggs += [
            f"MAX(CASE WHEN h._pi = {i} AND h._which = 0 THEN _v END) AS _lo{i}",
            f"MAX(CASE WHEN h._pi = {i} AND h._which = 1 THEN _v END) AS _hi{i}",
            f"MAX(CASE WHEN h._pi = {i} THEN h._frac END) AS _f{i}",
        ]
    extra = (
        [
            "_n AS n",
            "_sum / _n AS mean",
            "IF(_n > 1, SQRT(GREATEST(_m2, 0) / (_n - 1)), CAST(NULL AS DOUBLE)) AS std",
            "_min AS min",
            "_max AS max",
        ]
        if moments
        else []
    )
    out = picked.groupBy(*keys).agg(*[F.expr(a) for a in aggs]).selectExpr(
        *quoted,
        *[f"_lo{i} + (_hi{i} - _lo{i}) * _f{i} AS `{n}`" for i, n in enumerate(names)],
        *extra,
    )
    return out


def quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    names: Sequence[str] | None = None,
    weight: str | None = None,
    buckets: int = DEFAULT_BUCKETS,
    moments: bool = False,
    keep_groups: bool = False,
    many_groups: bool = False,
) -> DataFrame:
    """Exact linear-interpolated quantiles of ``value`` per group of ``by``.

    Missing values are skipped; a group with no value has no row, or with
    ``keep_groups`` a row of nulls.  ``buckets`` is for ``many_groups``.
    """
    if not many_groups:
        return selected_quantiles(df, value, probs, by, names, weight, moments, keep_groups)
    vc = value_counts_of(df, value, by, weight, keep_missing=keep_groups)
    out = quantiles_from_counts(vc, probs, by, names, buckets, moments)
    if keep_groups:
        groups = vc.groupBy(*by).agg(F.sum("_c").alias("_rows")).drop("_rows")
        out = groups.join(out, list(by), "left")
    return out


def median_of(df: DataFrame, value: str) -> Column:
    """The exact median of a column (null without values), as a literal: the selection runs here."""
    row = quantiles(df, value, [0.5], names=["median"]).first()
    return F.lit(row["median"] if row else None).cast("double")
