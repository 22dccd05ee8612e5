"""Exact quantiles by rank selection: bounds around each wanted rank are narrowed with counts only.

A double has an order-preserving 64-bit form (sign, exponent, mantissa).  A first
job counts rows by group and the first 24 bits (whole numbers below 2^17 have a
bucket each) and says which buckets hold the wanted ranks.  A bucket with a
single value is an answer.  Where others are left, a second job counts only their
rows, those between the bucket's smallest and largest value, by the next bits, and
a third, if need be, by all 64.  Counts combine before
each shuffle, so what is shuffled is bounded by groups x buckets and never carries
distinct values, however many there are.

The jobs run when the quantiles are asked for, as a model's ``fit`` does: the
driver receives the few buckets that hold a wanted rank, for each group, and the
result is a small local table.  The number of groups is therefore bounded: by the
caller, or by ``MAX_GROUPS``, beyond which it raises; ``many_groups=True`` of
:mod:`tutorlens.operators.quantiles` has no such bound and collects nothing.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tutorlens.functions.sqltext import ident

#: Groups whose ranks the driver may hold (a few hundred bytes each).
MAX_GROUPS = 10_000
#: Bits of the order form below those of the first and of the second pass; whole numbers below 2^UNITS are told apart by the first.
FIRST, SECOND, UNITS = 40, 20, 17
_TWO_52 = "4503599627370496"


def with_order_bits(rows: DataFrame, moments: bool = False) -> DataFrame:
    """Adds ``_k``, the order-preserving integer of the double ``_v``, ``_b1``, the smallest ``_k`` of its first
    bucket, and with ``moments`` ``_o``, a value that the bucket's values have in common.

    Arithmetic on powers of two is exact, so this is the bit form itself: the
    exponent's estimate by the logarithm is put right by comparison.  NaN comes
    last, both zeros are one, a missing value has none.
    """
    x = rows.withColumn("_a", F.abs("_v"))
    x = x.withColumn("_e", F.expr("CAST(IF(_a > 0 AND _a < double('Infinity'), floor(log2(_a)), -1022) AS INT)"))
    x = x.withColumn("_e", F.expr("greatest(-1022, _e + IF(_a >= pow(2D, _e + 1), 1, 0) - IF(_a < pow(2D, _e), 1, 0))"))
    x = x.withColumn("_p", F.expr("pow(2D, _e)")).withColumn("_m", F.expr(f"_a / _p * {_TWO_52}D"))
    # from 2^(52 - FIRST) on, a bucket for each unit; from 2^UNITS on again as many for each power of two
    x = x.withColumn("_low", F.expr(f"IF(_e >= {UNITS}, {FIRST}, least({FIRST}, 52 - _e))"))
    size = f"IF(_a < double('Infinity'), (CAST(_e AS BIGINT) + 1022) * {_TWO_52} + CAST(_m AS BIGINT), 2047 * {_TWO_52} + IF(isnan(_v), 1, 0))"
    x = x.withColumn("_k", F.expr(f"CASE WHEN _v < 0 THEN -({size}) - 1 WHEN _v IS NOT NULL THEN {size} END"))
    x = x.withColumn("_b1", F.expr("shiftleft(shiftright(_k, _low), _low)"))
    if moments:
        cut = "CAST(shiftleft(1L, _low) AS DOUBLE)"
        x = x.withColumn("_o", F.expr(f"IF(_v < 0, -1D, 1D) * (floor(_m / {cut}) * {cut}) * (_p / {_TWO_52}D)"))
    return x.drop("_a", "_e", "_p", "_m", "_low")


def _source(df: DataFrame, value: str, by: Sequence[str], weight: str | None, keep_missing: bool) -> tuple[DataFrame, list[str]]:
    """_g0..., _v, _w of the rows that count."""
    x = df.selectExpr(
        *[f"{ident(b)} AS _g{i}" for i, b in enumerate(by)],
        f"CAST({ident(value)} AS DOUBLE) AS _v",
        f"CAST({ident(weight) if weight else 1} AS BIGINT) AS _w",
    )
    if not by:
        x = x.selectExpr("TRUE AS _g0", "_v", "_w")
    groups = [f"_g{i}" for i in range(max(1, len(by)))]
    keep = " AND ".join([f"{g} IS NOT NULL" for g in groups] + ([] if keep_missing else ["_v IS NOT NULL"]))
    return x.where(keep), groups


def first_counts(x: DataFrame, groups: Sequence[str], moments: bool) -> DataFrame:
    """Rows by group and the first bits: the only shuffle that every row may reach, a row for each bucket at most."""
    counts = {"_bn": "SUM(IF(_v IS NULL, 0, _w))", "_blo": "MIN(_v)", "_bhi": "MAX(_v)"}
    if moments:
        counts |= {"_bs": "SUM(_v * _w)", "_d1": "SUM((_v - _o) * _w)", "_d2": "SUM((_v - _o) * (_v - _o) * _w)", "_bo": "MIN(_o)"}
    return with_order_bits(x, moments).groupBy(*groups, "_b1").agg(*[F.expr(e).alias(name) for name, e in counts.items()])


def selected_quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    names: Sequence[str] | None = None,
    weight: str | None = None,
    moments: bool = False,
    keep_groups: bool = False,
    max_groups: int | None = MAX_GROUPS,
) -> DataFrame:
    """Linear-interpolated quantiles of ``value``, one row for each group of ``by`` (a missing key is none).

    With ``moments`` the row also carries ``n``, ``mean``, ``std`` (sample),
    ``min`` and ``max``.  Missing values are skipped; a group with no value has
    no row, or with ``keep_groups`` a row of nulls.  ``max_groups=None`` says
    that the caller bounds the groups itself.
    """
    names = list(names) if names is not None else [f"q{i}" for i in range(len(probs))]
    x, groups = _source(df, value, by, weight, keep_groups)
    g = ", ".join(groups)

    # First pass.  Deviations are taken from the value that the first bits stand for,
    # so the sums of squares stay small, and combined as Chan et al. do.
    running = first_counts(x, groups, moments).selectExpr(
        *groups, "_b1", "_bn", "_blo", "_bhi",
        f"SUM(_bn) OVER (PARTITION BY {g} ORDER BY _b1) - _bn AS _before",
        f"SUM(_bn) OVER (PARTITION BY {g}) AS _n",
        f"ROW_NUMBER() OVER (PARTITION BY {g} ORDER BY _b1) = 1 AS _head",
        *(
            [
                f"SUM(_bs) OVER (PARTITION BY {g}) AS _sum",
                f"MIN(_blo) OVER (PARTITION BY {g}) AS _lo",
                f"MAX(_bhi) OVER (PARTITION BY {g}) AS _hi",
                "_bo + try_divide(_d1, _bn) AS _bmean",
                "_d2 - try_divide(_d1 * _d1, _bn) AS _bm2",
            ]
            if moments
            else ["CAST(NULL AS DOUBLE) AS _sum", "CAST(NULL AS DOUBLE) AS _lo", "CAST(NULL AS DOUBLE) AS _hi"]
        ),
    )
    spread = f"SUM(_bm2 + _bn * (_bmean - try_divide(_sum, _n)) * (_bmean - try_divide(_sum, _n))) OVER (PARTITION BY {g})"
    running = running.withColumn("_m2", F.expr(spread if moments else "CAST(NULL AS DOUBLE)"))
    # Every wanted order statistic: which 0/1 is the floor/ceil of its position.
    wanted = []
    for i, p in enumerate(probs):
        pos = f"(CAST(_n - 1 AS DOUBLE) * CAST({float(p)!r} AS DOUBLE))"
        for which, k in ((0, f"FLOOR({pos})"), (1, f"CEIL({pos})")):
            wanted.append(f"struct({i} AS pi, {which} AS which, CAST({k} AS BIGINT) - _before AS rank, {pos} - FLOOR({pos}) AS frac)")
    here = f"filter(array({', '.join(wanted)}), t -> t.rank >= 0 AND t.rank < _bn) AS hits"
    # a row for each bucket that holds a rank, and one for each group at least, so that it keeps its moments
    hits = running.selectExpr(*groups, "_b1", "_blo", "_bhi", "_n", "_sum", "_m2", "_lo", "_hi", "_head", here).where("_head OR size(hits) > 0")
    bound = None if max_groups is None or not by else max_groups * (2 * len(probs) + 1)
    rows = (hits if bound is None else hits.limit(bound + 1)).collect()
    names_of_groups = {tuple(r[: len(groups)]) for r in rows}
    if bound is not None and (len(rows) > bound or len(names_of_groups) > max_groups):
        raise ValueError(f"more than {max_groups} groups: use many_groups=True")

    found, still, stat = {}, [], {}
    for r in rows:
        group = tuple(r[: len(groups)])
        if r["_head"]:
            stat[group] = r
        for t in r["hits"]:
            # (a NaN is its own value, too)
            if r["_blo"] == r["_bhi"] or r["_blo"] != r["_blo"]:
                found[group, t["pi"], t["which"]] = r["_blo"], t["frac"]
            else:
                still.append((group, r["_blo"], r["_bhi"], t["pi"], t["which"], t["rank"], t["frac"]))
    types = T.StructType([T.StructField(g, x.schema[g].dataType) for g in groups])
    for number in (2, 3):
        if still:
            still = _narrowed(x, groups, types, still, number, found)
    return _interpolated(df, by, probs, names, moments, keep_groups, found, stat)


def _narrowed(x: DataFrame, groups: Sequence[str], types: T.StructType, still: list[tuple], number: int, found: dict) -> list[tuple]:
    """One more pass over the rows of the buckets ``still`` open: adds to ``found``, and returns what is left open.

    still: group, smallest and largest value of the bucket, pi, which, rank within the bucket, frac.  The second
    pass counts by the bits above ``SECOND``, the third by all.

    A bucket is an interval, so its rows are found by its own bounds.  The bits are taken of those rows only; as
    keys of the join they would be put into the join's condition, which every row then computes many times over.
    """
    spark = x.sparkSession
    # the open buckets, and the ranks in them: a few rows for each group
    buckets: dict[tuple, tuple[int, float]] = {}  # by group and smallest value: number, largest value
    asked = []
    for group, lo, hi, *rank in still:
        at, _ = buckets.setdefault((group, lo), (len(buckets), hi))
        asked.append((at, *rank))
    groups_of = [group for group, _ in buckets]
    bounds = T.StructType([*types.fields]).add("_open", "integer").add("_lo", "double").add("_hi", "double")
    open_buckets = F.broadcast(spark.createDataFrame([(*group, at, lo, hi) for (group, lo), (at, hi) in buckets.items()], bounds))
    ranks = F.broadcast(spark.createDataFrame(asked, "_open int, pi int, which int, rank long, frac double"))
    inside = x.join(open_buckets, list(groups)).where("_v >= _lo AND _v <= _hi").select("_open", "_v", "_w")
    fine = f"shiftright(_k, {SECOND})" if number == 2 else "_k"
    counts = with_order_bits(inside).selectExpr("_open", "_v", "_w", f"{fine} AS _fine").groupBy("_open", "_fine").agg(
        F.sum("_w").alias("_bn"), F.min("_v").alias("_blo"), F.max("_v").alias("_bhi")
    )
    placed = counts.selectExpr("*", "SUM(_bn) OVER (PARTITION BY _open ORDER BY _fine) - _bn AS _before")
    out = []
    for r in placed.join(ranks, "_open").where("rank >= _before AND rank < _before + _bn").collect():
        group = groups_of[r["_open"]]
        if r["_blo"] == r["_bhi"] or r["_blo"] != r["_blo"] or number == 3:
            found[group, r["pi"], r["which"]] = r["_blo"], r["frac"]
        else:
            out.append((group, r["_blo"], r["_bhi"], r["pi"], r["which"], r["rank"] - r["_before"], r["frac"]))
    return out


def _interpolated(df: DataFrame, by, probs, names, moments: bool, keep_groups: bool, found: dict, stat: dict) -> DataFrame:
    """The result: a local table with a row for each group."""
    rows = []
    for group, r in stat.items():
        n = int(r["_n"])
        if not n and not keep_groups:
            continue
        row = list(group) if by else []
        for i in range(len(probs)):
            (low, frac), (high, _) = (found.get((group, i, which), (None, None)) for which in (0, 1))
            row.append(None if low is None else low + (high - low) * frac)
        if moments:
            mean = r["_sum"] / n if n else None
            std = math.sqrt(max(r["_m2"], 0.0) / (n - 1)) if n > 1 else None
            row += [n, mean, std, r["_lo"], r["_hi"]]
        rows.append(tuple(row))
    schema = T.StructType([T.StructField(b, df.schema[b].dataType) for b in by])
    for name in names:
        schema = schema.add(name, "double")
    if moments:
        schema = schema.add("n", "long").add("mean", "double").add("std", "double").add("min", "double").add("max", "double")
    return df.sparkSession.createDataFrame(rows, schema)
