"""Chart data without the charts.

* :func:`histogram`: numpy's equal-width bins over [min, max] (the last bin is
  closed; a constant column gets [v - 0.5, v + 0.5]), empty bins included.
* :func:`density_curve`: the Gaussian KDE drawn over a histogram: Scott's
  bandwidth ``std * n^(-1/5)``, ``grid`` points on [min, max], and the curve
  scaled by ``n * bin width`` to sit on the count histogram.
* :func:`box_stats`: quartiles, 1.5-IQR whiskers and outlier counts per group.

Each works on counts and sums that combine before the shuffle, never on rows
gathered in one place; global parameters (min, max, n, std) are scalar subqueries,
or the one row of a first pass, inlined as literals.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tutorlens.operators.quantiles import quantiles_from_counts, value_counts_of
from tutorlens.operators.selection import selected_quantiles

#: Width of a density cell and how far it reaches, in bandwidths; terms of its series.
CELL, REACH, TERMS = 0.25, 9, 12


def _edge(i, lo, hi, step, bins: int):
    """numpy.linspace edge ``i``: i * step + lo, and exactly ``hi`` at the end."""
    return F.when(i == F.lit(bins), hi).otherwise(i.cast("double") * step + lo)


def histogram(df: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """(bin, bin_start, bin_end, count) for ``bins`` equal-width bins."""
    # Bounds and bins both come from the value counts, whose exchange is reused:
    # the input is read once.
    x = value_counts_of(df, value).withColumnRenamed("_v", "_x")
    st = x.agg(F.struct(F.min("_x").alias("lo"), F.max("_x").alias("hi"), F.count("_c").alias("nd")).alias("s")).scalar()
    lo = F.when(st["lo"] == st["hi"], st["lo"] - 0.5).otherwise(st["lo"])
    hi = F.when(st["lo"] == st["hi"], st["hi"] + 0.5).otherwise(st["hi"])
    step = (hi - lo) / F.lit(float(bins))

    raw = F.least(F.floor((F.col("_x") - lo) / (hi - lo) * F.lit(float(bins))), F.lit(bins - 1)).cast("int")
    # numpy's correction against the actual edges (index may be off by one ulp).
    lower = F.when(F.col("_x") < _edge(F.col("_i0"), lo, hi, step, bins), F.col("_i0") - 1)
    upper = F.when(
        (F.col("_i0") < bins - 1) & (F.col("_x") >= _edge(F.col("_i0") + 1, lo, hi, step, bins)), F.col("_i0") + 1
    )
    counts = (
        x.withColumn("_i0", raw)
        .select(F.coalesce(lower, upper, F.col("_i0")).alias("bin"), "_c")
        .groupBy("bin")
        .agg(F.sum("_c").alias("count"))
    )
    spark = df.sparkSession
    all_bins = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    b = F.col("bin")
    # Both sides have at most ``bins`` rows.
    return all_bins.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        _edge(b, lo, hi, step, bins).alias("bin_start"),
        _edge(b + 1, lo, hi, step, bins).alias("bin_end"),
        F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"),
    )


def _hermite(terms: int) -> list[list[int]]:
    """Coefficients, lowest power first, of the first Hermite polynomials (those of exp(-z^2/2))."""
    rows = [[1], [0, 1]]
    for k in range(1, terms - 1):
        up = [0, *rows[k]]
        down = rows[k - 1] + [0] * (len(up) - len(rows[k - 1]))
        rows.append([a - k * b for a, b in zip(up, down)])
    return rows[:terms]


def density_curve(df: DataFrame, value: str, grid: int = 200, bins: int = 30, digits: int | None = 6) -> DataFrame:
    """(point, x, density, scaled) of the Gaussian KDE on ``grid`` points.

    ``density`` integrates to 1; ``scaled`` = density * n * bin width matches a
    ``bins``-bin count histogram.  Fewer than 2 values or zero spread give no
    rows (the curve is skipped, as seaborn does for a singular sample).

    A fast Gauss sum: one pass for n, spread and range; one that sums, for each
    cell of ``CELL`` bandwidths, the first ``TERMS`` powers of the values'
    distances from its middle; then each cell gives its Hermite series to the
    points within ``REACH`` bandwidths.  By Cramer's bound the rest of a series
    is below 1.09 (CELL/2)^TERMS / sqrt(TERMS!) < 1e-15 of a value's own peak,
    and what lies beyond the reach below exp(-REACH^2/2) < 3e-18.  The work after
    the passes is cells x grid, whatever the number of distinct values.
    """
    x = df.select(F.col(value).cast("double").alias("_v")).where("_v IS NOT NULL")
    spark = df.sparkSession
    st = x.agg(F.count("_v").alias("n"), F.stddev_samp("_v").alias("sd"), F.min("_v").alias("lo"), F.max("_v").alias("hi")).first()
    n, lo, hi = st["n"], st["lo"], st["hi"]
    if n < 2 or not st["sd"]:
        return spark.createDataFrame([], "point int, x double, density double, scaled double")
    bw, step = st["sd"] * n**-0.2, (hi - lo) / (grid - 1)

    cells = x.selectExpr("_v", f"floor((_v - {lo!r}D) / {bw * CELL!r}D) AS _cell").selectExpr("_v", f"{lo!r}D + (_cell + 0.5D) * {CELL * bw!r}D AS _mid")
    cells = cells.selectExpr("_mid", f"(_v - _mid) / {bw!r}D AS _t")
    powers = ["1D", "_t"]
    for _ in range(TERMS - 2):
        powers.append(f"{powers[-1]} * _t")
    sums = cells.groupBy("_mid").agg(*[F.expr(f"SUM({p})").alias(f"_s{k}") for k, p in enumerate(powers)])
    # the series as one polynomial in z: its coefficients, lowest power first
    hermite = _hermite(TERMS)
    power = [
        " + ".join(f"_s{k} * {h[j] / math.factorial(k)!r}D" for k, h in enumerate(hermite) if j < len(h) and h[j])
        for j in range(TERMS)
    ]
    near = (
        f"greatest(0, ceil((_mid - {REACH * bw!r}D - {lo!r}D) / {step!r}D))",
        f"least({grid - 1}, floor((_mid + {REACH * bw!r}D - {lo!r}D) / {step!r}D))",
    )
    points = sums.selectExpr("_mid", *[f"{p} AS _c{j}" for j, p in enumerate(power)], f"{near[0]} AS _from", f"{near[1]} AS _to")
    points = points.where("_from <= _to").selectExpr("*", "explode(sequence(_from, _to)) AS point")
    points = points.withColumn("_z", F.expr(f"({lo!r}D + point * {step!r}D - _mid) / {bw!r}D"))
    series = f"_c{TERMS - 1}"
    for j in range(TERMS - 2, -1, -1):
        series = f"({series}) * _z + _c{j}"
    found = points.groupBy(F.col("point").cast("int").alias("point")).agg(F.expr(f"SUM(exp(-0.5D * _z * _z) * ({series})) AS _s"))

    density = F.coalesce("_s", F.lit(0.0)) / (n * bw * math.sqrt(2.0 * math.pi))
    gx = f"IF(point = {grid - 1}, {hi!r}D, point * {step!r}D + {lo!r}D) AS x"
    every = spark.range(grid).selectExpr("CAST(id AS INT) AS point")
    # both sides have at most ``grid`` rows
    out = every.join(F.broadcast(found), "point", "left").select("point", F.expr(gx), density.alias("density"))
    out = out.withColumn("scaled", F.col("density") * n * ((hi - lo) / bins))
    if digits is not None:
        out = out.select("point", *[F.round(c, digits).alias(c) for c in ["x", "density", "scaled"]])
    return out


def box_stats(
    df: DataFrame,
    value: str,
    by: Sequence[str],
    weight: str | None = None,
    whis: float = 1.5,
    digits: int | None = 6,
    many_groups: bool = False,
) -> DataFrame:
    """A24 over rows (optionally weighted): one row per group, missing values and keys dropped.

    Columns: n, mean, q1, median, q3, iqr, whisker_low, whisker_high,
    n_outliers, min, max.  Whiskers are the most extreme values inside
    [q1 - whis*iqr, q3 + whis*iqr] (never inside the box).  Outliers lie
    beyond the whiskers, which are exactly the values beyond the fences: the
    low whisker is the smallest value at or above the low fence, or q1 when that
    value is above q1, and in both cases no value lies between the fence and
    the whisker.  So whiskers and outliers come from one aggregate over the rows,
    or with ``many_groups`` over their value counts.
    """
    by = list(by)
    base = df
    for b in by:
        base = base.where(F.col(b).isNotNull())
    names = ["q1", "median", "q3"]
    if many_groups:
        rows = value_counts_of(base, value, by, weight)
        qs = quantiles_from_counts(rows, [0.25, 0.5, 0.75], by, names=names, moments=True)
    else:
        rows = base.select(*by, F.col(value).cast("double").alias("_v"), (F.col(weight) if weight else F.lit(1)).cast("long").alias("_c")).where("_v IS NOT NULL")
        qs = selected_quantiles(rows, "_v", [0.25, 0.5, 0.75], by, names=names, weight="_c", moments=True)
    iqr = F.col("q3") - F.col("q1")
    fences = qs.select(
        *by, "n", "mean", "q1", "median", "q3", "min", "max", iqr.alias("iqr"),
        (F.col("q1") - F.lit(whis) * iqr).alias("_lo_fence"),
        (F.col("q3") + F.lit(whis) * iqr).alias("_hi_fence"),
    )
    if not many_groups:
        fences = F.broadcast(fences)  # local: a row for each group, MAX_GROUPS at most
    v, c = F.col("_v"), F.col("_c")
    # The fence columns are constant per group: grouping on them carries them.
    carried = ["n", "mean", "q1", "median", "q3", "min", "max", "iqr", "_lo_fence", "_hi_fence"]
    s = rows.join(fences, by).groupBy(*by, *carried).agg(
        F.min(F.when(v >= F.col("_lo_fence"), v)).alias("_wlo"),
        F.max(F.when(v <= F.col("_hi_fence"), v)).alias("_whi"),
        F.sum(F.when((v < F.col("_lo_fence")) | (v > F.col("_hi_fence")), c).otherwise(0)).alias("n_outliers"),
    )
    wlo = F.when(F.col("_wlo").isNull() | (F.col("_wlo") > F.col("q1")), F.col("q1")).otherwise(F.col("_wlo"))
    whi = F.when(F.col("_whi").isNull() | (F.col("_whi") < F.col("q3")), F.col("q3")).otherwise(F.col("_whi"))
    r = (lambda x: F.round(x, digits)) if digits is not None else (lambda x: x)
    return s.select(
        *by,
        F.col("n").cast("long").alias("n"),
        r(F.col("mean")).alias("mean"),
        r(F.col("q1")).alias("q1"),
        r(F.col("median")).alias("median"),
        r(F.col("q3")).alias("q3"),
        r(F.col("iqr")).alias("iqr"),
        r(wlo).alias("whisker_low"),
        r(whi).alias("whisker_high"),
        F.col("n_outliers").cast("long").alias("n_outliers"),
        r(F.col("min")).alias("min"),
        r(F.col("max")).alias("max"),
    )
