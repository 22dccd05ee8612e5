"""Table profiling: null counts, shapes, numeric summaries, value counts, keys.

Reports are long-format DataFrames (one row per table / column / value), built
by single aggregates per table and stacked with ``unionByName``; only their
small results are ever collected, by the caller.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tutorlens.functions.rounding import percent_of, round_half_even
from tutorlens.functions.sqltext import ident, literal
from tutorlens.operators.quantiles import quantiles
from tutorlens.operators.selection import selected_quantiles


def null_counts(df: DataFrame, only_missing: bool = False) -> DataFrame:
    """M6 (and F9 with ``only_missing``): (column, null_count) in column order."""
    cols = df.columns
    wide = df.agg(*[F.count_if(F.col(ident(c)).isNull()).alias(f"c{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"{i}, {literal(c)}, c{i}" for i, c in enumerate(cols))
    out = wide.selectExpr(f"stack({len(cols)}, {pairs}) AS (position, column_name, null_count)")
    if only_missing:
        out = out.where(F.col("null_count") > 0)
    return out


def registry_null_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """S4 + M6: null counts of every column of every table in the registry."""
    out = None
    for name, df in tables.items():
        part = null_counts(df).select(F.lit(name).alias("table_name"), "position", "column_name", "null_count")
        out = part if out is None else out.unionByName(part)
    return out


def table_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """S4 + A18: (table_name, n_rows, n_cols, columns) for each registered table."""
    out = None
    for name, df in tables.items():
        part = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"),
            "n_rows",
            F.lit(len(df.columns)).alias("n_cols"),
            F.lit(", ".join(df.columns)).alias("columns"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def previews(tables: Mapping[str, DataFrame], n: int = 5) -> DataFrame:
    """O3 for every registered table: (table_name, row, content) of its first ``n`` rows by all its columns.

    content is the row as JSON, missing values included.
    """
    out = None
    for name, df in tables.items():
        head = df.orderBy(*[ident(c) for c in df.columns]).limit(n)
        part = head.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("content"))
        # at most n rows: the window is as small as the preview
        part = part.selectExpr(f"{literal(name)} AS table_name", "CAST(monotonically_increasing_id() AS INT) + 1 AS row", "content")
        out = part if out is None else out.unionByName(part)
    return out


def preview(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """O3: the first ``n`` rows by an explicit order (``head()`` has file order)."""
    if not order_by:
        raise ValueError("preview needs an order key")
    return df.orderBy(*order_by).limit(n)


NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def describe_tables(
    tables: Mapping[str, DataFrame],
    columns: Mapping[str, Sequence[str]] | None = None,
    digits: int | None = 6,
) -> DataFrame:
    """A13/A14 over several tables at once.

    Every numeric column of every table is stacked into (slot, value) rows, a
    slot for each column, so that one rank selection (quartiles, count, mean,
    std, min, max) serves all of them, ids included as in ``describe()``.
    Columns: table_name, column_name, count, mean, std, min, p25, p50, p75, max.
    A column with no value at all has count 0 and nulls.
    """
    long, names = None, []
    for name, df in tables.items():
        cols = (columns or {}).get(name) or numeric_columns(df)
        pairs = ", ".join(f"{len(names) + i}, CAST({ident(c)} AS DOUBLE)" for i, c in enumerate(cols))
        part = df.selectExpr(f"stack({len(cols)}, {pairs}) AS (slot, value)")
        names += [(len(names) + i, name, c) for i, c in enumerate(cols)]
        long = part if long is None else long.unionByName(part)
    # the groups are the columns listed here, so their number needs no check
    qs = selected_quantiles(long, "value", [0.25, 0.5, 0.75], by=["slot"], names=["p25", "p50", "p75"], moments=True, max_groups=None)
    listing = long.sparkSession.createDataFrame(names, "slot int, table_name string, column_name string")
    keys = ["table_name", "column_name"]
    out = listing.join(qs, "slot", "left").selectExpr(
        *keys, "coalesce(CAST(n AS BIGINT), 0) AS count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )
    if digits is not None:
        out = out.select(*keys, "count", *[F.round(c, digits).alias(c) for c in ["mean", "std", "min", "p25", "p50", "p75", "max"]])
    return out


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None, digits: int | None = 6) -> DataFrame:
    """Count, mean, std, min, quartiles, max per numeric column of one table."""
    cols = {"": list(columns)} if columns is not None else None
    return describe_tables({"": df}, cols, digits).drop("table_name")


def value_counts(df: DataFrame, column: str, normalize: str | None = None, digits: int = 3) -> DataFrame:
    """(value, count[, share or percent]), sorted by count descending, value ascending.

    Missing values are not counted; ``normalize`` = 'share' gives
    count / non-missing total rounded half-even to ``digits``, 'percent' gives
    100 * count / total unrounded.
    """
    counts = (
        df.where(F.col(ident(column)).isNotNull())
        .groupBy(F.col(ident(column)).alias("value"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    # the total is one row, inlined as a scalar subquery; the sort is Spark's distributed one
    total = counts.agg(F.sum("count")).scalar()
    if normalize == "share":
        counts = counts.withColumn("share", round_half_even(F.col("count") / total, digits))
    elif normalize == "percent":
        counts = counts.withColumn("percent", percent_of(F.col("count"), total))
    return counts.orderBy(F.desc("count"), F.asc("value"))


def column_counts(df: DataFrame, columns: Sequence[str], hue: str | None = None) -> DataFrame:
    """(variable, value, number[, hue], count): rows by each value of each column, in one aggregate.

    Grouping sets over the rows as they are, a set for each column (with
    ``hue``, each column beside it): the counts combine before the one shuffle.
    ``number`` is the value of a numeric column.  Missing values are not counted.
    """
    cols, numeric = list(columns), set(numeric_columns(df))
    # a column counted beside itself, or twice, needs a name of its own
    x = df.selectExpr(*[f"{ident(c)} AS _c{i}" for i, c in enumerate(cols)], *([f"{ident(hue)} AS _hue"] if hue else []))
    names = [f"_c{i}" for i in range(len(cols))] + (["_hue"] if hue else [])
    sets = [[F.col(f"_c{i}")] + ([F.col("_hue")] if hue else []) for i in range(len(cols))]
    # the bits of the grouping id say which columns are not in the set, the first column highest
    every = (1 << len(names)) - 1
    ids = [every - (1 << (len(names) - 1 - i)) - (1 if hue else 0) for i in range(len(cols))]
    grouped = x.groupingSets(sets, *[F.col(n) for n in names]).agg(F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("count"))
    pick = lambda f: "CASE " + " ".join(f"WHEN _set = {ids[i]} THEN {f(i, c)}" for i, c in enumerate(cols)) + " END"
    out = grouped.selectExpr(
        f"{pick(lambda i, c: literal(c))} AS variable",
        f"{pick(lambda i, c: f'CAST(_c{i} AS STRING)')} AS value",
        f"{pick(lambda i, c: f'CAST(_c{i} AS DOUBLE)' if c in numeric else 'CAST(NULL AS DOUBLE)')} AS number",
        *([f"_hue AS {ident(hue)}"] if hue else []),
        "count",
    )
    return drop_missing(out, ["value", *([hue] if hue else [])])


def multi_value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A15/A16 for several columns in one scan: (variable, value, count, percent).

    Sorted by variable, count descending, then the value in its own type's
    order (2 before 10).
    """
    counts = column_counts(df, columns)
    totals = counts.groupBy("variable").agg(F.sum("count").alias("total"))  # a row for each column
    return (
        counts.join(totals, "variable")
        .orderBy("variable", F.desc("count"), "number", "value")
        .select("variable", "value", "count", percent_of(F.col("count"), F.col("total")).alias("percent"))
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and rows repeating an earlier key (missing = equal)."""
    per_key = df.groupBy(*[F.col(ident(k)) for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("n_duplicates"),
    )


def duplicate_key_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The offending keys with their row counts (count > 1)."""
    return (
        df.groupBy(*[F.col(ident(k)) for k in keys])
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )


def cross_counts(df: DataFrame, category: str, hue: str, hue_levels: Sequence[str] | None = None) -> DataFrame:
    """Counts per (category, hue), sorted by both; wide by hue when ``hue_levels`` is given, sorted by category."""
    base = drop_missing(df, [category, hue])
    if hue_levels is None:
        return base.groupBy(category, hue).agg(F.count(F.lit(1)).alias("n_rows")).orderBy(category, hue)
    wide = base.groupBy(category).pivot(hue, list(hue_levels)).agg(F.count(F.lit(1)))
    return wide.fillna(0, subset=list(hue_levels)).orderBy(category)


def multi_cross_counts(df: DataFrame, categories: Sequence[str], hue: str) -> DataFrame:
    """A21/O2 for several category columns in one scan: (variable, level, hue, n_rows), sorted by the first three."""
    counts = column_counts(df, categories, hue)
    return counts.orderBy("variable", "number", "value", hue).select("variable", F.col("value").alias("level"), hue, F.col("count").alias("n_rows"))


def group_summary(df: DataFrame, value: str, by: str, digits: int | None = 6, many_groups: bool = False) -> DataFrame:
    """Mean and exact median of ``value`` per ``by``, sorted by it (missing keys dropped).

    A label whose values are all missing keeps its row, with nulls.
    ``many_groups`` is for keys that are not a bounded set of labels.
    """
    base = df.where(F.col(by).isNotNull())
    out = quantiles(base, value, [0.5], by=[by], names=["median_value"], moments=True, keep_groups=True, many_groups=many_groups)
    mean, median = F.col("mean"), F.col("median_value")
    if digits is not None:
        mean, median = F.round(mean, digits), F.round(median, digits)
    return out.select(by, mean.alias("mean_value"), median.alias("median_value")).orderBy(by)


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    cond = None
    for c in columns:
        t = F.col(ident(c)).isNotNull()
        cond = t if cond is None else cond & t
    return df.where(cond) if cond is not None else df
