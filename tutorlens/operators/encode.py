"""Target encoding (P9) and one-hot encoding.

``one_hot`` reproduces ``pandas.get_dummies``: the other columns first, in their
order; then, per category column in the given order, one boolean column per
level, levels sorted ascending, named ``<column>_<level>``; a missing value is
all-false; ``drop_first`` drops the smallest level.  The levels are the schema of
the result, so the wide form takes them as declared; ``discover_levels`` lists
those of a table for a caller that has no declaration.  ``one_hot_positions``
holds the same information as an array of set positions, for vocabularies of any
size: its level index is ranked and joined in Spark.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tutorlens.functions.lookup import TARGET_CODES, map_lookup
from tutorlens.functions.sqltext import ident, literal
from tutorlens.session import materialize

# The category columns that are one-hot encoded.
CATEGORY_COLUMNS = [
    "code_module",
    "code_presentation",
    "gender",
    "region",
    "highest_education",
    "imd_band",
    "age_band",
    "disability",
]


def encode_target(df: DataFrame, source: str = "final_result", target: str = "target") -> DataFrame:
    """Class code of the final result; an unknown or missing label -> null."""
    return df.withColumn(target, map_lookup(source, TARGET_CODES).cast("int"))


def _from_text(text: str, dtype: T.DataType):
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return int(text)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return float(text)
    if isinstance(dtype, T.BooleanType):
        return text == "true"
    return text


def level_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct (i, v): the i-th column's non-missing values as text, in one distributed aggregate."""
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.col(ident(c)).cast("string").alias("v")) for i, c in enumerate(columns)])
    return df.select(F.explode(pairs).alias("p")).select("p.i", "p.v").where(F.col("v").isNotNull()).distinct()


def discover_levels(df: DataFrame, columns: Sequence[str] = CATEGORY_COLUMNS) -> dict[str, list]:
    """Sorted distinct non-missing values per column.

    The driver receives one value for each column of the wide form, that is the
    form's own schema.  Where that is too wide, use :func:`one_hot_positions`.
    """
    cols = list(columns)
    out: dict[str, list] = {c: [] for c in cols}
    for r in level_pairs(df, cols).collect() if cols else []:
        out[cols[r["i"]]].append(_from_text(r["v"], df.schema[cols[r["i"]]].dataType))
    return {c: sorted(v) for c, v in out.items()}


def dummy_name(column: str, level) -> str:
    return f"{column}_{level}"


def one_hot(
    df: DataFrame,
    levels: Mapping[str, Sequence],
    columns: Sequence[str] = CATEGORY_COLUMNS,
    drop_first: bool = False,
) -> DataFrame:
    """E1 (all levels) / E2 (``drop_first=True``) as boolean columns of the declared ``levels``."""
    cols = list(columns)
    kept = [ident(c) for c in df.columns if c not in cols]
    dummies = []
    for c in cols:
        for v in sorted(levels[c])[1 if drop_first else 0 :]:
            dummies.append(f"coalesce({ident(c)} = {literal(v)}, FALSE) AS {ident(dummy_name(c, v))}")
    return df.selectExpr(*kept, *dummies)


def level_index(df: DataFrame, columns: Sequence[str] = CATEGORY_COLUMNS, drop_first: bool = False) -> DataFrame:
    """(i, v, position): every level's place in the wide form, ranked without one big task.

    The distinct levels are range-partitioned by (column, value) and written;
    ranks run within a part, and one row per part carries over what came before.
    """
    levels = level_pairs(df, columns)
    if drop_first:
        first = levels.groupBy("i").agg(F.min("v").alias("v"))
        levels = levels.join(first, ["i", "v"], "left_anti")
    parts = materialize(levels.repartitionByRange("i", "v").withColumn("part", F.spark_partition_id()))
    before = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n")).selectExpr("part", "sum(n) OVER (ORDER BY part) - n AS before")
    nth = parts.selectExpr("i", "v", "part", "row_number() OVER (PARTITION BY part ORDER BY i, v) - 1 AS nth")
    return nth.join(before, "part").selectExpr("i", "v", "CAST(before + nth AS INT) AS position")


def one_hot_positions(
    df: DataFrame,
    columns: Sequence[str] = CATEGORY_COLUMNS,
    drop_first: bool = False,
    output: str = "positions",
) -> DataFrame:
    """The one-hot information as the ascending positions that are set.

    Position p stands for the p-th dummy column of :func:`one_hot` (levels in
    text order).  A missing value, or the dropped first level, sets none.  Each
    column is joined to its part of the level index; the planner broadcasts
    that part where it is small and splits hot levels where it is not.
    """
    cols = list(columns)
    index = materialize(level_index(df, cols, drop_first))
    out = df
    for i, c in enumerate(cols):
        part = index.where(F.col("i") == i).select(F.col("v").alias(f"_v{i}"), F.col("position").alias(f"_p{i}"))
        out = out.join(part, F.col(ident(c)).cast("string") == F.col(f"_v{i}"), "left")
    kept = [ident(c) for c in df.columns if c not in cols]
    found = ", ".join(f"_p{i}" for i in range(len(cols)))
    return out.selectExpr(*kept, f"array_compact(array({found})) AS {ident(output)}")


def feature_columns(df: DataFrame, label: str = "target", exclude: Sequence[str] = ("split",)) -> list[str]:
    """P10: the feature columns (everything but the label and bookkeeping columns)."""
    return [c for c in df.columns if c != label and c not in exclude]


def split_views(df: DataFrame, output: str = "split") -> dict[str, DataFrame]:
    """The three parts of a split frame as filtered views (no copies)."""
    return {name: df.where(F.col(output) == name).drop(output) for name in ("train", "validation", "test")}
