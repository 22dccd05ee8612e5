"""Loading and writing tables.

CSV files are read with every column as text, then missing-value tokens are
mapped to null and each column is cast to its schema type, which is how
pandas' ``read_csv`` treats them; doubles get NaN -> null.  Typed formats such as
Parquet have real nulls: their columns are selected as they are, and cast only
where the type differs, so column pruning and filters reach the scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tutorlens.functions.nulls import nan_to_null
from tutorlens.functions.sqltext import ident
from tutorlens.sources import schemas

# The strings pandas' read_csv reads as missing by default.
PANDAS_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)


#: Columns that a source may lack (no operator reads them).
OPTIONAL = ("weight",)


def _conform(df: DataFrame, schema: T.StructType, na_tokens: Iterable[str]) -> DataFrame:
    tokens = list(na_tokens)
    missing = [f.name for f in schema.fields if f.name not in df.columns and f.name not in OPTIONAL]
    if missing:
        raise ValueError(f"input lacks the columns {missing}; it has {df.columns}")
    cols = []
    for field in schema.fields:
        if field.name not in df.columns:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        c = F.col(field.name)
        if tokens and isinstance(df.schema[field.name].dataType, T.StringType):
            c = F.when(~c.isin(tokens), c)
        if df.schema[field.name].dataType != field.dataType:
            c = c.cast(field.dataType)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = nan_to_null(c)
        cols.append(c.alias(field.name))
    return df.select(*cols)


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "csv",
    na_tokens: Iterable[str] | None = PANDAS_NA_TOKENS,
    extra_na_tokens: Iterable[str] = (),
) -> DataFrame:
    """Read one table into its fixed schema; a missing column raises, but for ``OPTIONAL``.

    For CSV, ``na_tokens`` are the text values read as missing (pandas'
    defaults); ``extra_na_tokens`` adds more, e.g. ``("?",)``, which pandas does
    not treat as missing.  Typed formats take neither.
    """
    tokens = [*(na_tokens or ()), *extra_na_tokens] if fmt == "csv" else []
    if fmt == "csv":
        raw = (
            spark.read.option("header", True)
            .option("inferSchema", False)
            .option("nullValue", None)
            .option("emptyValue", "")
            .option("mode", "FAILFAST")
            .csv(path)
        )
    else:
        raw = spark.read.format(fmt).load(path)
    return _conform(raw, schema, tokens)


@dataclass
class Parted:
    """A CSV table that was read once and parted: the good rows in their types, and the bad lines."""

    good: DataFrame
    #: (file, line, reason)
    bad: DataFrame
    #: (file, good_rows, bad_rows), sorted by file
    counts: DataFrame


def read_parted(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    folder: str,
    na_tokens: Iterable[str] | None = PANDAS_NA_TOKENS,
    extra_na_tokens: Iterable[str] = (),
) -> Parted:
    """Read a CSV table as ``read_table`` does, with bad lines written aside instead of ending the job.

    Bad is a line with another number of fields than its header, or with a text
    that is no value of its column's type; the reason names the first such
    column.  Good and bad rows are written to ``folder`` in one pass over the
    files, and read from there.  Empty lines are no rows, as in ``read_table``.
    """
    tokens = [*(na_tokens or ()), *extra_na_tokens]
    options = {"header": True, "inferSchema": False, "emptyValue": "", "mode": "PERMISSIVE"}
    columns = spark.read.options(**options).csv(path).columns
    missing = [f.name for f in schema.fields if f.name not in columns and f.name not in OPTIONAL]
    if missing:
        raise ValueError(f"input lacks the columns {missing}; it has {columns}")
    line = "_line"
    while line in columns:
        line += "_"
    text = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, line]])
    raw = spark.read.options(**options).option("columnNameOfCorruptRecord", line).schema(text).csv(path)
    values, reasons = [], [F.when(F.col(ident(line)).isNotNull(), "number of fields")]
    for field in schema.fields:
        if field.name not in columns:
            values.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        given = F.col(ident(field.name))
        given = F.when(~given.isin(tokens), given) if tokens else given
        value = given.try_cast(field.dataType)
        reasons.append(F.when(given.isNotNull() & value.isNull(), F.concat(F.lit(f"{field.name}: "), given)))
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            value = nan_to_null(value)
        values.append(value.alias(field.name))
    # the line as it was, or the fields it was read into
    fields = F.array_join(F.array(*[F.coalesce(F.col(ident(c)), F.lit("")) for c in columns]), ",")
    parted = raw.select(
        F.struct(*values).alias("row"),
        F.col("_metadata.file_path").alias("file"),
        F.coalesce(F.col(ident(line)), fields).alias("line"),
        F.coalesce(*reasons).alias("reason"),
    )
    # a good row needs its line no more
    parted = parted.withColumn("line", F.when(F.col("reason").isNotNull(), F.col("line"))).withColumn("bad", F.col("reason").isNotNull())
    parted.write.partitionBy("bad").mode("overwrite").parquet(folder)
    back = spark.read.schema(parted.schema).parquet(folder)
    counts = back.groupBy("file").agg(F.count_if(~F.col("bad")).alias("good_rows"), F.count_if("bad").alias("bad_rows"))
    return Parted(back.where("NOT bad").select("row.*"), back.where("bad").select("file", "line", "reason"), counts.orderBy("file"))


def load_tables(
    spark: SparkSession,
    folder: str,
    fmt: str = "csv",
    names: Iterable[str] | None = None,
    bad_rows: str | None = None,
    **kw,
) -> dict[str, DataFrame]:
    """The table registry: name -> DataFrame for the source files in a folder.

    A bad line of a CSV file ends the job that reads it, unless ``bad_rows`` names
    a folder: then the tables are parted (see ``read_parted``) below it.
    """
    wanted = list(names) if names is not None else list(schemas.TABLES)
    out = {}
    for name in wanted:
        stem, schema = schemas.TABLES[name]
        path = f"{folder}/{stem}.{fmt}"
        if fmt == "csv" and bad_rows:
            out[name] = read_parted(spark, path, schema, f"{bad_rows}/{stem}", **kw).good
        else:
            out[name] = read_table(spark, path, schema, fmt=fmt, **kw)
    return out


def bad_row_report(spark: SparkSession, bad_rows: str, names: Iterable[str]) -> DataFrame:
    """(table_name, reason, n_rows) of the bad lines that ``load_tables`` put aside, by the column at fault; sorted."""
    out = None
    for name in names:
        kept = spark.read.schema("reason string, bad boolean").parquet(f"{bad_rows}/{schemas.TABLES[name][0]}").where("bad")
        kind = F.regexp_replace("reason", ": .*$", "").alias("reason")
        part = kept.groupBy(kind).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "reason", "n_rows")
        out = part if out is None else out.unionByName(part)
    return out.orderBy("table_name", "reason")


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Iterable[str] | None = None,
    options: Mapping[str, str] | None = None,
) -> None:
    """Write a table once so later steps read it instead of recomputing it.

    CSV gets a header row and no index, as ``to_csv(index=False)`` writes.
    Partitioning the click log by course run lets later runs prune whole
    folders.
    """
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    opts = dict(options or {})
    if fmt == "csv":
        opts.setdefault("header", "true")
    for k, v in opts.items():
        w = w.option(k, v)
    w.format(fmt).save(path)
