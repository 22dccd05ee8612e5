"""Feature tables stored bucketed by enrolment, so that repeated joins on K3 shuffle nothing.

Each table is written once with the same number of buckets of its key's hash, a
file for each.  A join on the key then reads bucket by bucket: both sides are
already laid out as the join wants them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tutorlens.functions.sqltext import ident


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str) -> DataFrame:
    """Store ``df`` under ``path`` as the table ``name``, in ``buckets`` buckets sorted by ``keys``; returns the stored table.

    Rows are dealt by the same hash first, so that a bucket is one file of one task.
    """
    if buckets < 1:
        raise ValueError(f"a table needs a bucket at least, not {buckets}")
    dealt = df.repartition(buckets, *[F.col(ident(k)) for k in keys])
    dealt.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def write_all_bucketed(tables: Mapping[str, DataFrame], prefix: str, keys: Sequence[str], buckets: int, folder: str) -> dict[str, DataFrame]:
    """``write_bucketed`` of several tables: ``<prefix>_<name>`` under ``<folder>/<name>``."""
    return {name: write_bucketed(df, f"{prefix}_{name}", keys, buckets, f"{folder}/{name}") for name, df in tables.items()}


def drop_bucketed(spark: SparkSession, prefix: str, names: Sequence[str]) -> None:
    """Forget the tables; their files stay."""
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {ident(f'{prefix}_{name}')}")
