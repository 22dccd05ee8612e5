"""Session construction and lineage cutting.

On a cluster the session comes from the platform; :func:`configure` only adds the
SQL settings this library relies on (AQE, skew-join splitting, UTC) and never
overrides a checkpoint directory that the cluster already names.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set the SQL behaviour the library relies on; partition sizing stays the platform's."""
    for key, value in SQL_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tutorlens") -> SparkSession:
    """A local session for tests and the benchmark (UI off, no extra ports)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TUTORLENS_DRIVER_MEMORY", "8g"))
    )
    for key, value in SQL_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which driver and executors share.

    Only a ``local`` session that names none gets a scratch folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="tutorlens-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def materialize(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to shared storage and read it back.

    Cuts lineage (a lost executor re-reads the files), runs the upstream work
    once for several actions, and later reads prune columns.  Without ``path``
    a new folder below :func:`shared_folder` is used.
    """
    spark = df.sparkSession
    path = path or f"{shared_folder(spark)}/tutorlens/{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
