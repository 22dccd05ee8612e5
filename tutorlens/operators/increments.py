"""Click totals that grow batch by batch (S3/C14), without rewriting what is there.

A batch of clicks becomes a partial: its sums by enrolment and day, written once
under the batch's id.  Totals are the partials added up when they are read, so
late and out-of-order batches need no care.  A batch id that is already there is
a replay and changes nothing.  ``compact`` adds the partials up into a new
generation and records whose sums it holds; partials of those are skipped, and
deleted afterwards, so an interruption at any point loses and doubles nothing.

Layout below ``store``: ``partials/batch_id=<id>``, ``generations/<n>/sums`` and,
written last, ``generations/<n>/batches``.  One writer at a time may compact.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tutorlens.functions.nulls import drop_null_keys, sum_or_zero
from tutorlens.keys import K3

SUMS = "code_module string, code_presentation string, id_student long, date int, sum_click long"


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _complete(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, f"{path}/_SUCCESS")
    return fs.exists(p)


def _names(spark: SparkSession, path: str) -> list[str]:
    p, fs = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _generation(spark: SparkSession, store: str) -> tuple[int, set[str]]:
    """The newest complete generation (0: none) and the batches whose sums it holds."""
    for n in sorted((int(x) for x in _names(spark, f"{store}/generations")), reverse=True):
        if _complete(spark, f"{store}/generations/{n}/batches"):
            # a name for each batch ever compacted
            found = spark.read.schema("batch_id string").parquet(f"{store}/generations/{n}/batches")
            return n, {r["batch_id"] for r in found.collect()}
    return 0, set()


def _open_batches(spark: SparkSession, store: str, held: set[str]) -> list[str]:
    """Complete partials that the generation does not hold."""
    found = [x.removeprefix("batch_id=") for x in _names(spark, f"{store}/partials")]
    return [b for b in found if b not in held and _complete(spark, f"{store}/partials/batch_id={b}")]


def batches(spark: SparkSession, store: str) -> list[str]:
    """The ids of all batches that count, in the order of their names."""
    _, held = _generation(spark, store)
    return sorted(held | set(_open_batches(spark, store, held)))


def daily_sums(clicks: DataFrame) -> DataFrame:
    """Clicks by enrolment and day (a missing day is one); rows without enrolment do not count."""
    return drop_null_keys(clicks, K3).groupBy(*K3, "date").agg(sum_or_zero("sum_click").alias("sum_click"))


def add_batch(clicks: DataFrame, store: str, batch_id: str) -> bool:
    """Write the partial of a batch of clicks; False, and nothing done, if the batch is there already.

    A partial that an interrupted run left incomplete is written anew.
    """
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch_id):
        raise ValueError(f"a batch id is made of letters, digits, '_', '.' and '-': {batch_id!r}")
    spark, path = clicks.sparkSession, f"{store}/partials/batch_id={batch_id}"
    if _complete(spark, path) or batch_id in _generation(spark, store)[1]:
        return False
    sums = daily_sums(clicks).selectExpr("code_module", "code_presentation", "CAST(id_student AS BIGINT) AS id_student", "CAST(date AS INT) AS date", "CAST(sum_click AS BIGINT) AS sum_click")
    sums.write.mode("overwrite").parquet(path)
    return True


def stored_sums(spark: SparkSession, store: str) -> DataFrame:
    """(K3, date, sum_click) of all batches: the newest generation and what came since, not yet added up."""
    n, held = _generation(spark, store)
    paths = [f"{store}/generations/{n}/sums"] if n else []
    paths += [f"{store}/partials/batch_id={b}" for b in _open_batches(spark, store, held)]
    return spark.read.schema(SUMS).parquet(*paths) if paths else spark.createDataFrame([], SUMS)


def click_totals(spark: SparkSession, store: str, cutoff: int | None = None) -> DataFrame:
    """(K3, total_clicks) over all batches, with ``cutoff`` of the days up to it."""
    sums = stored_sums(spark, store)
    if cutoff is not None:
        sums = sums.where(F.col("date") <= F.lit(cutoff))
    return sums.groupBy(*K3).agg(sum_or_zero("sum_click").alias("total_clicks"))


def compact(spark: SparkSession, store: str) -> int:
    """Add the open partials to a new generation, and delete them; returns its number (the old one if there are none)."""
    n, held = _generation(spark, store)
    new = _open_batches(spark, store, held)
    if not new:
        return n
    sums = stored_sums(spark, store).groupBy(*K3, "date").agg(sum_or_zero("sum_click").alias("sum_click"))
    target = f"{store}/generations/{n + 1}"
    sums.write.mode("overwrite").parquet(f"{target}/sums")
    names = spark.createDataFrame([(b,) for b in sorted(held | set(new))], "batch_id string")
    names.coalesce(1).write.mode("overwrite").parquet(f"{target}/batches")
    # from here on the generation counts; what it holds may go
    for done in [f"{store}/partials/batch_id={b}" for b in new] + ([f"{store}/generations/{n}"] if n else []):
        p, fs = _path(spark, done)
        fs.delete(p, True)
    return n + 1


def follow(spark: SparkSession, source: str, schema, store: str, checkpoint: str, fmt: str = "parquet"):
    """Add the files that have come to ``source`` since the last call, a batch for each micro-batch of the stream.

    The stream gives a micro-batch that it repeats after a failure its old
    number, so the repeated batch is a replay here.  Returns the query; it ends
    when all files that are there have been read.
    """
    def add(batch: DataFrame, number: int) -> None:
        add_batch(batch, store, f"stream-{number:012d}")

    stream = spark.readStream.schema(schema).format(fmt).load(source)
    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
