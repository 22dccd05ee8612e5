"""Operator 4: shards by extendible hashing.

The directory is indexed by the first bits of a 60-bit hash of the key.  A
bucket over the byte limit splits on its next bit, others stay as they are.  One
round looks ``ROUND_BITS`` bits ahead: byte counts by prefix (combined before
the shuffle) say where each bucket of the directory ends, and only rows whose
bucket is still too large go on to the next round.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tutorlens.llm.common import staged

HASH_BITS = 60
ROUND_BITS = 10


def _rest(live: DataFrame, limit_bytes: int) -> DataFrame:
    """Rows of equal hash that exceed the limit together: cut by running sums, each part within the limit.

    Sums run within a written partition and over the partitions, so that rows
    that share a key never meet in one task.
    """
    rows = staged(live.withColumns({"nth": F.monotonically_increasing_id(), "part": F.spark_partition_id()}), "shard-rest")
    parts = rows.groupBy("h", "part").agg(F.sum("bytes").alias("part_bytes"), F.max("bytes").alias("largest"))
    parts = parts.selectExpr(
        "h", "part",
        "sum(part_bytes) OVER (PARTITION BY h ORDER BY part) - part_bytes AS before",
        f"greatest({limit_bytes} - max(largest) OVER (PARTITION BY h), 1) AS room",
    )
    inner = rows.selectExpr("*", "sum(bytes) OVER (PARTITION BY h, part ORDER BY nth) - bytes AS start")
    cut = inner.join(parts, ["h", "part"]).withColumn("cut", F.expr("(before + start) div room"))
    sizes = cut.groupBy("h", "cut").agg(F.sum("bytes").alias("shard_bytes"), F.count(F.lit(1)).alias("shard_docs"))
    return cut.join(sizes, ["h", "cut"]).select(
        "doc_id", "bytes",
        F.expr(f"concat(lpad(bin(h), {HASH_BITS}, '0'), '.', cut)").alias("shard"),
        F.lit(HASH_BITS).alias("depth"), "shard_bytes", "shard_docs",
    )


def assign_shards(docs: DataFrame, limit_bytes: int, key: str = "doc_id") -> DataFrame:
    """doc_id, bytes, shard, depth, shard_bytes, shard_docs: one row for each row of ``docs``.

    shard is the hash prefix of the row's bucket as ``depth`` binary digits ('' for
    the whole table).  A bucket is final when its texts (null: empty) fit
    ``limit_bytes`` or when it holds one row, which may alone be larger.  Rows
    that share a key share a hash; where they exceed the limit together, ".0",
    ".1" and so on follow.  A null key hashes like an empty one.  An empty table
    gives no rows.
    """
    live = staged(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.octet_length(F.coalesce(F.col("text").cast("string"), F.lit(""))).cast("long").alias("bytes"),
            F.conv(F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long").alias("h"),
        ),
        "shard-rows",
    )
    done: list[DataFrame] = []
    for low in range(0, HASH_BITS, ROUND_BITS):
        high = low + ROUND_BITS
        rows = live.withColumn("cell", F.shiftrightunsigned("h", HASH_BITS - high))
        cells = rows.groupBy("cell").agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("docs"))
        ahead = cells.select("cell", "bytes", "docs", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth"))
        ahead = ahead.withColumn("prefix", F.expr(f"shiftright(cell, {high} - depth)"))
        buckets = ahead.groupBy("depth", "prefix").agg(F.sum("bytes").alias("shard_bytes"), F.sum("docs").alias("shard_docs"))
        final = buckets.where((F.col("shard_bytes") <= limit_bytes) | (F.col("shard_docs") == 1))
        leaf = F.min(F.struct("depth", "prefix", "shard_bytes", "shard_docs")).alias("leaf")
        directory = staged(ahead.select("cell", "depth", "prefix").join(final, ["depth", "prefix"]).groupBy("cell").agg(leaf), "shard-directory")
        placed = rows.join(directory, "cell")
        done.append(
            placed.select(
                "doc_id", "bytes",
                F.expr("lpad(bin(leaf.prefix), leaf.depth, '0')").alias("shard"),
                F.col("leaf.depth").alias("depth"), "leaf.shard_bytes", "leaf.shard_docs",
            )
        )
        live = staged(rows.join(directory, "cell", "left_anti").select("doc_id", "bytes", "h"), "shard-rows")
        if live.isEmpty():
            break
    else:
        done.append(_rest(live, limit_bytes))
    return reduce(DataFrame.unionAll, done)


def write_shards(docs: DataFrame, path: str, limit_bytes: int) -> None:
    """Write ``docs`` (doc_id unique) as one folder for each shard, each written by one task."""
    shards = assign_shards(docs, limit_bytes).select(F.col("doc_id").alias("_shard_doc"), F.col("shard").alias("_shard"))
    rows = docs.join(shards, F.col("doc_id").cast("long") == F.col("_shard_doc")).drop("_shard_doc")
    # an empty name (one shard) would be read back as null
    rows = rows.withColumn("_shard", F.concat(F.lit("s"), "_shard"))
    rows.repartition("_shard").sortWithinPartitions("_shard").write.partitionBy("_shard").parquet(path)
