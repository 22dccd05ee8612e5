"""Operator 1: exact dedup with counting quotient filters.

Every partition builds counting quotient filters of its documents' fingerprints,
cut into blocks by the first bits of the quotient.  The blocks of all partitions
merge losslessly by sorted remainders, in a tree of fixed fan-out that splits the
blocks further at each level.  A
fingerprint whose merged count is one belongs to a unique text; the others are
routed to byte verification, which groups the whole normalised texts.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tutorlens.llm.common import keep_judged, staged
from tutorlens.llm.quotient_filter import CountingQuotientFilter

#: Fingerprints of one filter before it is sent on (8 MB).
FILTER_ROWS = 1 << 20
#: Expected fingerprints in a merged block, and the bits that one level of the merge splits at most.
BLOCK_ROWS, FAN_BITS = 1 << 18, 6


def normalised(text: Column) -> Column:
    """Each run of white space as one space (a single space already is one)."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


def _segments(distinct: np.ndarray, counts: np.ndarray, width: int, bits: int):
    """Fingerprints of ``width`` bits as one filter for each value of their first ``bits`` bits."""
    rest = width - bits
    blocks = (distinct >> np.uint64(rest)).astype(np.int64) if bits else np.zeros(len(distinct), np.int64)
    within = distinct & ((np.uint64(1) << np.uint64(rest)) - np.uint64(1)) if bits else distinct
    cuts = np.flatnonzero(np.diff(blocks)) + 1
    for lo, hi in zip([0, *cuts], [*cuts, len(blocks)]):
        if hi > lo:
            part = CountingQuotientFilter.of_sorted(within[lo:hi], counts[lo:hi], rest)
            yield int(blocks[lo]), part.quotient_bits, *part.pack()


_PIECE = ["block", "part", "quotient_bits", "occupied", "run_end", "remainders", "counts"]
_PIECE_SCHEMA = "block long, part long, quotient_bits int, occupied binary, run_end binary, remainders binary, counts binary"


def _pieces(rows: list[tuple]) -> pa.Table:
    kinds = [pa.int64(), pa.int64(), pa.int32(), *[pa.binary()] * 4]
    columns = zip(*rows) if rows else [[]] * len(kinds)
    return pa.table([pa.array(column, kind) for column, kind in zip(columns, kinds)], names=_PIECE)


def levels_of(block_bits: int) -> list[int]:
    """How many bits each level of the merge splits, ``FAN_BITS`` at most."""
    n = max(1, math.ceil(block_bits / FAN_BITS))
    return [block_bits // n + (k < block_bits % n) for k in range(n)]


def fingerprint_counts(fingerprints: DataFrame, block_bits: int) -> DataFrame:
    """(fingerprint, n) of every fingerprint whose merged count is over one.

    The filters merge in a tree.  A filter is cut into at most 2^FAN_BITS blocks;
    a level merges about as many filters of one block as that, and cuts what it
    merged again, until a block of 2^block_bits has all its filters.  A piece
    thus never gets much smaller than ``FILTER_ROWS`` divided by the fan, and
    the number of pieces at a level is in proportion to the rows.
    """
    levels = levels_of(block_bits)

    def build(batches):
        held, n, flushed = [], 0, 0
        task = TaskContext.get().partitionId()

        def flush():
            distinct, counts = np.unique(np.concatenate(held).view(np.uint64), return_counts=True)
            # filters of a task are spread over the parts of the next level
            rows = [(block, task + flushed * 8191, *piece) for block, *piece in _segments(distinct, counts, 64, levels[0])]
            return _pieces(rows).combine_chunks().to_batches()[0]

        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64))
            n += len(batch)
            if n >= FILTER_ROWS:
                yield flush()
                held, n, flushed = [], 0, flushed + 1
        if n:
            yield flush()

    def merged(table: pa.Table, width: int) -> CountingQuotientFilter:
        parts = [CountingQuotientFilter.unpack(*(row[c] for c in _PIECE[2:])) for row in table.select(_PIECE[2:]).to_pylist()]
        return CountingQuotientFilter.merge(parts, width)

    def split(width: int, bits: int):
        """Merge the filters of a block and a part, and cut the result into blocks of the next level."""

        def run(table: pa.Table) -> pa.Table:
            whole, block, part = merged(table, width), table["block"][0].as_py(), table["part"][0].as_py()
            return _pieces([(block << bits | b, part, *piece) for b, *piece in _segments(whole.fingerprints(width), whole.counts, width, bits)])

        return run

    def last(width: int):
        def run(table: pa.Table) -> pa.Table:
            whole = merged(table, width)
            again = whole.counts > 1
            got = whole.fingerprints(width)[again]
            if width < 64:
                got = got | (np.uint64(table["block"][0].as_py()) << np.uint64(width))
            return pa.table({"fingerprint": got.view(np.int64), "n": whole.counts[again]})

        return run

    pieces, width, parts = fingerprints.select("fingerprint").mapInArrow(build, _PIECE_SCHEMA), 64 - levels[0], 2**block_bits
    for bits in levels[1:]:
        parts = max(1, parts >> FAN_BITS)
        groups = pieces.withColumn("part", F.pmod("part", F.lit(parts))).groupBy("block", "part")
        pieces, width = groups.applyInArrow(split(width, bits), _PIECE_SCHEMA), width - bits
    return pieces.groupBy("block").applyInArrow(last(width), "fingerprint long, n long")


def copy_groups(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, groups): a narrow row for each document, and the groups of equal texts.

    rows: doc_id, fingerprint, sha.  groups: fingerprint, sha, keep_id,
    group_size for every text whose fingerprint occurs more than once.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised(F.col("text")).alias("norm"))
    keyed = keyed.withColumn("fingerprint", F.xxhash64("norm"))
    rows = staged(keyed.select("doc_id", "fingerprint", F.unhex(F.sha2("norm", 256)).alias("sha")), "dedup-rows")
    blocks = max(1, math.ceil(rows.count() / BLOCK_ROWS))
    # 4 blocks at least, so that merging always runs in parallel
    block_bits = max(2, math.ceil(math.log2(blocks)))
    suspects = staged(fingerprint_counts(rows, block_bits).select("fingerprint"), "dedup-suspects")
    # Byte verification: the texts themselves, and nothing else, are the grouping
    # key.  So a join by fingerprint, where the suspects are too many to broadcast,
    # never serves as the grouping: its partitions may be split where a text has a
    # third of all rows, and rows are combined in each part before they are shuffled.
    groups = (
        keyed.join(suspects, "fingerprint", "left_semi")
        .groupBy("norm")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select(F.xxhash64("norm").alias("fingerprint"), F.unhex(F.sha2("norm", 256)).alias("sha"), "keep_id", "group_size")
    )
    return rows, staged(groups, "dedup-groups")


def exact_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row for each row of ``docs``.

    Texts are equal when identical after each white-space run became one space
    (not trimmed); null counts as empty.  The smallest non-null doc_id of a group
    stays.  Rows that repeat doc_id and text are the same document and share
    ``kept``; a group whose doc_ids are all null keeps null.  An empty table
    gives no rows; extra columns are ignored.
    """
    rows, groups = copy_groups(docs)
    return rows.join(groups, ["fingerprint", "sha"], "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("group_size").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, each document once.

    What goes is decided on narrow rows; the texts are joined with it by their
    own keys, which no hot group shares, in one shuffle whatever the size.
    """
    found, groups = copy_groups(docs)
    key = ["doc_id", "fingerprint", "sha"]
    judged = found.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).join(groups, ["fingerprint", "sha"])
    judged = staged(judged.select(*key, "n", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("stays")), "dedup-judged")

    def of_row(row):
        norm = normalised(row["text"])
        return {"doc_id": row["doc_id"].cast("long"), "fingerprint": F.xxhash64(norm), "sha": F.unhex(F.sha2(norm, 256))}

    return keep_judged(docs, of_row, judged)
