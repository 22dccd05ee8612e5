"""Operator 13: audit of how filters interact, over every order of applying them.

A document is its mask: which filters it fails.  Documents that share a part, a
mask and their labels are counted before anything is gathered, so a part is at
most 2^5 rows, whatever its size.  The removal step of a mask in an order is a
min-plus product: the mask matrix (0 where a filter fails, infinity where it
passes) combined with the inverse-permutation matrix (the place of each filter
in each order) by addition and minimum.  Steps then say where the counts are
scattered to, and which failures come too late to matter.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tutorlens.llm.common import staged

FILTERS = "ABCDE"
#: A: fewest words; B: least distinct words in a hundred; C: most capitals in a hundred characters; D: characters that may not stand.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, BANNED = 200, 50, 2, b"#$%&*|"
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
#: Stands for infinity in the min-plus product.
NEVER = 1 << 20
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def text_fails(text: bytes, characters: int) -> int:
    """Bits 0 to 3: whether a text fails A, B, C and D (words are split at ASCII white space)."""
    words = text.split()
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    return (
        (len(words) < LEAST_WORDS)
        | (100 * len(set(words)) < LEAST_DISTINCT * len(words)) << 1
        | (100 * capitals > MOST_CAPITALS * characters) << 2
        | (len(text.translate(None, BANNED)) < len(text)) << 3
    )


def text_masks(docs: DataFrame) -> DataFrame:
    """doc_id, part, digest (SHA-256 of the text), fails (bits of the filters that look at one text)."""

    def run(batches):
        for batch in batches:
            texts = batch.column(2)
            # characters of the whole text: its code points
            sizes = pc.utf8_length(texts).to_pylist()
            data = texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary())
            digests, fails = [], []
            for text, size in zip(data, sizes):
                text = text.as_py()
                digests.append(hashlib.sha256(text).digest())
                fails.append(text_fails(text, size))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(fails, pa.int32())], ["doc_id", "part", "digest", "fails"]
            )

    string = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), string("source").alias("part"), string("text").alias("text"))
    return rows.mapInArrow(run, "doc_id long, part string, digest binary, fails int")


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: documents of each part by the filters they fail, and how many of them are labelled.

    Rows of one digest may be a third of all: the smallest doc_id of each is
    combined before its shuffle, written, and joined as a plain exchange.
    """
    rows = staged(text_masks(docs), "audit-rows")
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first_id")
    first = staged(first, "audit-copies")
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic").where("doc_id IS NOT NULL")
    marks = staged(
        marks.groupBy("doc_id").agg(F.max(F.expr("quality <=> 1")).alias("good"), F.max(F.expr("toxic <=> 1")).alias("bad")).where("good OR bad"), "audit-labels"
    )
    both = rows.join(first, "digest", "left").join(marks, "doc_id", "left")
    # a text is a copy where a smaller doc_id has it
    mask = F.expr("fails + IF(coalesce(doc_id > first_id, false), 16, 0)")
    return both.groupBy("part", mask.alias("mask")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("good")).alias("good"), F.count_if(F.col("bad")).alias("toxic")
    )


def removal_steps(fails: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The step at which each mask is removed in each order, ``NEVER`` or more where it is not.

    ``fails`` (masks x filters) says which filters a mask fails; ``places``
    (orders x filters) at which step each order applies each filter.
    """
    return (np.where(fails, 0, NEVER)[:, None, :] + places[None, :, :]).min(axis=2)


def orders_of(filters: str) -> tuple[list[str], np.ndarray]:
    """All orders of the filters, and the step (from 1) of each filter in each: the inverse permutations."""
    orders = list(itertools.permutations(range(len(filters))))
    places = np.empty((len(orders), len(filters)), dtype=np.int64)
    for p, order in enumerate(orders):
        places[p, list(order)] = np.arange(1, len(filters) + 1)
    return ["".join(filters[f] for f in order) for order in orders], places


def audit_counts(mask: np.ndarray, n: np.ndarray, good: np.ndarray, toxic: np.ndarray, filters: str = FILTERS) -> dict[str, np.ndarray]:
    """The counts of one part (orders x steps), from its masks (bit f: fails filter f) and their weights."""
    names, places = orders_of(filters)
    fails = (mask[:, None] >> np.arange(len(filters))) & 1 == 1
    steps = removal_steps(fails, places)
    order = np.arange(len(names))
    removed_at = np.minimum(steps, len(filters) + 1)

    def scattered(weight):
        """Weights of the masks at the steps that remove them."""
        out = np.zeros((len(names), len(filters) + 2), dtype=np.int64)
        for k, w in enumerate(weight):
            np.add.at(out, (order, removed_at[k]), w)
        return out[:, 1:-1]

    removed = scattered(n)
    redundant = np.zeros_like(removed)
    unique, shapley = np.zeros_like(removed), np.zeros_like(removed)
    for f in range(len(filters)):
        at = places[:, f] - 1
        late = fails[:, f, None] & (steps < places[None, :, f])
        redundant[order, at] = (late * n[:, None]).sum(axis=0)
        unique[order, at] = n[fails[:, f] & (fails.sum(axis=1) == 1)].sum()
        shapley[order, at] = removed[order, at].sum()
    return {
        "kept": n.sum() - np.cumsum(removed, axis=1), "removed": removed, "redundant": redundant, "unique_fails": unique,
        "good_lost": scattered(good), "toxic_lost": scattered(toxic), "shapley": shapley,
    }


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, letter, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    One row for each part (source; null: empty string), order and step.  A null
    text is empty; a null doc_id has no label, and its text is a copy of none.
    Rows that repeat a doc_id count each; none is smaller than the other.  Of
    several labels of a doc_id, one that says so is enough.  An empty table has
    no parts and gives no rows; extra columns are not read.
    """

    def of_part(rows: pa.Table) -> pa.Table:
        counts = audit_counts(*(rows[c].to_numpy().astype(np.int64) for c in ("mask", "n", "good", "toxic")))
        names, _ = orders_of(FILTERS)
        size = len(FILTERS)
        columns = {
            "part": pa.array([rows["part"][0].as_py()] * (len(names) * size), pa.string()),
            "filter_order": pa.array([o for o in names for _ in range(size)]),
            "step": pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), len(names))),
            "letter": pa.array([f for o in names for f in o]),
        }
        return pa.table(columns | {c: pa.array(counts[c].ravel()) for c in COUNTS})

    schema = "part string, filter_order string, step int, letter string, " + ", ".join(f"{c} long" for c in COUNTS)
    return mask_counts(docs, labels).groupBy("part").applyInArrow(of_part, schema)
