"""Operator 6: SimHash near-dedup by anchor-point covering.

Fingerprints at most ``max_distance`` bits apart differ in at most
``max_distance // blocks`` bits within one of ``blocks`` blocks of the 64 bits.
In each block the codewords of a covering code are the anchors: a Hamming code
(every word is within one bit of a codeword) beside plain bits.  A fingerprint's
home is its nearest anchor; it is replicated to every anchor within covering
radius plus threshold, so that of each pair one stands at the other's home.
Pairs are compared anchor by anchor.
"""

from __future__ import annotations

import itertools
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tutorlens.llm.common import discard, keep_judged, staged, texts

SEED = 42
#: Shingles hashed at once (bounds the memory of a long text).
SHINGLES_AT_ONCE = 1 << 16
#: Most fingerprints on each side of one comparison cell; larger anchors are cut into a grid of cells.
CELL_ROWS = 1 << 15
#: Pairs compared at once.
PAIRS_AT_ONCE = 1 << 20


def fingerprint(text: str, width: int = 4) -> int:
    """SimHash over word shingles: a bit is 1 if set in over half the shingle hashes."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and ASCII white space only
    if not words:
        return 0
    if len(words) < width:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    ones, n = np.zeros(64, dtype=np.int64), len(words) - width + 1
    for lo in range(0, n, SHINGLES_AT_ONCE):
        part = words[lo : lo + SHINGLES_AT_ONCE + width - 1]
        shingles = map(b" ".join, zip(*(part[k:] for k in range(width))))
        hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = 4) -> DataFrame:
    """(doc_id, fp, sha): the fingerprint of every row as a signed long, and the SHA-256 of its text."""

    def run(batches):
        for batch in batches:
            # one text at a time: whole batches as Python strings would double the memory
            found = np.fromiter((fingerprint(t.as_py(), width) for t in batch.column(1)), dtype=np.uint64, count=len(batch))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64)), batch.column(2)], ["doc_id", "fp", "sha"])

    return texts(docs).withColumn("sha", F.unhex(F.sha2("text", 256))).mapInArrow(run, "doc_id long, fp long, sha binary")


@lru_cache
def block_code(low: int, bits: int, threshold: int):
    """(shift, mask, check, moves) of the covering code on ``bits`` bits from bit ``low``.

    The first 2^m - 1 bits carry a Hamming code (covering radius 1), the rest
    stand for themselves.  ``check[i]`` is the column of bit i in the parity
    check; ``moves[s]`` are the bit patterns that lead from a word with syndrome
    s to every anchor within radius + threshold, the nearest first.
    """
    m = (bits + 1).bit_length() - 1
    coded = (1 << m) - 1
    check = [i + 1 if i < coded else 0 for i in range(bits)]
    moves: list[list[int]] = [[] for _ in range(1 << m)]
    for weight in range(1 + threshold + 1):
        for places in itertools.combinations(range(bits), weight):
            syndrome = pattern = 0
            for i in places:
                syndrome ^= check[i]
                pattern |= 1 << i
            moves[syndrome].append(pattern)
    return low, (1 << bits) - 1, check, [np.array(x, dtype=np.uint64) for x in moves]


def codes(max_distance: int, blocks: int):
    cuts = [64 * k // blocks for k in range(blocks + 1)]
    return [block_code(lo, hi - lo, max_distance // blocks) for lo, hi in zip(cuts, cuts[1:])]


def anchored(fps: np.ndarray, max_distance: int, blocks: int):
    """(anchor, fp, home) arrays: every fingerprint at each of its anchors."""
    out = []
    for k, (low, mask, check, moves) in enumerate(codes(max_distance, blocks)):
        words = (fps >> np.uint64(low)) & np.uint64(mask)
        syndrome = np.zeros(len(fps), dtype=np.uint64)
        for i, column in enumerate(check):
            if column:
                syndrome ^= ((words >> np.uint64(i)) & np.uint64(1)) * np.uint64(column)
        for s, patterns in enumerate(moves):
            at = np.flatnonzero(syndrome == s)
            anchors = (words[at, None] ^ patterns) | np.uint64(k << 56)
            home = np.zeros(anchors.shape, dtype=bool)
            home[:, 0] = True
            out.append((anchors.ravel(), np.repeat(fps[at], len(patterns)), home.ravel()))
    return [np.concatenate(x) for x in zip(*out)]


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (u, v) as stars: each linked fingerprint but the smallest, and that smallest."""
    nodes, both = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = both[: len(u)], both[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        # a label that meets a smaller one follows it, then paths are halved
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while not np.array_equal(step := new[new], new):
            new = step
        if np.array_equal(new, label):
            break
        label = new
    far = label != np.arange(len(nodes))
    return nodes[far], nodes[label[far]]


def _links(cell: np.ndarray, fps: np.ndarray, home: np.ndarray, max_distance: int):
    """Stars of the links in whole cells; rows of a cell stand together."""
    starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    sizes = np.diff(np.r_[starts, len(cell)])
    of_row = np.repeat(np.arange(len(starts)), sizes)
    homes = np.flatnonzero(home)
    width = sizes[of_row[homes]]  # each home row meets every row of its cell
    ends = np.cumsum(width)
    lo = 0
    while lo < len(homes):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + PAIRS_AT_ONCE, side="right")))
        n = width[lo:hi]
        left = np.repeat(homes[lo:hi], n)
        right = np.repeat(starts[of_row[homes[lo:hi]]] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        x, y = fps[left], fps[right]
        near = (np.bitwise_count(x ^ y) <= max_distance) & (x != y)
        if near.any():
            yield forest(x[near], y[near])
        lo = hi


def stars(fps: DataFrame, max_distance: int = 4, blocks: int = 3) -> DataFrame:
    """(u, v): stars that connect exactly the distinct fingerprints ``fp`` within ``max_distance``."""

    def place(batches):
        for batch in batches:
            anchors, members, home = anchored(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), max_distance, blocks)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchors.view(np.int64)), pa.array(members.view(np.int64)), pa.array(home)], ["anchor", "fp", "home"]
            )

    def compare(batches):
        held = None
        for table in itertools.chain((pa.Table.from_batches([b]) for b in batches), [None]):
            if table is not None:
                now = [table[c].to_numpy() for c in ("cell", "fp", "home")]
                now[1] = now[1].view(np.uint64)
                held = now if held is None else [np.concatenate(x) for x in zip(held, now)]
            if held is None or not len(held[0]):
                continue
            # the last cell may go on in the next batch
            cut = len(held[0]) if table is None else int(np.searchsorted(held[0], held[0][-1]))
            ready, held = [x[:cut] for x in held], [x[cut:] for x in held]
            if cut:
                for u, v in _links(*ready, max_distance):
                    yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    # each fingerprint becomes some forty rows: spread them first
    spread = fps.select("fp").repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    members = spread.mapInArrow(place, "anchor long, fp long, home boolean")
    # Anchors are codewords: their number is fixed by the code, whatever the input.
    load = members.groupBy("anchor").agg(F.count_if("home").alias("homes"), F.count(F.lit(1)).alias("members"))
    grid = staged(
        load.where(F.col("members") > CELL_ROWS).select(
            "anchor",
            F.ceil(F.col("homes") / CELL_ROWS).cast("int").alias("rows"),
            F.ceil(F.col("members") / CELL_ROWS).cast("int").alias("cols"),
        ),
        "simhash-grid",
    )
    # A crowded anchor is cut into rows x cols cells: a home row goes to its row
    # of cells, a member to its column; every pair still meets in one cell.
    cut = members.join(grid, "anchor", "left")
    cut = cut.select(
        "fp",
        F.explode(
            F.expr("""CASE
              WHEN rows IS NULL THEN array(named_struct('cell', anchor, 'home', home))
              WHEN rows = 0 THEN array()
              ELSE concat(
                transform(sequence(0, rows - 1),
                          r -> named_struct('cell', xxhash64(anchor, r, pmod(xxhash64(fp), cols)), 'home', false)),
                IF(home, transform(sequence(0, cols - 1),
                                   c -> named_struct('cell', xxhash64(anchor, pmod(xxhash64(fp, 1), rows), c), 'home', true)),
                   array()))
            END""")
        ).alias("at"),
    ).select("at.cell", "fp", "at.home")
    return cut.repartition("cell").sortWithinPartitions("cell").mapInArrow(compare, "u long, v long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, root): the smallest node reachable from every linked node but that smallest.

    Alternating large-star and small-star steps; both only take minima, which
    combine before the shuffle, so a hub costs its task one row a partition.
    """
    now = staged(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "links")
    mark = None
    while True:
        # The minima are written before they are joined: both sides of a join are
        # then plain exchanges, of which the rows of a hub can be split.
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "links-low")
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.where("u <> v").distinct(), "links-large")
        least = staged(large.groupBy("u").agg(F.min("v").alias("m")), "links-least")
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
        after = staged(small.select("e.u", F.col("e.m").alias("v")).where("u <> v").distinct(), "links")
        for done in (now, low, large, least):
            discard(done)
        now = after
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            return now.select("u", F.col("v").alias("root"))
        mark = seen


def grouped(rows: DataFrame, max_distance: int, blocks: int) -> DataFrame:
    """fp, root, component_id of each different fingerprint of ``rows`` (doc_id, fp): its component, and the smallest doc_id there."""
    distinct = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    root = components(stars(distinct, max_distance, blocks))
    of_root = distinct.join(root.withColumnRenamed("u", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    smallest = staged(of_root.groupBy("root").agg(F.min("first_id").alias("component_id")), "simhash-roots")
    return staged(of_root.join(smallest, "root").select("fp", "root", "component_id"), "simhash-components")


def near_dedup(docs: DataFrame, width: int = 4, max_distance: int = 4, blocks: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: one row for each row of ``docs``.

    Words are split at ASCII white space after lower-casing A-Z; a text with
    fewer words than ``width`` is one shingle; a null or wordless text has
    fingerprint zero, linked like any other.  component_id is the smallest
    non-null doc_id reachable through links of at most ``max_distance`` bits; a
    component without any doc_id has null.  Rows that repeat a doc_id keep their
    own rows; an empty table gives none.  More ``blocks`` mean fewer replicas
    and larger cells, fewer blocks the reverse.
    """
    rows = staged(fingerprints(docs, width), "simhash-rows")
    named = grouped(rows, max_distance, blocks)
    return rows.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_representatives(docs: DataFrame, width: int = 4, max_distance: int = 4, blocks: int = 3) -> DataFrame:
    """One row of ``docs``, with all its columns, for each component.

    The first by doc_id (rows without one last), fingerprint and digest of the
    text stays; of rows that repeat its doc_id and text, one.  So a component
    keeps a row whatever its doc_ids are called elsewhere, and copies without
    doc_id go like others.
    """
    rows = staged(fingerprints(docs, width), "simhash-rows")
    roots = grouped(rows, max_distance, blocks).select("fp", "root")
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "fp", "sha")
    placed = staged(rows.join(roots, "fp").select("root", "doc_id", "sha", place.alias("place")), "simhash-placed")
    first = placed.groupBy("root").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("of_root")).where("of_root > 1")
    first = staged(first.drop("of_root"), "simhash-first")
    judged = placed.join(first, "root").groupBy("doc_id", "sha").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("place") == F.col("first")).alias("stays"))

    def of_row(row):
        text = F.coalesce(row["text"].cast("string"), F.lit(""))
        return {"doc_id": row["doc_id"].cast("long"), "sha": F.unhex(F.sha2(text, 256))}

    return keep_judged(docs, of_row, staged(judged, "simhash-judged"))
