"""Operator 9: approximate nearest neighbours by stable projections and kd-trees.

Largest inner product becomes smallest distance by one more dimension, which
lifts all vectors to the same length.  A Gaussian (2-stable) projection to
``DIMENSIONS`` numbers keeps squared distances up to a chi-square factor.  The
projections are cut into cells by a kd-tree fitted on a bounded sample (cells that
come out too large are cut again, each by a sample of its own), and each cell has
its own kd-tree, built once.  A query takes projected neighbours box by box, nearest
box first, and verifies them with true inner products, until the chi-square test
says that a vector nearer than its k-th best would have been projected closer
than the next box with probability ``CONFIDENCE``.  The same test decides which
other cells a query still has to visit.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tutorlens.llm.common import staged

#: An even number of projected dimensions (the chi-square distribution then has a closed form).
DIMENSIONS = 8
CONFIDENCE = 0.97
#: Vectors of one cell, of the sample that cuts the cells, and of a box of a cell's own tree.
CELL_ROWS, SAMPLE_ROWS, BOX_ROWS = 16384, 32768, 64
#: Queries that search one copy of a cell.
QUERIES_AT_ONCE = 16384
#: Boxes that a query takes first; each further step takes twice as many, as far as the test allows.
BOXES_AT_ONCE = 16
#: Query and box pairs measured at once, and the relative slack of scores before their exact form.
PAIRS_AT_ONCE, SLACK = 1 << 22, 1e-9


def chi_square_limit(confidence: float = CONFIDENCE, dimensions: int = DIMENSIONS) -> float:
    """The value that a chi-square variable stays below with this probability."""

    def below(x):
        terms = (x / 2) ** np.arange(dimensions // 2) / [math.factorial(i) for i in range(dimensions // 2)]
        return 1 - math.exp(-x / 2) * terms.sum()

    low, high = 0.0, 200.0
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < confidence else (low, middle)
    return high


def kd_cells(points: np.ndarray, most: int) -> list[tuple[int, float]]:
    """Median cuts in heap order, (dimension, value); leaves hold at most ``most`` points.

    All leaves are at the same depth.  Each cut is along the widest dimension.
    """
    depth = max(0, math.ceil(math.log2(max(1, len(points)) / most)))
    cuts, groups = [], [points]
    for _ in range(depth):
        following = []
        for g in groups:
            d = int(np.argmax(np.ptp(g, axis=0))) if len(g) else 0
            value = float(np.median(g[:, d])) if len(g) else 0.0
            cuts.append((d, value))
            following += [g[g[:, d] <= value], g[g[:, d] > value]]
        groups = following
    return cuts


def cell_of(points: np.ndarray, cuts: list[tuple[int, float]]) -> np.ndarray:
    """The leaf of each point."""
    node = np.zeros(len(points), dtype=np.int64)
    if cuts:
        dims, values = np.array([d for d, _ in cuts]), np.array([v for _, v in cuts])
        for _ in range((len(cuts) + 1).bit_length() - 1):
            right = points[np.arange(len(points)), dims[node]] > values[node]
            node = 2 * node + 1 + right
        node -= len(cuts)
    return node


def boxes_apart(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of each point to each box."""
    out = np.zeros((len(points), len(low)))
    for d in range(points.shape[1]):
        p = points[:, d : d + 1]
        out += np.maximum(0, np.maximum(low[:, d] - p, p - high[:, d])) ** 2
    return out


class Projection:
    """The lifted vectors' projection; queries are scaled to the longest vector's length."""

    def __init__(self, size: int, longest: float, seed: int = 11):
        self.matrix, self.longest = np.random.default_rng(seed).normal(size=(size + 1, DIMENSIONS)), longest

    def of_vectors(self, x: np.ndarray) -> np.ndarray:
        lift = np.sqrt(np.maximum(0, self.longest**2 - (x * x).sum(axis=1)))
        return x @ self.matrix[:-1] + lift[:, None] * self.matrix[-1]

    def of_queries(self, q: np.ndarray) -> np.ndarray:
        return (q * (self.longest / np.linalg.norm(q, axis=1))[:, None]) @ self.matrix[:-1]

    def squared_distance(self, score: np.ndarray, norm: float) -> np.ndarray:
        """Between a lifted vector and a scaled query, from their inner product."""
        return 2 * self.longest**2 - 2 * score * (self.longest / norm)


def matrix_of(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, size)


def search_cell(x, projected, box, ids, q, q_projected, start, k, limit, projection):
    """For each query its number, and ids, scores and sameness of the k best of the cell's vectors.

    ``start`` is its k-th best score so far; ``box`` the leaf of each vector in
    the cell's tree; ids[i] are the smallest ids of the rows that hold vector i;
    sameness says that a vector equals the query.
    """
    order = np.argsort(box, kind="stable")
    x, projected, box, ids = x[order], projected[order], box[order], [ids[i] for i in order]
    starts = np.flatnonzero(np.r_[True, box[1:] != box[:-1]])
    ends = np.r_[starts[1:], len(box)]
    low, high = np.minimum.reduceat(projected, starts), np.maximum.reduceat(projected, starts)
    copies = np.array([len(i) for i in ids])
    far_boxes = boxes_apart(q_projected, low, high) if len(q) * len(low) <= PAIRS_AT_ONCE else None
    for n, (one, floor) in enumerate(zip(q, start)):
        apart = far_boxes[n] if far_boxes is not None else boxes_apart(q_projected[n : n + 1], low, high)[0]
        by_distance = np.argsort(apart, kind="stable")
        apart = apart[by_distance]
        first, last = starts[by_distance], ends[by_distance]
        norm = float(np.linalg.norm(one))
        rows, scores, kth = np.zeros(0, dtype=np.int64), np.zeros(0), floor
        lo, step = 0, BOXES_AT_ONCE
        while lo < len(apart):
            hi = min(lo + step, len(apart))
            if kth > -np.inf:
                # the stopping test: no box beyond this distance
                far = max(0.0, float(projection.squared_distance(kth, norm)))
                hi = min(hi, int(np.searchsorted(apart, limit * far, side="right")))
                if hi <= lo:
                    break
            got = np.concatenate([x[a:b] @ one for a, b in zip(first[lo:hi], last[lo:hi])])
            at = np.concatenate([np.arange(a, b) for a, b in zip(first[lo:hi], last[lo:hi])])
            # what may still be among the k best, with room for rounding; the exact scores decide
            near = got >= kth - SLACK * abs(kth) if kth > -np.inf else np.ones(len(got), dtype=bool)
            rows, scores = np.concatenate([rows, at[near]]), np.concatenate([scores, got[near]])
            order = np.argsort(-scores, kind="stable")
            held = np.cumsum(copies[rows[order]])  # each vector counts as often as rows hold it
            if len(held) and held[-1] >= k:
                kth = max(floor, float(scores[order[np.searchsorted(held, k)]]))
                order = order[scores[order] >= kth - SLACK * abs(kth)]
            rows, scores = rows[order], scores[order]
            lo, step = hi, 2 * step
        if len(rows):
            exact = (x[rows] * one).sum(axis=1)
            same = (x[rows] == one).all(axis=1)
            found = sorted((-s, i, e) for s, r, e in zip(exact.tolist(), rows, same.tolist()) for i in ids[r])[:k]
            yield n, [i for _, i, _ in found], [-s for s, _, _ in found], [e for _, _, e in found]


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, vec): the different rows that take part.

    Rows without vec_id, and vectors that are null, empty or zero, or hold null or
    non-finite components, do not; rows that repeat vec_id and vector are one.
    """
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec"))
    rows = rows.where(
        "vec_id IS NOT NULL AND vec IS NOT NULL AND size(vec) > 0 AND exists(vec, x -> coalesce(x, 0D) <> 0D) "
        "AND forall(vec, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
    )
    return rows.distinct()


def nearest(embeddings: DataFrame, queries, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found for each vector that ``queries`` (a condition) selects.

    Nearness is the inner product in double precision, ties to the smaller
    vec_id; a query is not its own neighbour, but its copies are.  Only vectors
    of one length have an inner product: each length is searched by itself.
    Equal vectors are searched and indexed once, whatever the number of their
    copies: only the k + 1 smallest ids of a vector can be among any k nearest.
    A vec_id with several vectors is a query, and a candidate, with each.  An
    empty table gives no rows.  See ``usable`` for the vectors that take part.
    """
    spark = embeddings.sparkSession
    rows = staged(usable(embeddings), "ann-rows")
    facts = rows.groupBy(F.size("vec").alias("size")).agg(F.max(F.expr("aggregate(vec, 0D, (a, x) -> a + x * x)")).alias("square"))
    out = None
    for r in facts.orderBy("size").collect():  # a row for each length of vector
        found = _nearest_of_size(rows.where(F.size("vec") == r["size"]), queries, k, Projection(r["size"], math.sqrt(r["square"])))
        out = found if out is None else out.unionAll(found)
    return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double") if out is None else out


_INDEX = "vec array<double>, ids array<long>, projected array<double>, cell long, sub int"


def _index(rows: DataFrame, most: int, projection: Projection) -> tuple[DataFrame, np.ndarray, np.ndarray, np.ndarray, bool]:
    """The index (vec, ids, projected, cell, sub, box), the cells with their boxes' corners, and whether any cell is cut again.

    The driver holds the cuts of at most SAMPLE_ROWS / 8 cells; those with more
    than twice ``CELL_ROWS`` vectors are cut into subs in Spark.
    """
    size = projection.matrix.shape[0] - 1
    nth = F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))
    few = rows.withColumn("nth", nth).where(F.col("nth") <= most)
    distinct = few.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))

    def project(batches):
        for batch in batches:
            found = projection.of_vectors(matrix_of(batch.column(0), size))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(found), pa.list_(pa.float64()))], ["vec", "ids", "projected"])

    index = staged(distinct.mapInArrow(project, "vec array<double>, ids array<long>, projected array<double>"), "ann-index")
    total = index.count()
    drawn = index.select("projected").orderBy(F.xxhash64("projected")).limit(SAMPLE_ROWS).collect()
    sample = np.array([r["projected"] for r in drawn])
    cuts = kd_cells(sample, max(8, int(CELL_ROWS * len(sample) / total)))

    def place(batches):
        for batch in batches:
            cell = cell_of(matrix_of(batch.column(2), DIMENSIONS), cuts)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], ["vec", "ids", "projected", "cell"])

    index = index.mapInArrow(place, "vec array<double>, ids array<long>, projected array<double>, cell long")
    index = staged(index, "ann-placed")
    edges = index.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *(f(F.col("projected")[d]).alias(f"{f.__name__}{d}") for d in range(DIMENSIONS) for f in (F.min, F.max)))
    corner = {r["cell"]: r for r in edges.collect()}
    cells = np.array(sorted(corner))
    low, high = (np.array([[corner[c][f"{f}{d}"] for d in range(DIMENSIONS)] for c in cells.tolist()]) for f in ("min", "max"))
    large = [(c, corner[c]["n"]) for c in cells.tolist() if corner[c]["n"] > 2 * CELL_ROWS]
    index = _cut_again(index, large) if large else index.withColumn("sub", F.lit(0))

    def tree(vectors: pa.Table) -> pa.Table:
        projected = matrix_of(vectors["projected"], DIMENSIONS)
        return vectors.append_column("box", pa.array(cell_of(projected, kd_cells(projected, BOX_ROWS)), pa.int64()))

    index = index.groupBy("cell", "sub").applyInArrow(tree, f"{_INDEX}, box long")
    return staged(index, "ann-cells"), cells, low, high, bool(large)


def _cut_again(index: DataFrame, large: list[tuple[int, int]]) -> DataFrame:
    """``index`` with ``sub``: the leaf of a vector in the cuts of its cell, 0 in cells that are not ``large`` (cell, vectors).

    Each large cell is cut by a sample of about SAMPLE_ROWS of its own vectors;
    its vectors meet the cuts in shares of bounded size.
    """
    spark = index.sparkSession
    sizes = spark.createDataFrame(large, "cell long, n long")  # at most SAMPLE_ROWS / 8 rows
    chance = (F.xxhash64("projected", F.lit(1)) % 1000003 + 1000003) % 1000003 / 1000003

    def cut(sample: pa.Table) -> pa.Table:
        n, points = sample["n"][0].as_py(), matrix_of(sample["projected"], DIMENSIONS)
        cuts = kd_cells(points, max(8, int(CELL_ROWS * len(points) / n)))
        return pa.table({"cell": sample["cell"][:1], "dims": pa.array([[d for d, _ in cuts]], pa.list_(pa.int32())), "edges": pa.array([[v for _, v in cuts]], pa.list_(pa.float64()))})

    within = index.join(F.broadcast(sizes), "cell")
    sample = within.where(chance * F.col("n") < SAMPLE_ROWS).select("cell", "n", "projected")
    cuts = staged(sample.groupBy("cell").applyInArrow(cut, "cell long, dims array<int>, edges array<double>"), "ann-cuts")
    shares = F.ceil(F.col("n") / (4 * CELL_ROWS)).cast("int")
    each = cuts.join(F.broadcast(sizes), "cell").withColumn("share", F.explode(F.sequence(F.lit(0), shares - 1))).drop("n")

    def place(vectors: pa.Table, cut: pa.Table) -> pa.Table:
        known = list(zip(cut["dims"][0].as_py(), cut["edges"][0].as_py())) if len(cut) else []
        sub = cell_of(matrix_of(vectors["projected"], DIMENSIONS), known)
        return vectors.select(["vec", "ids", "projected", "cell"]).append_column("sub", pa.array(sub, pa.int32()))

    dealt = within.withColumn("share", F.pmod(F.xxhash64("projected"), shares).cast("int")).drop("n")
    placed = dealt.groupBy("cell", "share").cogroup(each.groupBy("cell", "share")).applyInArrow(place, _INDEX)
    return index.join(F.broadcast(sizes), "cell", "left_anti").withColumn("sub", F.lit(0)).unionByName(placed)


def _nearest_of_size(rows: DataFrame, queries, k: int, projection: Projection) -> DataFrame:
    """The result of ``nearest`` for vectors of one length."""
    size, limit, most = projection.matrix.shape[0] - 1, chi_square_limit(), k + 1
    index, cells, low, high, cut_again = _index(rows, most, projection)
    asking = staged(rows.where(queries), "ann-asking")
    # one search for all copies of a query; its name holds the vector, as a vec_id may have several
    unique = asking.groupBy("vec").agg(F.min("vec_id").alias("first"))
    unique = staged(unique.select(F.concat_ws(":", "first", F.hex(F.xxhash64("vec"))).alias("qid"), "vec"), "ann-queries")

    def reach(q, kth):
        """Squared distance at which the stopping test holds, for queries with the k-th best scores ``kth``."""
        far = np.maximum(0, 2 * projection.longest**2 - 2 * kth * projection.longest / np.linalg.norm(q, axis=1))
        return limit * np.where(np.isneginf(kth), np.inf, far)

    def routes(visit_others: bool):
        """The cell that a query's projection is in or nearest to; or all others that pass the test, the first one again if it has subs."""

        def run(batches):
            for batch in batches:
                q = matrix_of(batch.column(1), size)
                apart = boxes_apart(projection.of_queries(q), low, high)
                home = apart.argmin(axis=1)
                kth = batch.column(2).to_numpy(zero_copy_only=False)
                if visit_others:
                    go = apart <= reach(q, kth)[:, None]
                    go[np.arange(len(q)), home] = cut_again
                    at, to = np.nonzero(go)
                else:
                    at, to = np.arange(len(q)), home
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cells[to]), *(batch.column(n).take(pa.array(at)) for n in (0, 1)), pa.array(kth[at]), pa.array(to == home[at])],
                    ["cell", "qid", "vec", "kth", "home"],
                )

        return run

    def sub_routes(visit_others: bool):
        """The same for the subs of a cell."""

        def run(asked: pa.Table, boxes: pa.Table) -> pa.Table:
            if not len(asked):
                return pa.table({c: pa.array([], t) for c, t in (("cell", pa.int64()), ("sub", pa.int32()), ("qid", pa.string()), ("vec", pa.list_(pa.float64())), ("kth", pa.float64()))})
            q, kth, home = matrix_of(asked["vec"], size), asked["kth"].to_numpy(), asked["home"].to_numpy()
            apart = boxes_apart(projection.of_queries(q), matrix_of(boxes["low"], DIMENSIONS), matrix_of(boxes["high"], DIMENSIONS))
            nearest_sub = apart.argmin(axis=1)
            if visit_others:
                go = apart <= reach(q, kth)[:, None]
                go[np.flatnonzero(home), nearest_sub[home]] = False
                at, to = np.nonzero(go)
            else:
                at, to = np.arange(len(q)), nearest_sub
            got = asked.select(["cell", "qid", "vec", "kth"]).take(pa.array(at))
            return got.add_column(1, "sub", boxes["sub"].take(pa.array(to))).combine_chunks()

        return run

    boxes = None
    if cut_again:
        ends = lambda f: F.array(*(f(F.col("projected")[d]) for d in range(DIMENSIONS)))
        boxes = staged(index.groupBy("cell", "sub").agg(ends(F.min).alias("low"), ends(F.max).alias("high")), "ann-boxes")

    def routed(asked: DataFrame, visit_others: bool) -> DataFrame:
        """cell, sub, qid, vec, kth."""
        out = asked.select("qid", "vec", "kth").mapInArrow(routes(visit_others), "cell long, qid string, vec array<double>, kth double, home boolean")
        if boxes is None:
            return out.select("cell", F.lit(0).alias("sub"), "qid", "vec", "kth")
        # queries meet the boxes of a cell in shares, each with a copy of those few boxes
        n = max(1, math.ceil(unique.count() / QUERIES_AT_ONCE))
        out = out.withColumn("share", F.pmod(F.xxhash64("qid", F.lit(2)), F.lit(n)).cast("int")).groupBy("cell", "share")
        each = boxes.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).groupBy("cell", "share")
        return out.cogroup(each).applyInArrow(sub_routes(visit_others), "cell long, sub int, qid string, vec array<double>, kth double")

    def search(vectors: pa.Table, asked: pa.Table) -> pa.Table:
        out = {"qid": [], "vec_id": [], "score": [], "same": []}
        if len(vectors) and len(asked):
            q, qids = matrix_of(asked["vec"], size), asked["qid"].to_pylist()
            found = search_cell(
                matrix_of(vectors["vec"], size), matrix_of(vectors["projected"], DIMENSIONS), vectors["box"].to_numpy(), vectors["ids"].to_pylist(),
                q, projection.of_queries(q), asked["kth"].to_numpy(), most, limit, projection,
            )
            for n, *columns in found:
                out["qid"] += [qids[n]] * len(columns[0])
                for name, column in zip(("vec_id", "score", "same"), columns):
                    out[name] += column
        kinds = {"qid": pa.string(), "vec_id": pa.int64(), "score": pa.float64(), "same": pa.bool_()}
        return pa.table({c: pa.array(out[c], kind) for c, kind in kinds.items()})

    def searched(asked: DataFrame, visit_others: bool) -> DataFrame:
        # a cell is copied as often as its own queries need, and not at all without any
        loads = routed(asked, visit_others).groupBy("cell", "sub").agg(F.ceil(F.count(F.lit(1)) / QUERIES_AT_ONCE).cast("int").alias("shares"))
        loads = staged(loads, "ann-loads")
        copies = index.join(loads, ["cell", "sub"]).withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))).drop("shares")
        dealt = routed(asked, visit_others).join(loads, ["cell", "sub"]).withColumn("share", F.pmod(F.xxhash64("qid"), "shares").cast("int")).drop("shares")
        keys = ["cell", "sub", "share"]
        return copies.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInArrow(search, "qid string, vec_id long, score double, same boolean")

    best = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
    first = staged(searched(unique.withColumn("kth", F.lit(float("-inf"))), False), "ann-home")
    ranked = first.withColumn("nth", F.row_number().over(best))
    kth = ranked.where(F.col("nth") == most).select("qid", F.col("score").alias("kth"))
    known = staged(unique.join(kth, "qid", "left").withColumn("kth", F.coalesce("kth", F.lit(float("-inf")))), "ann-known")
    both = first.unionAll(searched(known, True)).withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= most)
    named = asking.join(unique, "vec").select("qid", F.col("vec_id").alias("query_id"))
    # a query's own row is the one with its id and its vector
    pairs = named.join(both.select("qid", "vec_id", "score", "same"), "qid").where("NOT (vec_id = query_id AND same)")
    rank = F.row_number().over(Window.partitionBy("query_id", "qid").orderBy(F.desc("score"), "vec_id"))
    return pairs.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
