"""Operator 2: pattern packing by non-negative least squares.

Documents are tokenised, cut into pieces of at most ``max_tokens`` and counted
by length.  The histogram (at most ``max_tokens`` numbers, whatever the corpus)
is all that the driver sees.  It enumerates patterns (lengths that share a
sequence) column by column: for every length a knapsack table says how full a
sequence can still become, and companions are drawn from those that lose at most
a given slack, more often where the fit so far falls short.  Repeat counts are
fitted to the histogram by non-negative least squares with a price on unused
tokens, rounded, and fitted again to what is left.  As much of a fit is taken as
leaves no more sequences than before; residual lengths are packed by best fit.
Tasks then place every piece by its rank among the pieces of its length.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tutorlens.llm.common import staged, texts

MAX_TOKENS = 1024
END_ID = 2
#: Gradient steps of a fit while patterns are added, and of the last one; the price of a sequence left empty.
STEPS, LAST_STEPS, WASTE_PRICE = 300, 1200, 1.0
#: Fits at most, each to what the one before left.
FITS = 12
#: How patterns are enumerated: (share of a sequence that may stay unused, chance to take the longest companion).
SWEEPS = ((0, 1), (0, 0.7), (0, 0.4), (0, 0.4), (0, 0.2), (0, 0.2), (0, 0), (0, 0), (0.01, 0.5), (0.03, 0.5), (0.1, 0.5), (0.3, 0.5))
#: Shares of a fit's patterns that are tried, until one costs no sequence.
SHARES = (1, 0.75, 0.5, 0.25, 0.1)
#: Runs of white space that are encoded by themselves: the library's pattern cannot go back over very long ones.
_LONG_SPACE = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]{10000,}")


def around_long_space(text: str, special: tuple[str, ...] = ()) -> list[str]:
    """The text, cut where its pattern cuts before and within very long runs of white space, which stand at odd places.

    The pattern takes a run as one piece but for its last character, which goes
    to what follows; at the end of a text, or before an added token, all of it.
    """
    parts, at = [], 0
    for m in _LONG_SPACE.finditer(text):
        whole = m.end() == len(text) or special and text.startswith(special, m.end())
        end = m.end() if whole else m.end() - 1
        parts += [text[at : m.start()], text[m.start() : end]]
        at = end
    return [*parts, text[at:]]


@lru_cache
def encoder(path: str):
    """text -> uint32 ids of the byte-level BPE file ``path``, added tokens recognised in the text.

    When the file's merges stand in the order of their ids (so that the lowest
    id is the first merge), the ids come from the same vocabulary as ranks,
    which is several times faster; any other file goes through ``tokenizers``.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, before, added = spec["model"], spec["pre_tokenizer"] or {}, spec["added_tokens"]
    plain = (
        model["type"] == "BPE"
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        and spec["normalizer"] is None
        and before.get("type") == "ByteLevel"
        and before.get("use_regex")
        and not before.get("add_prefix_space")
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or any(map(str.isspace, t["content"])) for t in added)
    )
    if plain:
        merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
        order = [model["vocab"][m] for m in merged]
        plain = all(a < b for a, b in zip(order, order[1:]))
    if plain:
        # the printable stand-ins of byte-level vocabularies
        kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
        stand_in = {chr(b): b for b in kept} | {chr(256 + k): b for k, b in enumerate(sorted({*range(256)} - {*kept}))}
        special = {t["content"]: t["id"] for t in added}
        ranks = {bytes(stand_in[c] for c in w): i for w, i in model["vocab"].items() if w not in special}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

        # for one piece of text, whatever it holds
        single = tiktoken.Encoding("piece", pat_str="(?s:.+)", mergeable_ranks=ranks, special_tokens={})

        def encode(text):
            parts = around_long_space(text, tuple(special))
            ids = [single.encode_to_numpy(x) if k % 2 else fast.encode_to_numpy(x, allowed_special="all") for k, x in enumerate(parts)]
            return ids[0] if len(ids) == 1 else np.concatenate(ids)

        return encode
    slow = Tokenizer.from_file(path)
    return lambda text: np.array(slow.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


def tokenised_pieces(docs: DataFrame, tokenizer: str, max_tokens: int = MAX_TOKENS, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, to rank pieces of a length, part and nth (in the part)."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]

    def run(batches):
        encode, part, seen = encoder(tokenizer), TaskContext.get().partitionId(), [0] * (max_tokens + 1)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encode(text.as_py()), np.uint32(end_id)).astype("<u4")
                start, piece, end = 0, 0, (len(ids) - 1) % max_tokens + 1
                while start < len(ids):
                    n = end - start
                    rows.append((doc_id, piece, start, n, zlib.crc32(ids[start:end].tobytes()), part, seen[n]))
                    seen[n] += 1
                    start, piece, end = end, piece + 1, end + max_tokens
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return texts(docs).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
    )


class Patterns:
    """Distinct patterns {length: repeats} that fill a sequence of ``size``, as the columns of a sparse matrix."""

    def __init__(self, size: int):
        self.size, self.number, self.items = size, {}, []

    def add(self, used: dict[int, int]) -> None:
        key = tuple(sorted(used.items(), reverse=True))
        if key not in self.number:
            self.number[key] = len(self.number)
            self.items += [(len(self.number) - 1, v, n) for v, n in key]

    def columns(self):
        """Pattern, length and repeats of each entry, and the unused tokens of each pattern."""
        pattern, length, repeats = np.array(self.items, dtype=np.int64).reshape(-1, 3).T
        unused = self.size - np.bincount(pattern, length * repeats, minlength=len(self.number))
        return pattern, length, repeats.astype(float), unused


def fullest(lengths: np.ndarray, size: int) -> np.ndarray:
    """For each number of free tokens, how many of them the lengths can fill (any number of times)."""
    exact = np.zeros(size + 1, dtype=bool)
    exact[0] = True
    for free in range(1, size + 1):
        exact[free] = exact[free - lengths[lengths <= free]].any()
    return np.maximum.accumulate(np.where(exact, np.arange(size + 1), 0))


def sweep(patterns: Patterns, left: np.ndarray, wanted: np.ndarray, full: np.ndarray, slack: int, longest: float, rng) -> None:
    """Add a pattern for each length that is left, with companions that together waste at most ``slack`` avoidable tokens.

    The longest such companion is taken with the chance ``longest``, else one
    drawn by ``wanted``, longer ones more often.
    """
    size, lengths = patterns.size, np.flatnonzero(left)
    weight = (wanted * (np.arange(size + 1) / size) ** 4)[lengths]
    for first in lengths.tolist():
        free, spare, used = size - first, slack, {first: 1}
        while full[free] and not (full[free] <= spare and rng.random() < 0.5):
            few = lengths[: np.searchsorted(lengths, free, side="right")]
            good = np.flatnonzero(few + full[free - few] >= full[free] - spare)
            if rng.random() < longest:
                at = good[-1]
            else:
                shares = weight[good].cumsum()
                at = good[min(len(good) - 1, np.searchsorted(shares, rng.random() * shares[-1], side="right"))]
            v = int(lengths[at])
            if used.get(v, 0) >= left[v]:
                break
            used[v] = used.get(v, 0) + 1
            spare -= int(full[free] - v - full[free - v])
            free -= v
        patterns.add(used)


def fit(columns, target: np.ndarray, start: np.ndarray, steps: int) -> np.ndarray:
    """Repeat counts x >= 0 that minimise the relative squares of A x - target and the price of unused tokens.

    Column p of A counts the lengths of pattern p.  Accelerated projected
    gradient; each pattern's step is bounded by the row sums of A'A.
    """
    pattern, length, repeats, unused = columns
    weight = np.where(target > 0, 1 / np.maximum(target, 1), 0.0)
    rows = np.bincount(length, repeats, minlength=len(target))
    bound = np.bincount(pattern, repeats * (weight * rows)[length], minlength=len(unused))
    price = WASTE_PRICE * unused / (len(target) - 1)
    x = y = np.concatenate([start, np.zeros(len(unused) - len(start))])
    t = 1.0
    for _ in range(steps):
        over = (np.bincount(length, repeats * y[pattern], minlength=len(target)) - target) * weight
        step = np.maximum(0.0, y - (np.bincount(pattern, repeats * over[length], minlength=len(unused)) + price) / bound)
        t, before = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        y, x = step + (before - 1) / t * (step - x), step
    return x


def fitted_patterns(left: np.ndarray, rng) -> tuple[list[tuple], np.ndarray, np.ndarray]:
    """Patterns enumerated for the counts ``left``, their fitted repeat counts, and their unused tokens."""
    size, target = len(left) - 1, left.astype(float)
    patterns, full = Patterns(size), fullest(np.flatnonzero(left), size)
    for lengths, _ in best_fit(counts_of(left), size):
        patterns.add(Counter(lengths))
    x, wanted = np.zeros(0), target
    for slack, longest in SWEEPS:
        sweep(patterns, left, wanted, full, int(slack * size), longest, rng)
        columns = patterns.columns()
        x = fit(columns, target, x, STEPS)
        reached = np.bincount(columns[1], columns[2] * x[columns[0]], minlength=size + 1)
        wanted = np.maximum(target - reached, 0.02 * target)
    return list(patterns.number), fit(columns, target, x, LAST_STEPS), columns[3]


def counts_of(left: np.ndarray) -> dict[int, int]:
    return {int(v): int(left[v]) for v in np.flatnonzero(left)}


def taken(patterns: list[tuple], wanted: np.ndarray, order: np.ndarray, left: np.ndarray):
    """The patterns of ``order``, as often as wanted and as pieces last, and the counts they leave."""
    left, got = left.copy(), []
    for p in order:
        n = min(int(wanted[p]), *(int(left[v]) // k for v, k in patterns[p]))
        if n > 0:
            got.append((tuple(v for v, k in patterns[p] for _ in range(k)), n))
            for v, k in patterns[p]:
                left[v] -= n * k
    return got, left


def number_of(packed) -> int:
    return sum(n for _, n in packed)


def pack_histogram(histogram: dict[int, int], size: int, seed: int = 1) -> tuple[list[tuple[tuple[int, ...], int]], int]:
    """(lengths of a sequence, how many such sequences), every counted piece in exactly one; and how many are fitted.

    The fitted ones stand first.  Never more sequences than best fit alone makes.
    """
    left, rng = np.zeros(size + 1, dtype=np.int64), np.random.default_rng(seed)
    for length, n in histogram.items():
        left[length] = n
    packed = [((size,), int(left[size]))] if left[size] else []
    left[size] = 0
    for _ in range(FITS if left.any() else 0):
        before, best = number_of(best_fit(counts_of(left), size)), None
        patterns, x, unused = fitted_patterns(left, rng)
        documents = np.array([sum(k for _, k in p) for p in patterns])
        for rounded, order in (
            (np.rint(x), np.argsort(-np.rint(x), kind="stable")),
            (np.floor(x), np.argsort(-x, kind="stable")),
            (np.rint(x), np.lexsort((-x, documents, unused))),
        ):
            order = order[rounded[order] > 0]
            for share in SHARES:
                got, rest = taken(patterns, rounded, order[: math.ceil(share * len(order))], left)
                cost = number_of(got) + number_of(best_fit(counts_of(rest), size))
                if got and (best is None or (cost, -number_of(got)) < best[:2]):
                    best = cost, -number_of(got), got, rest
                if cost <= before:
                    break
        if best is None or best[0] > before:
            break
        packed += best[2]
        left = best[3]
        if not left.any():
            break
    return packed + best_fit(counts_of(left), size), number_of(packed)


def best_fit(histogram: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing, with equal sequences handled together."""
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    done: list[tuple[tuple[int, ...], int]] = []

    def put(lengths, n, space):
        (open_.setdefault(space, []) if space else done).append((lengths, n))

    for length in sorted(histogram, reverse=True):
        n = histogram[length]
        while n:
            space = min((s for s in open_ if s >= length), default=None)
            if space is None:
                each = size // length
                if n >= each:
                    put((length,) * each, n // each, size - each * length)
                if n % each:
                    put((length,) * (n % each), 1, size - n % each * length)
                break
            lengths, many = open_[space].pop()
            k = min(many, n)
            if many > k:
                open_[space].append((lengths, many - k))
            if not open_[space]:
                del open_[space]
            put((*lengths, length), k, space - length)
            n -= k
    return done + [x for group in open_.values() for x in group]


def placements(packed: list[tuple[tuple[int, ...], int]]):
    """Sorted (length << 48 | first rank), first sequence and offset of each run of pieces."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for lengths, n in packed:
        offset = 0
        for v in lengths:
            rows.append((v << 48 | used.get(v, 0), sequence, offset))
            used[v] = used.get(v, 0) + n
            offset += v
        sequence += n
    return [np.array(c, dtype=np.int64) for c in zip(*sorted(rows))] if rows else [np.zeros(0, np.int64)] * 3


def ranked_pieces(docs: DataFrame, tokenizer: str, max_tokens: int, end_id: int) -> tuple[DataFrame, DataFrame]:
    """The staged pieces, and the same with their rank among all pieces of their length."""
    pieces = staged(tokenised_pieces(docs, tokenizer, max_tokens, end_id), "packing-pieces")
    # a row for each part and length: the ranks of a frequent length never meet in one task
    before = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")).selectExpr(
        "part", "length", "sum(n) OVER (PARTITION BY length ORDER BY part) - n AS before"
    )
    return pieces, pieces.join(before, ["part", "length"]).withColumn("rank", F.col("before") + F.col("nth"))


def pack(docs: DataFrame, tokenizer: str, max_tokens: int = MAX_TOKENS, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset, fitted: one row for each piece.

    A document is its ids and then ``end_id``; a null or empty text is the end id
    alone.  Longer documents are cut so that only the first piece is shorter than
    ``max_tokens``.  Rows repeat as they do in ``docs`` (a null doc_id stays
    null); an empty table gives no rows.  Which of several pieces of one length
    goes to which sequence is arbitrary.  fitted says that the sequence's pattern
    comes from the fit, not from the packing of what it left.
    """
    pieces, ranked = ranked_pieces(docs, tokenizer, max_tokens, end_id)
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    packed, fitted = pack_histogram(histogram, max_tokens)
    keys, sequences, offsets = placements(packed)

    def place(batches):
        for batch in batches:
            columns = [batch.column(k) for k in range(batch.num_columns - 1)]
            length = batch.column(3).to_numpy(zero_copy_only=False)
            rank = batch.column(5).to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, length << 48 | rank, side="right") - 1
            sequence = sequences[at] + rank - (keys[at] & ((1 << 48) - 1))
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(offsets[at]), pa.array(sequence < fitted)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "fitted"],
            )

    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, fitted boolean"
    )
