"""Operator 7: byte-level BPE encoding and decoding in padded numpy matrices.

The distinct pre-tokens of a block of text are bucketed by length into padded
matrices of ids.  Every round each row merges its leftmost pair of minimum rank,
found by hashed lookup of all new pairs at once; the rows are compacted to the
left and finished rows leave the matrix.  A row wider than ``WIDE`` merges all
occurrences of that pair in one round where this makes no better pair, so that
its rounds do not grow with its length.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tutorlens.llm.common import texts

#: No pair: larger than any rank.
NONE = np.int32(2**31 - 1)
#: Rows up to this width merge one pair a round.
WIDE = 64
#: Cells of one matrix.
MATRIX_CELLS = 1 << 20
#: Matches of the pattern handled at once, and pre-tokens remembered between blocks.
MATCHES_AT_ONCE = 200_000
REMEMBERED = 300_000


class PairTable:
    """(left id, right id) -> id of the merged token, by open addressing."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = [
            (ranks[t[:k]], ranks[t[k:]], r)
            for t, r in ranks.items()
            for k in range(1, len(t))
            if t[:k] in ranks and t[k:] in ranks
        ]
        left, right, merged = (np.array(c, dtype=np.int64) for c in zip(*pairs))
        self.bits = max(4, int(len(pairs) * 4).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.full(1 << self.bits, NONE, dtype=np.int32)
        waiting, self.probes = (left << 32 | right, merged.astype(np.int32)), 0
        while len(waiting[0]):
            at = self._slot(waiting[0], self.probes)
            free = self.keys[at] == -1
            self.keys[at[free]], self.values[at[free]] = waiting[0][free], waiting[1][free]
            lost = self.keys[at] != waiting[0]
            # of several pairs written to one slot the last has won, values included
            self.values[at[~lost]] = waiting[1][~lost]
            waiting = (waiting[0][lost], waiting[1][lost])
            self.probes += 1

    def _slot(self, keys, probe):
        mixed = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)
        return (mixed.astype(np.int64) + probe) & ((1 << self.bits) - 1)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs; NONE for pairs that don't merge and where an id is -1."""
        keys = (left.astype(np.int64) << 32 | right.astype(np.int64)).ravel()
        keys[(left < 0).ravel() | (right < 0).ravel()] = -2
        at = self._slot(keys, 0)
        found = self.keys[at]
        out = np.where(found == keys, self.values[at], NONE)
        open_ = np.flatnonzero((found != keys) & (found != -1) & (keys != -2))
        for probe in range(1, self.probes):
            if not len(open_):
                break
            at = self._slot(keys[open_], probe)
            found = self.keys[at]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[at[hit]]
            open_ = open_[~hit & (found != -1)]
        return out.reshape(left.shape)


class MatrixBPE:
    """Encoder and decoder of one rank file."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.pairs = ranks, PairTable(ranks)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.token_bytes = {i: t for t, i in ranks.items()}

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(words)
        buckets: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            whole = self.ranks.get(w)
            if whole is not None:  # a pre-token that is a token stands for itself
                out[k] = whole.to_bytes(4, "little")
            elif w:
                buckets.setdefault((len(w) - 1).bit_length(), []).append(k)
        for bits, members in buckets.items():
            width = 1 << bits
            rows = max(1, MATRIX_CELLS // width)
            for lo in range(0, len(members), rows):
                part = members[lo : lo + rows]
                for k, ids in zip(part, self._merge([words[k] for k in part], width)):
                    out[k] = ids
        return out

    def _merge(self, words: list[bytes], width: int) -> list[bytes]:
        lengths = np.array([len(w) for w in words])
        ids = np.full((len(words), width), -1, dtype=np.int32)
        ids[np.arange(width) < lengths[:, None]] = self.byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)]
        ranks = np.full((len(words), width), NONE, dtype=np.int32)
        ranks[:, :-1] = self.pairs(ids[:, :-1], ids[:, 1:])
        done: list[bytes] = [b""] * len(words)
        live, cols = np.arange(len(words)), np.arange(width)
        while True:
            at = ranks.argmin(axis=1)  # the leftmost minimum
            best = ranks[np.arange(len(live)), at]
            finished = best == NONE
            if finished.any():
                size = (ids[finished] >= 0).sum(axis=1)
                for k, row, n in zip(live[finished], ids[finished].astype("<i4"), size):
                    done[k] = row[:n].tobytes()
                on = ~finished
                if not on.any():
                    return done
                live, ids, ranks, at, best = live[on], ids[on], ranks[on], at[on], best[on]
            row = np.arange(len(live))
            if width > WIDE:
                ids, ranks = self._merge_wide(ids, ranks, at, best)
                continue
            ids[row, at] = best
            shift = cols + (cols > at[:, None])  # compaction: what follows moves one to the left
            pad = np.full((len(live), 1), -1, dtype=np.int32)
            ids = np.take_along_axis(np.hstack([ids, pad]), shift, axis=1)
            ranks = np.take_along_axis(np.hstack([ranks, np.full_like(pad, NONE)]), shift, axis=1)
            after = np.where(at + 1 < width, ids[row, np.minimum(at + 1, width - 1)], -1)
            ranks[row, at] = self.pairs(best, after)
            inner = at > 0
            ranks[row[inner], at[inner] - 1] = self.pairs(ids[row[inner], at[inner] - 1], best[inner])

    def _merge_wide(self, ids, ranks, at, best):
        """Merge every occurrence of each row's best pair, from the left, without overlap.

        A row where that would make a pair of lower rank, at the end or on the
        way, merges its leftmost occurrence alone.
        """
        cols, row = np.arange(ids.shape[1]), np.arange(len(ids))
        hit = ranks == best[:, None]
        # of occurrences that overlap (a run of equal ids) every second one merges
        run_start = np.where(hit & ~np.pad(hit, ((0, 0), (1, 0)))[:, :-1], cols, -1)
        hit &= (cols - np.maximum.accumulate(run_start, axis=1)) % 2 == 0
        on_the_way = self.pairs(best, ids[row, at])
        merged, new = self._merged(ids, hit, best)
        alone = (new.min(axis=1) < best) | (on_the_way < best)
        if alone.any():
            only = hit & (cols == at[:, None])
            one, new_one = self._merged(ids[alone], only[alone], best[alone])
            width = max(merged.shape[1], one.shape[1])
            wider = lambda x, fill: np.pad(x, ((0, 0), (0, width - x.shape[1])), constant_values=fill)
            merged, new = wider(merged, -1), wider(new, NONE)
            merged[alone], new[alone] = wider(one, -1), wider(new_one, NONE)
        return merged, new

    def _merged(self, ids, hit, best):
        """Compacted ids and ranks after the pairs that start at ``hit`` became ``best``."""
        kept = ~np.pad(hit, ((0, 0), (1, 0)))[:, :-1] & (ids >= 0)
        size = kept.sum(axis=1)
        out = np.full((len(ids), max(1, int(size.max()))), -1, dtype=np.int32)
        out[np.arange(out.shape[1]) < size[:, None]] = np.where(hit, best[:, None], ids)[kept]
        ranks = np.full(out.shape, NONE, dtype=np.int32)
        ranks[:, :-1] = self.pairs(out[:, :-1], out[:, 1:])
        return out, ranks

    def decode(self, ids: bytes) -> bytes:
        """The bytes that the ids stand for."""
        return b"".join(map(self.token_bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache
def load(path: str) -> MatrixBPE:
    with open(path, "rb") as f:
        return MatrixBPE({base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())})


class Encoder:
    """Whole texts to ids; remembers pre-tokens between blocks, up to a bound."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.bpe, self.pattern, self.known = load(path), regex.compile(pattern), {}

    def blocks(self, texts_):
        """(number of the text, ids) pairs in order; a long text comes in several blocks."""
        held, n = [], 0
        for k, text in enumerate(texts_):
            matches = self.pattern.findall(text) if len(text) <= MATCHES_AT_ONCE else None
            if matches is not None:
                held.append((k, matches))
                n += len(matches)
            else:
                found = (m.group() for m in self.pattern.finditer(text))
                while matches := list(itertools.islice(found, MATCHES_AT_ONCE)):
                    yield from self._known([*held, (k, matches)])
                    held, n = [], 0
            if n >= MATCHES_AT_ONCE:
                yield from self._known(held)
                held, n = [], 0
        yield from self._known(held)

    def _known(self, held):
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = list(set().union(*(words for _, words in held)) - self.known.keys())
        self.known.update(zip(new, self.bpe.encode_words([w.encode("utf-8", "surrogatepass") for w in new])))
        for k, words in held:
            yield k, b"".join(map(self.known.__getitem__, words))


@lru_cache(maxsize=1)
def encoder(path: str, pattern: str) -> Encoder:
    """One for each Python worker, which serves many tasks."""
    return Encoder(path, pattern)


def round_trip(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: one row for each row of ``docs``.

    A null or empty text has no tokens and the digests of nothing.  Repeated
    rows repeat; an empty table gives no rows; extra columns are ignored.
    """

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches):
        own = encoder(ranks, pattern)
        for batch in batches:
            n = np.zeros(len(batch), dtype=np.int64)
            digests = [(hashlib.sha256(), hashlib.sha256()) for _ in range(len(batch))]
            for k, ids in own.blocks(t.as_py() for t in batch.column(1)):
                n[k] += len(ids) // 4
                digests[k][0].update(ids)
                digests[k][1].update(own.bpe.decode(ids))
            hexes = [[d[i].hexdigest() for d in digests] for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), *(pa.array(h, pa.string()) for h in hexes)], names)

    return texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encoded(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """(doc_id, ids): the ids themselves, for a training run."""

    def run(batches):
        own = encoder(ranks, pattern)
        for batch in batches:
            ids = [[] for _ in range(len(batch))]
            for k, block in own.blocks(t.as_py() for t in batch.column(1)):
                ids[k].append(block)
            ids = [np.frombuffer(b"".join(x), "<u4").astype(np.int32) for x in ids]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return texts(docs).mapInArrow(run, "doc_id long, ids array<int>")
