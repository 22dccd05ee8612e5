"""Operator 3: toxic spans by a linear-chain conditional random field.

Documents are labelled, tokens are not: a token of a toxic training document is
labelled toxic when one of its features (the word, its first or last letters)
is much more frequent in toxic documents than in clean ones, by a likelihood-ratio
test against the class prior.  A two-state chain over the tokens of each line is trained on these labels.  Forward-backward marginals then give the
offending spans, and their aggregates, calibrated on the document labels, the
document's score.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tutorlens.llm.common import keep_rows, labelled_sample, score_table

#: Bounds of the training sample, which the driver holds.
SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_CHARS = 1500, 2500, 12_000_000
#: Hashed features.
BUCKETS = 1 << 18
#: Steps of the gradient ascent, and the ridge penalty of its likelihood.
STEPS, RIDGE = 25, 1e-6
#: Share of a labelling feature's tokens in toxic documents that its rate in clean ones does not explain; and the share
#: of the labelling features that may pass the likelihood-ratio test by chance.
PURITY, BY_CHANCE = 0.9, 0.01
#: Letters of the prefixes and suffixes that are features.
PREFIXES, SUFFIXES = (3, 4, 5, 6, 7, 8), (4, 6)
#: One in so many documents of the sample is kept from the chain's training to calibrate the scores.
CALIBRATION = 3
#: Characters scored at once, and tokens remembered between.
CHARS_AT_ONCE, REMEMBERED = 2_000_000, 400_000
THRESHOLD = 0.7
#: Tokens of a line that are passed one by one; longer lines go on in further blocks beside them.
BLOCK = 512
_TOKEN = re.compile(r"\S+")
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")


def token_features(token: str) -> tuple[int, ...]:
    """Hashed features of a token: the word without marks at its edges, its first and its last letters."""
    word = _EDGES.sub("", token.lower())
    whole = word.encode("utf-8", "surrogatepass")
    if len(whole) == len(word):
        parts = [(whole[:k], 10 + k) for k in PREFIXES] + [(whole[-k:], 90 + k) for k in SUFFIXES]
    else:  # letters of several bytes
        parts = [(word[:k].encode("utf-8", "surrogatepass"), 10 + k) for k in PREFIXES]
        parts += [(word[-k:].encode("utf-8", "surrogatepass"), 90 + k) for k in SUFFIXES]
    return (zlib.crc32(whole, 1) % BUCKETS, *(zlib.crc32(part, seed) % BUCKETS for part, seed in parts))


def marking(n: np.ndarray, docs: np.ndarray, total: np.ndarray, rate: float) -> np.ndarray:
    """Whether each feature labels the tokens of toxic documents that have it.

    ``n`` and ``docs`` count the tokens and documents with a feature (row 0 clean,
    row 1 toxic), ``total`` all tokens of each class; ``rate`` is the share of
    documents with a feature without meaning that are toxic.  The likelihood-ratio
    statistic bounds the chance of so many toxic ones; Benjamini and Hochberg's
    step-up rule allows for the number of features.
    """
    seen = docs.sum(axis=0)
    with np.errstate(divide="ignore", invalid="ignore"):
        q = docs[1] / seen
        fit = np.where(q > 0, q * np.log(q / rate), 0) + np.where(q < 1, (1 - q) * np.log((1 - q) / (1 - rate)), 0)
    log_chance = np.where((seen > 0) & (q > rate), -seen * fit, 0.0)
    tested = np.sort(log_chance[seen > 0])
    passed = np.flatnonzero(tested <= np.log(BY_CHANCE * np.arange(1, len(tested) + 1) / max(1, len(tested))))
    bound = tested[passed[-1]] if len(passed) else -np.inf
    clean = (n[0] + 0.5) / (total[0] + 1)
    return (log_chance <= bound) & (clean <= (1 - PURITY) * n[1] / max(1, total[1]))


@dataclass
class Lines:
    """Tokens of several texts: ``tokens`` in order, ``start`` and ``size`` of each line, ``doc`` of each line."""

    tokens: list = field(default_factory=list)
    start: list = field(default_factory=list)
    size: list = field(default_factory=list)
    doc: list = field(default_factory=list)

    def add(self, doc: int, text: str, own=None) -> None:
        """``own`` gives the one string to keep of equal tokens."""
        for line in text.split("\n"):
            words = line.split()
            if own is not None:
                words = [own.setdefault(w, w) for w in words]
            self.start.append(len(self.tokens))
            self.size.append(len(words))
            self.doc.append(doc)
            self.tokens += words


class Chain:
    """Marginals of a two-state chain; state 0 scores zero, state 1 the token's score.

    Lines are cut into blocks of ``BLOCK`` tokens at most.  All blocks go on side
    by side; from block to block of a line the messages pass through the product
    of the block's transfer matrices, so that the number of steps does not grow
    with the longest line.
    """

    def __init__(self, start, size):
        start, size = np.asarray(start, dtype=np.int64), np.asarray(size, dtype=np.int64)
        start, size = start[size > 0], size[size > 0]
        self.line_ends = start + size - 1
        blocks = -(-size // BLOCK)
        of_line = np.repeat(np.arange(len(size)), blocks)
        nth = np.arange(len(of_line)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        first = start[of_line] + nth * BLOCK
        length = np.minimum(BLOCK, size[of_line] - nth * BLOCK)
        order = np.argsort(-length, kind="stable")
        self.first, self.size = first[order], length[order]
        head, tail = (nth == 0)[order], (nth == blocks[of_line] - 1)[order]
        self.head, self.tail = head, tail
        longest = int(self.size[0]) if len(self.size) else 0
        #: blocks that have a t-th token (they stand first)
        self.live = np.searchsorted(-self.size, -np.arange(longest), side="left")
        # blocks of cut lines in their order: (block before, block) as numbers in the sorted order
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        later = np.flatnonzero(nth > 0)
        self.joints = list(zip(place[later - 1].tolist(), place[later].tolist()))

    def _transfer(self, score: np.ndarray, m: np.ndarray) -> np.ndarray:
        """For each block the product of its tokens' transfer matrices (state before x state at its end), scaled."""
        needed = np.flatnonzero(~self.head)  # sorted by size, like all blocks
        product = np.repeat(np.eye(2)[None], len(needed), axis=0)
        for t in range(int(self.size[needed[0]])):
            k = int(np.searchsorted(-self.size[needed], -t, side="left"))
            step = m[None] * np.stack([np.ones(k), np.exp(score[self.first[needed[:k]] + t])], axis=1)[:, None, :]
            got = product[:k] @ step
            product[:k] = got / got.max(axis=(1, 2), keepdims=True)
        out = np.zeros((len(self.first), 2, 2))
        out[needed] = product
        return out

    def _pass_forward(self, score, m, begin, forward, blocks, before) -> None:
        """Forward messages of the given blocks; ``before`` is the message of the token before each (heads need none)."""
        m00, m01, m10, m11 = m.ravel()
        size = self.size[blocks]
        for t in range(int(size[0]) if len(size) else 0):
            k = int(np.searchsorted(-size, -t, side="left"))
            at = self.first[blocks[:k]] + t
            x = np.exp(before[:k])
            now = score[at] + np.log((x * m11 + m01) / (x * m10 + m00))
            if t == 0:
                now = np.where(self.head[blocks[:k]], score[at] + begin, now)
            before = np.clip(now, -30, 30)
            forward[at] = before

    def messages(self, score: np.ndarray, move: np.ndarray, begin: float):
        """Forward and backward log odds of state 1 at each token."""
        m = np.exp(move)
        m00, m01, m10, m11 = m.ravel()
        forward, backward = np.empty_like(score), np.zeros_like(score)
        last = self.first + self.size - 1
        heads = np.flatnonzero(self.head)
        self._pass_forward(score, m, begin, forward, heads, np.zeros(len(heads)))
        odds = lambda v: min(30.0, max(-30.0, math.log(max(v[1], 1e-300) / max(v[0], 1e-300))))
        if self.joints:
            transfer = self._transfer(score, m)
            arriving = np.zeros(len(self.first))
            leaving = {}
            for before, block in self.joints:
                arriving[block] = leaving[before] if before in leaving else forward[last[before]]
                leaving[block] = odds(np.array([1.0, math.exp(arriving[block])]) @ transfer[block])
            rest = np.flatnonzero(~self.head)
            self._pass_forward(score, m, begin, forward, rest, arriving[rest])
            # what follows a block's last token: the blocks after it, from the end of the line
            for before, block in reversed(self.joints):
                backward[last[before]] = odds(transfer[block] @ np.array([1.0, math.exp(backward[last[block]])]))
        for t in range(len(self.live) - 2, -1, -1):
            at = self.first[: self.live[t + 1]] + t
            x = np.exp(np.clip(score[at + 1] + backward[at + 1], -30, 30))
            backward[at] = np.log((x * m11 + m10) / (x * m01 + m00))
        return forward, backward

    def pairs(self, score, move, forward, backward):
        """Expected number of each of the four moves."""
        total = np.zeros(4)
        inner = np.ones(len(score), dtype=bool)
        inner[self.line_ends] = False
        at = np.flatnonzero(inner)
        after = np.clip(score[at + 1] + backward[at + 1], -30, 30)
        for lo in range(0, len(at), 1 << 18):  # in blocks, for the memory
            f, a = forward[at[lo : lo + (1 << 18)]], after[lo : lo + (1 << 18)]
            # state pairs (i, j): i times the forward odds, j times what follows
            logs = np.stack([move[0, 0] + 0 * a, move[0, 1] + a, move[1, 0] + f, move[1, 1] + f + a])
            p = np.exp(logs - logs.max(axis=0))
            total += (p / p.sum(axis=0)).sum(axis=1)
        return total.reshape(2, 2)


@dataclass
class ToxicityModel:
    """weights of the features, bias, moves between states, and the calibration of a document's score."""

    weights: np.ndarray
    bias: float
    move: np.ndarray
    begin: float
    calibration: np.ndarray

    def known(self):
        """The scores of tokens, computed when first asked for."""
        weights, bias = self.weights.astype(float).tolist(), self.bias

        class Scores(dict):
            def __missing__(self, token):
                value = self[token] = bias + sum(map(weights.__getitem__, token_features(token)))
                return value

        return Scores()

    def marginals(self, texts, known=None):
        """The texts' lines, and the probability that each token is toxic and its text's number."""
        lines = Lines()
        for k, text in enumerate(texts):
            lines.add(k, text)
        scores = map((self.known() if known is None else known).__getitem__, lines.tokens)
        scores = np.clip(np.fromiter(scores, dtype=float, count=len(lines.tokens)), -30, 30)
        forward, backward = Chain(lines.start, lines.size).messages(scores, self.move, self.begin)
        p = 1 / (1 + np.exp(-np.clip(forward + backward, -60, 60)))
        return lines, p, np.repeat(np.asarray(lines.doc, dtype=np.int64), lines.size).astype(int)

    def scorer(self):
        """A function from texts to (score, predicted, n_toxic, spans)."""
        known = self.known()

        def of(texts):
            columns, lo = [[], [], [], []], 0
            while lo < len(texts):
                hi, n = lo, 0
                while hi < len(texts) and (hi == lo or n + len(texts[hi]) <= CHARS_AT_ONCE):
                    n += len(texts[hi])
                    hi += 1
                if len(known) > REMEMBERED:
                    known.clear()
                for column, values in zip(columns, self._score(texts[lo:hi], known)):
                    column += values
                lo = hi
            return columns

        return of

    def _score(self, texts, known):
        lines, p, doc = self.marginals(texts, known)
        score = 1 / (1 + np.exp(-(aggregates(p, doc, len(texts)) @ self.calibration)))
        toxic = np.flatnonzero(p >= 0.5)
        n_toxic = np.bincount(doc[toxic], minlength=len(texts)).tolist()
        return score.tolist(), (score >= THRESHOLD).astype(int).tolist(), n_toxic, offending(texts, lines, toxic)


def aggregates(p: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Per document: one, log odds that any token is toxic, log of the expected number, and the expected share."""
    clean = np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=n)
    total, count = np.bincount(doc, p, minlength=n), np.bincount(doc, minlength=n)
    any_ = np.clip(1 - np.exp(clean), 1e-6, 1 - 1e-6)
    return np.stack([np.ones(n), np.log(any_ / (1 - any_)) / 4, np.log1p(total), 10 * total / np.maximum(count, 1)], axis=1)


def offending(texts, lines: Lines, toxic: np.ndarray):
    """[(start, end)] character offsets of the toxic tokens of each text; neighbours join.

    Each text with a toxic token is walked once, line by line.
    """
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    starts, docs = np.asarray(lines.start, dtype=np.int64), np.asarray(lines.doc, dtype=np.int64)
    of_line = np.searchsorted(starts + np.asarray(lines.size, dtype=np.int64), toxic, side="right")
    first_line = np.searchsorted(docs, np.arange(len(texts)))
    numbers, cuts = np.unique(of_line, return_index=True)
    tokens = (toxic - starts[of_line]).tolist()
    marked = {int(n): tokens[lo:hi] for n, lo, hi in zip(numbers, cuts, [*cuts[1:], len(toxic)])}
    for k in np.unique(docs[numbers]).tolist():
        base = 0
        for number, line in enumerate(texts[k].split("\n"), int(first_line[k])):
            last = None
            wanted = iter(marked.get(number, ()))
            t = next(wanted, None)
            for n, m in enumerate(_TOKEN.finditer(line) if t is not None else ()):
                if n == t:
                    if last is not None and t == last + 1:
                        spans[k][-1] = (spans[k][-1][0], base + m.end())
                    else:
                        spans[k].append((base + m.start(), base + m.end()))
                    last, t = t, next(wanted, None)
                    if t is None:
                        break
            base += len(line) + 1
    return [[{"start": a, "end": b} for a, b in x] for x in spans]


def train(texts: list[str], labels: list[int], weight: dict[int, float]) -> ToxicityModel:
    """Fit on a bounded sample; every ``CALIBRATION``-th document only calibrates the scores."""
    apart = [k % CALIBRATION == CALIBRATION - 1 for k in range(len(texts))]
    held, held_labels = [t for t, a in zip(texts, apart) if a], [v for v, a in zip(labels, apart) if a]
    texts, labels = [t for t, a in zip(texts, apart) if not a], [v for v, a in zip(labels, apart) if not a]
    toxic = np.array(labels, dtype=bool)
    lines, strings = Lines(), {}
    for k, text in enumerate(texts):
        lines.add(k, text, strings)
    kinds = {t: i for i, t in enumerate(dict.fromkeys(lines.tokens))}
    kind = np.fromiter(map(kinds.__getitem__, lines.tokens), dtype=np.int64, count=len(lines.tokens))
    features = np.array([token_features(t) for t in kinds], dtype=np.int32).reshape(-1, 1 + len(PREFIXES) + len(SUFFIXES))
    doc = np.repeat(np.asarray(lines.doc, dtype=np.int64), lines.size).astype(np.int64)
    # lines that several documents share count once, so that copies prove nothing
    number: dict[tuple, int] = {}
    keys = ((bool(toxic[d]), hash(tuple(lines.tokens[a : a + n]))) for d, a, n in zip(lines.doc, lines.start, lines.size))
    own = np.array([number.setdefault(key, len(number)) for key in keys], dtype=np.int64)
    # the first of equal lines stands for them, in its document
    once = np.zeros(len(number), dtype=np.int64)
    once[own[::-1]] = np.arange(len(own))[::-1]
    counted = np.zeros(len(own), dtype=bool)
    counted[once] = True
    counted = np.repeat(counted, lines.size).astype(bool)
    kind_once, doc_once = kind[counted], doc[counted]
    total = np.bincount(toxic[doc_once].astype(int), minlength=2)
    with_feature, docs_with = np.zeros((2, BUCKETS)), np.zeros((2, BUCKETS))
    by_class = [np.bincount(kind_once[toxic[doc_once] == c], minlength=len(kinds)) for c in (False, True)]
    for column in range(features.shape[1]):
        seen = np.unique(doc_once * BUCKETS + features[kind_once, column])
        for c in (0, 1):
            with_feature[c] += np.bincount(features[:, column], by_class[c], minlength=BUCKETS)
            docs_with[c] += np.bincount(seen[toxic[seen // BUCKETS] == bool(c)] % BUCKETS, minlength=BUCKETS)
    # the longer documents have more of the rare features
    rate = max(toxic.mean(), total[1] / max(1, total.sum())) if len(toxic) else 0.5
    marks = marking(with_feature, docs_with, total, min(max(rate, 1e-3), 0.999))
    y = (marks[features].any(axis=1)[kind] & toxic[doc]).astype(float)

    del number, own, once, counted, kind_once, doc_once, seen, strings
    lines.tokens = []
    chain = Chain(lines.start, lines.size)
    starts = np.asarray(lines.start, dtype=np.int64)[np.asarray(lines.size, dtype=np.int64) > 0]
    inner = np.ones(len(kind), dtype=bool)
    inner[starts] = False
    at = np.flatnonzero(inner)
    seen_moves = np.bincount((2 * y[at - 1] + y[at]).astype(int), minlength=4).reshape(2, 2).astype(float)
    w, bias, move, begin = np.zeros(BUCKETS), -4.0, np.zeros((2, 2)), 0.0
    square = [np.zeros(BUCKETS), 0.0, np.zeros((2, 2)), 0.0]
    n = max(1.0, y.sum())
    for _ in range(STEPS if y.any() else 0):
        score = np.clip(bias + w[features].sum(axis=1), -30, 30)[kind]
        forward, backward = chain.messages(score, move, begin)
        p = 1 / (1 + np.exp(-(forward + backward)))
        by_kind = np.bincount(kind, y - p, minlength=len(kinds))
        slope = np.zeros(BUCKETS)
        for column in range(features.shape[1]):
            slope += np.bincount(features[:, column], by_kind, minlength=BUCKETS)
        moves = seen_moves - chain.pairs(score, move, forward, backward)
        slopes = [slope / n - RIDGE * w, by_kind.sum() / n, moves / n, (y - p)[starts].sum() / n]
        square = [s + g * g for s, g in zip(square, slopes)]
        w, bias, move, begin = (v + 0.5 * g / (np.sqrt(s) + 1e-8) for v, g, s in zip((w, bias, move, begin), slopes, square))
    model = ToxicityModel(w.astype(np.float32), float(bias), move, float(begin), np.zeros(4))
    if held:
        p, doc = model.marginals(held)[1:]
        sample_weight = np.array([weight[v] for v in held_labels])
        model.calibration = calibrated(aggregates(p, doc, len(held)), np.array(held_labels, float), sample_weight)
    return model


def calibrated(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton steps with a small ridge."""
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(x.shape[1])
        step = np.linalg.solve(hessian, x.T @ (weight * (y - p)) - 0.1 * beta)
        beta += step
        if np.abs(step).max() < 1e-6:
            break
    return beta


def fit(docs: DataFrame, labels: DataFrame, per_class: dict[int, int] | None = None, max_chars: int = SAMPLE_CHARS) -> ToxicityModel:
    """Train on at most ``per_class`` labelled documents with ``max_chars`` characters together."""
    per_class = per_class or {0: SAMPLE_CLEAN, 1: SAMPLE_TOXIC}
    texts, found, weight = labelled_sample(docs, labels, "toxic", per_class, max_chars)
    return train(texts, found, weight)


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, held_out, score, predicted, n_toxic, spans: one row for each row of ``docs``.

    spans are the character offsets (start, end) of runs of offending tokens.  A
    null or wordless text has no tokens and the score of a document with no
    toxic token.  Without any labelled row every score is 0.5.  Repeated rows
    repeat; an empty table gives no rows; extra columns are never read.
    """
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    fields = [
        ("score", pa.float64(), "double"),
        ("predicted", pa.int32(), "int"),
        ("n_toxic", pa.int32(), "int"),
        ("spans", span, "array<struct<start:int,end:int>>"),
    ]
    return score_table(docs, model.scorer, fields)


def keep_clean(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are not predicted toxic."""
    return keep_rows(docs, model.scorer, lambda columns: [v == 0 for v in columns[1]])
