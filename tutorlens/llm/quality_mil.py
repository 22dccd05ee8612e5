"""Operator 10: document quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE_WORDS`` words.  Every passage is
encoded from the frequencies of its pairs of character classes and from its
words' lengths and repetitions; gated attention learns from document labels how
much each passage counts, and the weighted passage representation is scored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tutorlens.llm.common import keep_rows, labelled_sample, score_table

PASSAGE_WORDS = 64
#: Bounds of the training sample, which the driver holds.
SAMPLE_LOW, SAMPLE_HIGH, SAMPLE_CHARS = 1000, 2000, 8_000_000
#: Sizes of the passage code and of the attention layer, and Adam's steps.
CODE, ATTENTION, STEPS = 24, 12, 150
#: Characters encoded at once; passages start anew where a longer text is cut.
CHARS_AT_ONCE = 1_000_000
THRESHOLD = 0.5

#: Classes: lower case, upper case, digit, blank, line end, sentence mark, symbol, other than ASCII.
CLASS = np.full(256, 7, dtype=np.uint8)
CLASS[:128] = 6
for _k, _chars in enumerate((range(97, 123), range(65, 91), range(48, 58), b" \t\x0b\x0c", b"\n\r", b".,;:'\"?()-")):
    CLASS[list(_chars)] = _k
FEATURES = 64 + 8


def passage_features(segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(features, segment number) of every passage; a segment without words is one passage."""
    raw = [s.encode("utf-8", "surrogatepass") + b"\n" for s in segments]
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    begins = np.r_[0, np.cumsum([len(r) for r in raw])][:-1]
    kinds = CLASS[data]
    blank = (kinds == 3) | (kinds == 4)
    starts = np.flatnonzero(~blank & np.r_[True, blank[:-1]])
    ends = np.flatnonzero(~blank & np.r_[blank[1:], True]) + 1
    of_segment = np.searchsorted(begins, starts, side="right") - 1
    nth = np.arange(len(starts)) - np.searchsorted(starts, begins)[of_segment]
    # a passage begins with its segment, or with each PASSAGE_WORDS-th word after
    later = starts[(nth % PASSAGE_WORDS == 0) & (nth > 0)]
    heads = np.sort(np.r_[begins, later])
    segment = np.searchsorted(begins, heads, side="right") - 1
    sizes = np.diff(np.r_[heads, len(data)])
    n = len(heads)
    pairs = kinds.astype(np.int64) * 8
    pairs[:-1] += kinds[1:]
    last = np.r_[begins[1:], len(data)] - 1  # nothing follows the end of a segment
    pairs[last] = kinds[last].astype(np.int64) * 8
    pairs += np.repeat(np.arange(n) * 64, sizes)
    shape = np.bincount(pairs, minlength=n * 64).reshape(n, 64) / sizes[:, None]

    own = np.searchsorted(heads, starts, side="right") - 1
    words = np.maximum(np.bincount(own, minlength=n), 1)
    length = (ends - starts).astype(float)
    mean = np.bincount(own, length, minlength=n) / words
    spread = np.sqrt(np.maximum(np.bincount(own, length**2, minlength=n) / words - mean**2, 0))
    key = word_keys(data, starts, ends)
    same = lambda k: np.r_[np.zeros(min(k, len(key))), (key[k:] == key[:-k]) & (own[k:] == own[:-k])]
    first = np.unique((key ^ own.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)[1]
    closing = kinds[ends - 1]
    words_columns = [
        np.log1p(np.bincount(own, minlength=n)),
        np.minimum(mean, 50) / 10,
        np.minimum(spread, 50) / 10,
        np.bincount(own, same(1), minlength=n) / words,
        np.bincount(own, same(2), minlength=n) / words,
        np.bincount(own[first], minlength=n) / words,
        np.bincount(own, closing == 6, minlength=n) / words,
        np.bincount(own, kinds[starts] == 1, minlength=n) / words,
    ]
    return np.column_stack([shape, *words_columns]), segment


def word_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each word from its length, its first eight and its last eight bytes."""
    key = (ends - starts).astype(np.uint64)
    for k in range(8):
        for at in (starts + k, ends - 1 - k):
            inside = (at < ends) & (at >= starts)
            key = key * np.uint64(0x100000001B3) + np.where(inside, data[np.clip(at, 0, len(data) - 1)], 0).astype(np.uint64)
    return key


def segments_of(texts: list[str]):
    """Blocks of (segments, document numbers) of at most about CHARS_AT_ONCE characters."""
    segments, docs, n = [], [], 0
    for k, text in enumerate(texts):
        lo = 0
        while True:
            hi = len(text)
            if hi - lo > CHARS_AT_ONCE:
                cut = text.rfind(" ", lo + 1, lo + CHARS_AT_ONCE)
                hi = cut if cut > 0 else lo + CHARS_AT_ONCE
            if segments and n + hi - lo > CHARS_AT_ONCE:
                yield segments, docs
                segments, docs, n = [], [], 0
            segments.append(text[lo:hi])
            docs.append(k)
            n += hi - lo
            lo = hi
            if lo >= len(text):
                break
    if segments:
        yield segments, docs


def passages(texts: list[str]):
    """(features, document number) of every passage of the texts, block by block."""
    for segments, docs in segments_of(texts):
        features, segment = passage_features(segments)
        yield features, np.asarray(docs)[segment]


@dataclass
class QualityModel:
    """centre and scale of the features, and the layers' weights."""

    centre: np.ndarray
    scale: np.ndarray
    layers: dict[str, np.ndarray]

    def encode(self, features: np.ndarray) -> np.ndarray:
        return np.tanh(np.clip((features - self.centre) / self.scale, -8, 8) @ self.layers["W"] + self.layers["b"])

    def attention(self, code: np.ndarray) -> np.ndarray:
        return (np.tanh(code @ self.layers["V"]) * sigmoid(code @ self.layers["U"])) @ self.layers["a"]

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Score of every text, and its number of passages and largest attention weight."""
        out, count, top = np.full(len(texts), np.nan), np.zeros(len(texts), int), np.zeros(len(texts))
        if not texts:
            return out, count, top
        codes, weights, docs = [], [], []
        for features, doc in passages(texts):
            code = self.encode(features)
            codes.append(code.astype(np.float32))
            weights.append(self.attention(code))
            docs.append(doc)
        code, weight, doc = np.concatenate(codes), np.concatenate(weights), np.concatenate(docs)
        first = np.searchsorted(doc, np.arange(len(texts)))
        share, pooled = pool(code, weight, doc, first)
        return sigmoid(pooled @ self.layers["c"] + self.layers["d"][0]), np.bincount(doc, minlength=len(texts)), np.maximum.reduceat(share, first)

    def scorer(self):
        def of(texts):
            score, count, top = self.scores(texts)
            return score.tolist(), (score >= THRESHOLD).astype(int).tolist(), count.tolist(), top.tolist()

        return of


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def pool(code, weight, doc, first):
    """Softmax of the weights within each document, and the documents' weighted codes."""
    e = np.exp(weight - np.maximum.reduceat(weight, first)[doc])
    share = e / np.add.reduceat(e, first)[doc]
    return share, np.add.reduceat(share[:, None] * code, first, axis=0)


def loss_slopes(p: dict[str, np.ndarray], x: np.ndarray, doc: np.ndarray, first: np.ndarray, y: np.ndarray, row_weight: np.ndarray):
    """The weighted log loss of the documents, and its slope by each layer.

    x: scaled features of the passages; doc: their documents; first: each document's first passage.
    """
    code = np.tanh(x @ p["W"] + p["b"])
    t, s = np.tanh(code @ p["V"]), sigmoid(code @ p["U"])
    share, pooled = pool(code, (t * s) @ p["a"], doc, first)
    odds = pooled @ p["c"] + p["d"][0]
    loss = row_weight @ (np.logaddexp(0, odds) - y * odds)
    slope = row_weight * (sigmoid(odds) - y)
    to_pooled = slope[:, None] * p["c"]
    to_share = (to_pooled[doc] * code).sum(axis=1)
    to_weight = share * (to_share - np.add.reduceat(share * to_share, first)[doc])
    to_t, to_s = to_weight[:, None] * p["a"] * s * (1 - t**2), to_weight[:, None] * p["a"] * t * s * (1 - s)
    to_code = share[:, None] * to_pooled[doc] + to_t @ p["V"].T + to_s @ p["U"].T
    to_code *= 1 - code**2
    return loss, {
        "W": x.T @ to_code, "b": to_code.sum(axis=0), "V": code.T @ to_t, "U": code.T @ to_s,
        "a": (t * s).T @ to_weight, "c": pooled.T @ slope, "d": np.array([slope.sum()]),
    }


def new_layers(seed: int = 7) -> dict[str, np.ndarray]:
    draw = np.random.default_rng(seed)
    spread = lambda *shape: draw.normal(0, shape[0] ** -0.5, shape)
    layers = {"W": spread(FEATURES, CODE), "b": np.zeros(CODE), "V": spread(CODE, ATTENTION), "U": spread(CODE, ATTENTION)}
    return layers | {"a": spread(ATTENTION), "c": np.zeros(CODE), "d": np.zeros(1)}


def train(texts: list[str], labels: list[int], weight: dict[int, float], seed: int = 7) -> QualityModel:
    """Fit all layers together with Adam; without labels every score is near one half."""
    layers = new_layers(seed)
    if not texts:
        return QualityModel(np.zeros(FEATURES), np.ones(FEATURES), layers)
    parts = list(passages(texts))
    x, doc = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    model = QualityModel(x.mean(axis=0), x.std(axis=0) + 1e-3, layers)
    x = np.clip((x - model.centre) / model.scale, -8, 8)
    first = np.searchsorted(doc, np.arange(len(texts)))
    y, row_weight = np.array(labels, float), np.array([weight[v] for v in labels])
    row_weight /= row_weight.sum()
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in layers.items()}
    for step in range(1, STEPS + 1):
        for k, g in loss_slopes(layers, x, doc, first, y, row_weight)[1].items():
            g = g + 1e-5 * layers[k]
            m, v = moments[k]
            moments[k] = m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            layers[k] = layers[k] - 0.03 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return model


def fit(docs: DataFrame, labels: DataFrame, per_class: dict[int, int] | None = None, max_chars: int = SAMPLE_CHARS) -> QualityModel:
    """Train on at most ``per_class`` labelled documents with ``max_chars`` characters together."""
    per_class = per_class or {0: SAMPLE_LOW, 1: SAMPLE_HIGH}
    texts, found, weight = labelled_sample(docs, labels, "quality", per_class, max_chars)
    return train(texts, found, weight)


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id, held_out, score, predicted, n_passages, top_weight: one row for each row of ``docs``.

    top_weight is the largest attention weight of a passage.  A null or wordless
    text is one passage without words.  Repeated rows repeat; an empty table
    gives no rows; extra columns are never read.
    """
    fields = [
        ("score", pa.float64(), "double"),
        ("predicted", pa.int32(), "int"),
        ("n_passages", pa.int32(), "int"),
        ("top_weight", pa.float64(), "double"),
    ]
    return score_table(docs, model.scorer, fields)


def keep_good(docs: DataFrame, model: QualityModel) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are not predicted to be of low quality."""
    return keep_rows(docs, model.scorer, lambda columns: [v == 1 for v in columns[1]])
