import base64
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from tutorlens.llm import best_fit_packing as K
from tutorlens.llm import byte_bpe as B

RANKS, JSON = P.path("byte_bpe_multi_50k.tiktoken"), P.path("byte_bpe_50k.json")
PARTS = ["a", "b", "A", " ", "  ", "\n", "'s", "é", "中", "😀", "1", "٣", "_", " ", "\x1c", "\x85", "́", "aaaa", "ab" * 40, "中文" * 50, "<|endoftext|>"]


def odd_texts(n=300):
    draw = random.Random(1)
    return ["".join(draw.choice(PARTS) for _ in range(draw.randint(0, 50))) for _ in range(n)]


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_matrix_encoder_equals_library(reference, monkeypatch):
    own = B.Encoder(RANKS, P.PATTERN)
    draw = random.Random(4)
    long = ["a" * 5000, "".join(draw.choice("abcdefghij") for _ in range(3000)), "".join(map(chr, range(0x4E00, 0x5100)))]
    texts = odd_texts() + long
    for at_once in (B.MATCHES_AT_ONCE, 7):
        monkeypatch.setattr(B, "MATCHES_AT_ONCE", at_once)
        got = [b""] * len(texts)
        for k, ids in own.blocks(texts):
            got[k] += ids
        for ids, text in zip(got, texts):
            assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)
            assert own.bpe.decode(ids) == text.encode()


def test_round_trip_table(table_of, reference):
    texts = [(k, t) for k, t in enumerate(odd_texts(40))] + [(100, None), (101, ""), (101, ""), (None, "x y"), (102, "word " * 60_000)]
    got = {r["doc_id"]: tuple(r)[1:] for r in B.round_trip(table_of(texts), RANKS, P.PATTERN).collect()}
    for i, t in texts:
        ids = np.array(reference.encode_ordinary(t or ""), dtype="<u4").tobytes()
        assert got[i] == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    ids = {r["doc_id"]: r["ids"] for r in B.encoded(table_of(texts[:5]), RANKS, P.PATTERN).collect()}
    assert ids[3] == reference.encode_ordinary(texts[3][1])
    assert B.round_trip(table_of([]), RANKS, P.PATTERN).collect() == []


def test_fast_encoder_equals_tokenizers():
    library, fast = Tokenizer.from_file(JSON), K.encoder(JSON)
    for text in odd_texts():
        assert fast(text).tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("space", [" ", "\t", "\n", "\r\n", "\u3000", " \x85"])
def test_very_long_white_space_equals_tokenizers(space):
    library, fast = Tokenizer.from_file(JSON), K.encoder(JSON)
    run = space * (2_000_000 // len(space))
    for text in (run, "a" + run, run + "b", "x" + run + " y" + run[:20_000] + "\n<|endoftext|> z", run[:30_000] + "<|endoftext|>" + run[:30_000] + "é"):
        assert np.array_equal(fast(text), library.encode(text, add_special_tokens=False).ids)


def check_packing(got, pairs, size):
    library = Tokenizer.from_file(JSON)
    pieces = defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
    want = defaultdict(list)
    for i, t in pairs:
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        start, end, n = 0, (len(ids) - 1) % size + 1, 0
        while start < len(ids):
            want[i].append((n, start, end - start, zlib.crc32(np.array(ids[start:end], dtype="<u4").tobytes())))
            start, end, n = end, end + size, n + 1
    assert {i: sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in p) for i, p in pieces.items()} == {
        i: sorted(p) for i, p in want.items()
    }
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return len(sequences), -(-sum(r["length"] for r in got) // size)


def test_packing_table(table_of):
    draw = random.Random(2)
    texts = [(k, "w " * draw.randint(0, 300)) for k in range(150)] + [(200, None), (201, ""), (202, "w " * 5000), (203, "x"), (203, "x"), (None, "y")]
    used, bound = check_packing(K.pack(table_of(texts), JSON, max_tokens=64).collect(), texts, 64)
    assert used <= bound + max(2, bound // 100)
    assert K.pack(table_of([]), JSON).collect() == []


def test_packing_whole_table(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet").select("doc_id", "text")
    used, bound = check_packing(K.pack(docs, JSON).collect(), [tuple(r) for r in docs.collect()], 1024)
    assert used <= bound + 2


def check_histogram(histogram, size):
    """Every piece in one sequence; the number of sequences, of fitted ones, and of best fit's."""
    packed, fitted = K.pack_histogram(histogram, size)
    used = defaultdict(int)
    for lengths, n in packed:
        assert sum(lengths) <= size and n > 0
        for v in lengths:
            used[v] += n
    assert dict(used) == {k: n for k, n in histogram.items() if n}
    return sum(n for _, n in packed), fitted, sum(n for _, n in K.best_fit(histogram, size))


@pytest.mark.parametrize("histogram", [{}, {64: 3}, {1: 1}, {33: 7}, {40: 5, 24: 5}, {k: 1000 - k for k in range(1, 65)}, {60: 1000, 5: 7}, {64: 2, 63: 1}])
def test_patterns_use_every_piece_once(histogram):
    total, fitted, plain = check_histogram(histogram, 64)
    assert fitted <= total <= plain


def lengths_between(low, high, n):
    values, counts = np.unique(np.random.default_rng(0).integers(low, high, n), return_counts=True)
    return dict(zip(values.tolist(), counts.tolist()))


@pytest.mark.parametrize(
    "histogram",
    [
        lengths_between(20, 300, 360_000),
        {600: 1000, 500: 2000, 300: 1500, 7: 3000},
        lengths_between(345, 1000, 100_000),
        lengths_between(1, 1025, 50_000),
        {k: 1000 * n for k, n in lengths_between(1, 1025, 50_000).items()},
    ],
    ids=["short", "sparse", "long", "uniform", "many"],
)
def test_most_sequences_are_fitted(histogram):
    total, fitted, plain = check_histogram(histogram, 1024)
    assert fitted >= 0.9 * total and total <= plain


def test_fullest_and_fit():
    full = K.fullest(np.array([4, 6]), 11)
    assert full.tolist() == [0, 0, 0, 0, 4, 4, 6, 6, 8, 8, 10, 10]
    patterns = K.Patterns(10)
    for used in ({6: 1, 4: 1}, {4: 2}, {6: 1}, {4: 2}):
        patterns.add(used)
    assert list(patterns.number) == [((6, 1), (4, 1)), ((4, 2),), ((6, 1),)]
    target = np.zeros(11)
    target[[4, 6]] = 700, 300
    x = K.fit(patterns.columns(), target, np.zeros(0), 3000)
    # where the slopes vanish: (x0 + 2 x1 - 700) / 700 = -0.1 by the price of two unused tokens, (x0 - 300) / 300 = 0.1
    assert np.allclose(x, [330, 150, 0], atol=0.1)
