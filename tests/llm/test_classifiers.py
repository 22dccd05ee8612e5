import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest

from tutorlens.llm import quality_mil as Q
from tutorlens.llm import toxicity_crf as C
from tutorlens.llm.common import labelled_sample

WORDS = [a + b + c for a in "bdfg" for b in "aeiou" for c in ("n", "st", "r", "m", "lly", "nd")]
INSULTS = ["snarfle", "snarfled", "grobnik"]


def corpus(n=900):
    draw = random.Random(8)
    docs, labels = [], []
    for i in range(n):
        lines = [[draw.choice(WORDS) for _ in range(draw.randint(3, 15))] for _ in range(draw.randint(1, 6))]
        toxic, low = draw.random() < 0.25, draw.random() < 0.25
        if toxic:
            for _ in range(draw.randint(1, 3)):
                line = draw.choice(lines)
                line.insert(draw.randint(0, len(line)), draw.choice(INSULTS).upper() + draw.choice(["", ",", "!"]))
        if low:
            at = draw.randrange(len(lines))
            lines[at] = [w + "###" for w in lines[at] * 3]
        docs.append((i, "\n".join(map(" ".join, lines))))
        labels.append((i, int(not low), int(toxic)))
    return docs, labels


def held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


@pytest.fixture(scope="module")
def data(spark):
    docs, labels = corpus()
    return docs, labels, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_rows(table_of, data):
    docs, labels, label_table = data
    model = C.fit(table_of(docs), label_table)
    extra = [(None, "snarfle them"), (5000, None), (5001, ""), (5002, "bast " * 50_000), (5002, "bast " * 50_000)]
    got = C.score(table_of(docs + extra), model).collect()
    assert len(got) == len(docs) + len(extra)
    truth = {i: t for i, _, t in labels}
    tested = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert all(r["held_out"] == held(r["doc_id"]) for r in got if r["doc_id"] is not None)
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in tested]) > 0.98
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)
    text = dict(docs)
    found = {text[r["doc_id"]][s["start"] : s["end"]] for r in got if r["doc_id"] in text for s in r["spans"]}
    assert {w for f in found for w in re.findall("[a-z]+", f.lower())} <= {*INSULTS}
    kept = C.keep_clean(table_of(docs + extra), model)
    assert kept.columns == table_of([]).columns
    assert kept.count() == sum(r["predicted"] == 0 for r in got)


def test_quality_on_held_out_rows(table_of, data):
    docs, labels, label_table = data
    model = Q.fit(table_of(docs), label_table)
    extra = [(None, "x"), (5000, None), (5001, ""), (5002, "bast " * 300_000), (5002, "bast")]
    got = Q.score(table_of(docs + extra), model).collect()
    assert len(got) == len(docs) + len(extra)
    truth = {i: q for i, q, _ in labels}
    tested = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in tested]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert Q.keep_good(table_of(docs), model).count() == sum(r["predicted"] == 1 for r in got if r["doc_id"] is not None and r["doc_id"] < 5000)


@pytest.mark.parametrize("module", [C, Q])
def test_without_labels_or_rows(spark, table_of, module):
    none = spark.createDataFrame([(1, None, None)], "doc_id long, quality int, toxic int")
    model = module.fit(table_of([(1, "a b"), (2, None)]), none)
    assert [r["score"] for r in module.score(table_of([(1, "a b"), (2, None)]), model).collect()] == pytest.approx([0.5, 0.5], abs=0.01)
    assert module.score(table_of([]), model).collect() == []


def test_sample_is_bounded_and_never_held_out(table_of, data):
    docs, labels, label_table = data
    again = label_table.unionAll(label_table)
    texts, found, weight = labelled_sample(table_of(docs + docs[:50]), again, "toxic", {0: 40, 1: 15}, 10_000)
    own = {t: i for i, t in docs}
    assert not any(held(own[t]) for t in texts) and len(set(texts)) == len(texts)
    assert found.count(0) <= 40 and found.count(1) <= 15 and sum(map(len, texts)) <= 10_000
    train = [t for i, _, t in labels if not held(i)]
    assert weight[1] * found.count(1) / len(found) == pytest.approx(np.mean(train))


@pytest.mark.parametrize("block", [512, 3, 2, 1])
def test_marginals_match_enumeration(monkeypatch, block):
    import itertools

    monkeypatch.setattr(C, "BLOCK", block)
    draw = np.random.default_rng(0)
    move, begin = draw.normal(size=(2, 2)), 0.4
    sizes = [4, 1, 0, 3, 9]
    score = draw.normal(size=sum(sizes))
    starts = np.cumsum([0, *sizes])[:-1]
    chain = C.Chain(starts, sizes)
    forward, backward = chain.messages(score, move, begin)
    pairs = np.zeros((2, 2))
    for a, n in zip(starts, sizes):
        total, ones = 0.0, np.zeros(n)
        moves = np.zeros((2, 2))
        for path in itertools.product((0, 1), repeat=n):
            if not n:
                continue
            w = np.exp(sum(s * y for s, y in zip(score[a : a + n], path)) + begin * path[0] + sum(move[i, j] for i, j in zip(path, path[1:])))
            total += w
            ones += w * np.array(path)
            for i, j in zip(path, path[1:]):
                moves[i, j] += w
        if n:
            assert 1 / (1 + np.exp(-(forward + backward)))[a : a + n] == pytest.approx(ones / total)
            pairs += moves / total
    assert chain.pairs(score, move, forward, backward) == pytest.approx(pairs)


def test_blocks_of_a_line_are_one_chain(monkeypatch):
    draw = np.random.default_rng(1)
    sizes = [5000, 1, 700, 512, 513, 1024, 0, 20]
    starts = np.cumsum([0, *sizes])[:-1]
    for spread, move in ((2.0, draw.normal(size=(2, 2))), (12.0, np.array([[1.0, -5.0], [-5.0, 1.0]]))):
        score = np.clip(draw.normal(size=sum(sizes), scale=spread), -30, 30)
        found = {}
        for block in (7, 512, 100_000):
            monkeypatch.setattr(C, "BLOCK", block)
            found[block] = C.Chain(starts, sizes).messages(score, move, 0.3)
        for block in (7, 512):
            for got, want in zip(found[block], found[100_000]):
                assert np.abs(got - want).max() < 1e-6


def plain_spans(text, marked):
    """Spans of the tokens that ``marked`` names, by walking every line."""
    out, base = [], 0
    for line in text.split("\n"):
        near = False
        for m in re.finditer(r"\S+", line):
            if marked(m.group()):
                if near:
                    out[-1]["end"] = base + m.end()
                else:
                    out.append({"start": base + m.start(), "end": base + m.end()})
            near = marked(m.group())
        base += len(line) + 1
    return out


def test_spans_match_a_plain_walk():
    draw = random.Random(2)
    pieces = ["bad", "ok", " ", "  ", "\t", "\n", "\r\n", "\x0b", "\u2003", "é", "bad bad", "\x1c", "\x85"]
    texts = ["".join(draw.choice(pieces) + draw.choice(["", " "]) for _ in range(draw.randint(0, 60))) for _ in range(300)]
    lines = C.Lines()
    for k, text in enumerate(texts):
        lines.add(k, text)
    toxic = np.flatnonzero([t == "bad" for t in lines.tokens])
    assert C.offending(texts, lines, toxic) == [plain_spans(t, lambda w: w == "bad") for t in texts]
    none = C.Lines()
    none.add(0, "")
    assert C.offending([""], none, np.zeros(0, dtype=np.int64)) == [[]]


def test_many_toxic_lines_and_a_very_long_one():
    train = joined_words(300)
    model = C.train([t for t, _ in train], [y for _, y in train], {0: 1.0, 1: 1.0})
    word = "réeuxment"
    of = model.scorer()
    for text in ("\n".join(f"ère {word} chi" for _ in range(80_000)), " ".join(["ère chi ou"] * 333_333 + [word]), "que " * 600 + word + " pa" * 600):
        began = time.monotonic()
        ((score,), _, (n_toxic,), (spans,)) = of([text])
        assert time.monotonic() - began < 15
        assert n_toxic == text.count(word) == len(spans) and all(text[s["start"] : s["end"]] == word for s in spans)


def plain_quality(model, text):
    """The score of one text, passage by passage, in plain Python."""
    kinds = {**{b: 0 for b in range(97, 123)}, **{b: 1 for b in range(65, 91)}, **{b: 2 for b in range(48, 58)}}
    kinds |= {b: 3 for b in b" \t\x0b\x0c"} | {b: 4 for b in b"\n\r"} | {b: 5 for b in b".,;:'\"?()-"}
    kind = [7 if b > 127 else kinds.get(b, 6) for b in text.encode() + b"\n"]
    data = text.encode() + b"\n"
    words = [(m.start(), m.end()) for m in re.finditer(rb"[^ \t\x0b\x0c\n\r]+", data)]
    heads = [0, *(a for k, (a, _) in enumerate(words) if k and k % Q.PASSAGE_WORDS == 0), len(data)]
    codes, weights = [], []
    for lo, hi in zip(heads, heads[1:]):
        pairs = [0.0] * 64
        for i in range(lo, hi):
            pairs[8 * kind[i] + (kind[i + 1] if i + 1 < len(kind) else 0)] += 1 / (hi - lo)
        own = [(a, b) for a, b in words if lo <= a < hi]
        names = [(b - a, data[a : min(b, a + 8)], data[max(a, b - 8) : b]) for a, b in own]
        n = max(1, len(own))
        lengths = [b - a for a, b in own]
        mean = sum(lengths) / n
        spread = max(0.0, sum(v * v for v in lengths) / n - mean**2) ** 0.5
        rest = [
            np.log1p(len(own)), min(mean, 50) / 10, min(spread, 50) / 10,
            sum(x == y for x, y in zip(names, names[1:])) / n, sum(x == y for x, y in zip(names, names[2:])) / n,
            len(set(names)) / n, sum(kind[b - 1] == 6 for _, b in own) / n, sum(kind[a] == 1 for a, _ in own) / n,
        ]
        p, x = model.layers, np.clip((np.array(pairs + rest) - model.centre) / model.scale, -8, 8)
        code = np.array([np.tanh(sum(x * p["W"][:, j]) + p["b"][j]) for j in range(Q.CODE)])
        gate = [np.tanh(code @ p["V"][:, j]) / (1 + np.exp(-code @ p["U"][:, j])) for j in range(Q.ATTENTION)]
        codes.append(code)
        weights.append(np.exp(sum(g * a for g, a in zip(gate, p["a"]))))
    pooled = sum(w * c for w, c in zip(weights, codes)) / sum(weights)
    return 1 / (1 + np.exp(-(pooled @ p["c"] + p["d"][0]))), len(codes), max(weights) / sum(weights)


def test_quality_scores_match_plain_python():
    texts, labels = zip(*[(t, int(k % 2)) for k, (_, t) in enumerate(corpus(60)[0])])
    model = Q.train(list(texts), list(labels), {0: 1.0, 1: 1.0})
    odd = ["", " \n\t ", "word", "a" * 300, "x y " * 500, "É ß.\r\n%% 12 " * 90, *texts[:20], ("long passage, " * 3 + "end\n") * 200]
    got = list(zip(*model.scores(odd)))
    for text, (score, count, top) in zip(odd, got):
        assert (score, count, top) == pytest.approx(plain_quality(model, text), abs=1e-5)
    # the score of a text does not depend on the others beside it
    assert np.abs(model.scores(odd[::-1])[0][::-1] - model.scores(odd)[0]).max() < 1e-6


def test_quality_gradients_match_differences():
    draw = np.random.default_rng(4)
    doc = np.repeat(np.arange(7), [1, 4, 2, 1, 3, 5, 1])
    first = np.searchsorted(doc, np.arange(7))
    x, y = draw.normal(size=(len(doc), Q.FEATURES)), draw.integers(0, 2, 7).astype(float)
    weight = draw.random(7)
    layers = {k: v + draw.normal(scale=0.3, size=v.shape) for k, v in Q.new_layers().items()}
    slopes = Q.loss_slopes(layers, x, doc, first, y, weight)[1]
    for name, value in layers.items():
        for _ in range(12):
            at = tuple(draw.integers(0, n) for n in value.shape)
            loss = []
            for step in (1e-5, -1e-5):
                moved = {**layers, name: value.copy()}
                moved[name][at] += step
                loss.append(Q.loss_slopes(moved, x, doc, first, y, weight)[0])
            assert slopes[name][at] == pytest.approx((loss[0] - loss[1]) / 2e-5, abs=1e-7, rel=1e-5)


def test_long_documents_do_not_end_the_sample(spark, table_of, data):
    docs, labels, label_table = data
    train = sorted((i for i, _, _ in labels if not held(i)), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    label = {i: t for i, _, t in labels}
    first = {v: next(i for i in train if label[i] == v) for v in (0, 1)}
    # the first of each class is over the bound, the next fills half of its class's share; other ids are not in the input
    second = {v: [i for i in train if label[i] == v][1] for v in (0, 1)}
    size = {first[0]: 100_001, first[1]: 100_001, second[0]: 40_000, second[1]: 10_000}
    long = [(i, "x" * size[i] if i in size else t) for i, t in docs]
    strange = spark.createDataFrame([(i, 1, i % 2) for i in range(10**6, 10**6 + 2000)], label_table.schema)
    texts, found, weight = labelled_sample(table_of(long), label_table.unionAll(strange), "toxic", {0: 80, 1: 20}, 100_000)
    assert (found.count(0), found.count(1)) == (80, 20) and sum(map(len, texts)) <= 100_000
    assert weight[1] * 0.2 == pytest.approx(np.mean([label[i] for i in train]))


@pytest.mark.parametrize("docs", [[(0, "x" * 1000), (2, "x" * 1000)], [(1_000_000, "a")]])
def test_an_empty_class_is_an_error(table_of, data, docs):
    with pytest.raises(ValueError, match="no document of class"):
        labelled_sample(table_of(docs), data[2], "toxic", {0: 80, 1: 20}, 500)
    assert labelled_sample(table_of([]), data[2], "toxic", {0: 80, 1: 20}, 500) == ([], [], {})


SYLLABLES = ["réeux", "ère", "ment", "è", "aux", "que", "ou", "tion", "pa", "chi"]


def joined_words(n=1000, seed=3):
    """Marked words have a common first part and many endings; clean texts hold a few of them too."""
    draw, rows = random.Random(seed), []
    for i in range(n):
        toxic = draw.random() < 0.15
        words = ["".join(draw.choice(SYLLABLES[1:]) for _ in range(draw.randint(1, 3))) for _ in range(100)]
        marks = 3 if toxic else int(draw.random() < 0.08)
        for at in draw.sample(range(100), marks):
            words[at] = SYLLABLES[0] + "".join(draw.choice(SYLLABLES[1:]) for _ in range(draw.randint(1, 2)))
        rows.append((" ".join(words[:50]) + "\n" + " ".join(words[50:]), int(toxic)))
    return rows


def test_markers_that_clean_texts_hold_too():
    train, test = joined_words(), joined_words(seed=4)
    toxic = np.mean([y for _, y in train])
    model = C.train([t for t, _ in train], [y for _, y in train], {0: 1.0, 1: 1.0})
    score, predicted, n_toxic, spans = model.scorer()([t for t, _ in test])
    truth = np.array([y for _, y in test])
    assert 0.1 < toxic < 0.2 and np.mean(np.array(predicted)[truth == 1]) > 0.9
    assert np.mean(np.array(predicted)[truth == 0]) < 0.01
    assert np.mean([t[s["start"] : s["end"]].startswith(SYLLABLES[0]) for (t, _), x in zip(test, spans) for s in x]) > 0.95
