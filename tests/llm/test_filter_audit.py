"""The filter audit against applying the filters one by one."""

import itertools
import re

import numpy as np
from exact_rows import rows

from tutorlens.llm import filter_audit as a

LONG = " ".join(f"w{i}" for i in range(250))
DOCS = [
    (1, LONG, "s"),
    (2, LONG, "s"),
    (2, LONG, "s"),
    (3, LONG.upper(), "s"),
    (4, LONG + " 100%", None),
    (5, LONG + " 100%", ""),
    (6, "same " * 300, "t"),
    (7, "short", "t"),
    (8, None, "t"),
    (9, "", None),
    (None, "", "t"),
    (None, LONG, "s"),
    (10, "Ü" * 300, "only"),
    (11, "A\x0b\x0cB C D\x85E\x1cF " * 200, "s"),
    (12, "A " + "é " * 199, "s"),
    (13, "A " + "é " * 199, "t"),
    (14, " ".join(f"w{i % 100}" for i in range(200)), "s"),
    (15, " ".join(f"w{i % 99}" for i in range(200)), "s"),
    (16, "word " * 200_000 + "&", "s"),
    (17, "\x00" * 9, "s"),
]
LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (3, 0, 1), (4, 1, None), (5, None, 1), (None, 1, 1), (7, 1, 0), (99, 1, 1), (10, 0, 0), (16, 1, 1)]


def failing(doc, docs):
    i, text, _ = doc
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        "A": len(words) < 200,
        "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
        "D": bool(re.search(r"[#$%&*|]", text)),
        "E": i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in docs),
    }


def plain(docs, labels):
    good, toxic = ({i for i, *v in labels if i is not None and v[k] == 1} for k in (0, 1))
    out, removed_by = [], {}
    marked = [(doc, failing(doc, docs)) for doc in docs]
    for part in sorted({d[2] or "" for d in docs}):
        mine = [(d, f) for d, f in marked if (d[2] or "") == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left, gone = mine, []
            for step, letter in enumerate(order, 1):
                now = [x for x in left if x[1][letter]]
                redundant = sum(f[letter] for _, f in gone)
                left, gone = [x for x in left if not x[1][letter]], gone + now
                unique = sum(f[letter] and sum(f.values()) == 1 for _, f in mine)
                removed_by[part, letter] = removed_by.get((part, letter), 0) + len(now)
                lost = [sum(d[0] in s for d, _ in now) for s in (good, toxic)]
                out.append([part, order, step, letter, len(left), len(now), redundant, unique, *lost])
    names = ["part", "filter_order", "step", "letter", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    out = [[*r, removed_by[r[0], r[3]]] for r in out]
    return sorted((tuple(v for _, v in sorted(zip(names, r))) for r in out), key=repr)


def frames(spark, docs, labels):
    names = "doc_id long, text string, source string, part string, mask int, digest string, n int, good int, fails string, first_id int, bad int"
    d = spark.createDataFrame([(*x, "p", 1, "q", 2, 3, "f", 4, 5) for x in docs], names)
    labels = spark.createDataFrame([(*x, "part", 1) for x in labels], "doc_id long, quality int, toxic int, part string, good int")
    return d.repartition(4), labels


def test_audit_matches_applying_the_filters(spark):
    got = rows(a.audit(*frames(spark, DOCS, LABELS)))
    assert got == plain(DOCS, LABELS)
    assert len(got) == 4 * 120 * 5


def test_audit_of_nothing(spark):
    assert a.audit(*frames(spark, [], [])).collect() == []
    got = a.audit(*frames(spark, DOCS[:1], [])).collect()
    assert len(got) == 600 and all(r["kept"] == 1 and r["good_lost"] == 0 for r in got)


def test_min_plus_steps():
    orders, places = a.orders_of("ABCDE")
    assert len(set(orders)) == 120 and all(o[places[p, f] - 1] == "ABCDE"[f] for p, o in enumerate(orders) for f in range(5))
    fails = np.array([[False] * 5, [True, False, False, True, False]])
    steps = a.removal_steps(fails, places)
    assert (steps[0] >= a.NEVER).all()
    assert steps[1].tolist() == [min(o.index("A"), o.index("D")) + 1 for o in orders]
