"""Repeat removal against a plain version that looks up every string."""

import hashlib
import random

from modelferry.llm import repeat_removal as R
from modelferry.llm.common import prepare

L = R.LENGTH


def plain(rows):
    first = {}
    texts = [(i if i is not None else R.LAST_ID, (t or "").encode()) for i, t in rows]
    for i, t in texts:
        for a in range(len(t) - L + 1):
            s = t[a:a + L]
            first[s] = min(first.get(s, i), i)
    out = []
    for (doc_id, _), (i, t) in zip(rows, texts):
        gone = bytearray(len(t))
        for a in range(len(t) - L + 1):
            if first[t[a:a + L]] < i:
                gone[a:a + L] = b"\1" * L
        spans = sum(1 for a in range(len(t)) if gone[a] and (a == 0 or not gone[a - 1]))
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((doc_id, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def sample():
    r = random.Random(9)
    words = ["".join(r.choices("abcdeé", k=r.randint(1, 6))) for _ in range(60)]

    def text(n):
        return " ".join(r.choices(words, k=n))

    passages = [text(25) for _ in range(4)]
    rows = []
    for i in range(120):
        parts = [text(r.randint(0, 60)) for _ in range(r.randint(1, 4))]
        for _ in range(r.randint(0, 2)):
            parts.insert(r.randint(0, len(parts)), r.choice(passages))
        rows.append([i, r.choice([" ", "", "\n"]).join(parts)])
    base = text(200)
    for i in range(40):  # near copies
        t = list(base)
        for _ in range(r.randint(0, 3)):
            t[r.randrange(len(t))] = "#"
        rows.append([1000 - i, "".join(t)])
    rows += [[2000 + i, rows[i][1]] for i in range(10)]  # copies
    rows += [[3, rows[50][1]], [None, rows[7][1]], [None, "x" * 30 + text(30)], [5000, None], [5001, ""],
             [5002, "a" * 300], [5003, "a" * 120 + "b" * 90], [5004, "ab" * 200], [5005, "b" + "ab" * 60],
             [5006, base[:49]], [5007, base[:50]], [5008, base[10:60]], [5009, "=" * 2000 + text(5)]]
    r.shuffle(rows)
    return [tuple(x) for x in rows]


def test_equals_plain(spark, monkeypatch):
    prepare(spark)
    rows = sample()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted((tuple(x) for x in R.repeats(docs).collect()), key=repr)
    assert got == plain(rows)


def test_slices_do_not_matter():
    import numpy as np

    data = np.frombuffer("".join(t or "" for _, t in sample()).encode(), np.uint8)
    bounds = np.append(0, np.cumsum([len((t or "").encode()) for _, t in sample()]))
    whole = R.triggers(data, bounds)
    old, R.SLICE = R.SLICE, 257
    try:
        cut = R.triggers(data, bounds)
    finally:
        R.SLICE = old
    assert all((a == b).all() for a, b in zip(whole, cut))
    # Every string of a text holds a trigger.
    held = np.zeros(len(data) + 1, int)
    held[whole[0]] = 1
    sums = np.append(0, np.cumsum(held[:-1]))
    starts = [s for a, b in zip(bounds[:-1], bounds[1:]) for s in range(a, b - L + 1)]
    assert all(sums[s + R.BEFORE + 1] > sums[s] for s in starts)


def test_no_rows(spark):
    prepare(spark)
    assert R.repeats(spark.createDataFrame([], "doc_id long, text string, k int")).count() == 0
