"""Nearest neighbours against all pairs."""

import math

import numpy as np
import pytest

from modelferry.llm import adaptive_scan as A
from modelferry.llm.common import prepare

SCHEMA = "vec_id long, embedding array<float>, score int"


def plain(rows, every=20):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v) and len(v) == 12:
            good.setdefault(i, []).append(np.array(v, np.float32).astype(float))
    out = {}
    for q in (i for i in good if i % every == 0):
        best = sorted((-max(float((x * good[q][0]).sum()) for x in vs), i) for i, vs in good.items() if i != q)[:20]
        out[q] = [i for _, i in best]
    return out


def rows_of(seed, n):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(6, 12)) * 2
    x = centres[r.integers(0, 6, n)] + r.normal(size=(n, 12)) * r.choice([0.1, 1.0], size=(n, 1))
    x[n // 2: n // 2 + n // 3] = x[0]  # a third are one vector
    rows = [(i, [float(v) for v in np.float32(row)]) for i, row in enumerate(x)]
    return rows + [(n + 20, None), (n + 40, [0.0] * 12), (n + 60, [float("nan")] * 12), (n + 80, [1.0] * 11 + [None]), (None, [1.0] * 12),
                   (n + 100, [float("inf")] * 12), (n + 120, []), (n + 140, [1.0, 2.0])]


@pytest.mark.parametrize("block", [64, 2048])
def test_recall_order_and_scores(spark, monkeypatch, block):
    prepare(spark)
    monkeypatch.setattr(A, "LIST_ROWS", 100)
    monkeypatch.setattr(A, "BLOCK_ROWS", block)
    monkeypatch.setattr(A, "QUERY_ROWS", 16)
    rows = rows_of(block, 1200)
    got = {}
    for r in A.nearest(spark.createDataFrame([(*x, 0) for x in rows], SCHEMA)).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    expected = plain(rows)
    vectors = {i: np.array(v, np.float32).astype(float) for i, v in rows if i is not None and v and None not in v}
    assert set(got) == set(expected)
    hits = 0
    for q, found in got.items():
        assert [k for k, _, _ in found] == list(range(1, 21))
        assert [(-s, i) for _, i, s in found] == sorted((-s, i) for _, i, s in found)
        assert all(abs(s - float((vectors[i] * vectors[q]).sum())) < 1e-9 for _, i, s in found)
        hits += len({i for _, i, _ in found} & set(expected[q]))
    assert hits / (20 * len(got)) >= 0.95


def test_few_vectors_and_none(spark):
    prepare(spark)
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (7, [0.0, 1.0]), (8, [1.0, 0.0]), (8, [1.0, 0.0])]
    frame = spark.createDataFrame([(*x, 0) for x in rows], SCHEMA)
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in A.nearest(frame).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 8, 1.0), (0, 2, 20, 0.5), (0, 3, 7, 0.0), (20, 1, 0, 0.5), (20, 2, 7, 0.5), (20, 3, 8, 0.5)]
    assert A.nearest(frame.where("false")).count() == 0
    assert A.nearest(frame.where("vec_id = 7")).count() == 0


def test_a_scan_gives_up_little():
    r = np.random.default_rng(0)
    x = r.normal(size=(3000, 40))
    space = A.Space(x, np.arange(3000), 3000, float(np.linalg.norm(x, axis=1).max()))
    c, q = space.candidates(x), space.queries(x[:60])
    dist = ((q[:, None] - c[None]) ** 2).sum(axis=2)
    bound = np.sort(dist, axis=1)[:, 20] * 1.00001
    qi, xi = A.scan(c, q, bound.astype(np.float32))
    within = dist <= bound[:, None]
    assert within[qi, xi].all() or dist[qi, xi].max() <= bound.max() * 1.001
    assert len(qi) >= 0.97 * within.sum()
