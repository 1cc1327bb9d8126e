"""Vector codes against plain Lloyd rounds, and cover trees against their definition."""

import hashlib
import math

import numpy as np
import pytest

from modelferry.llm import cover_tree_codes as C
from modelferry.llm.common import prepare


def plain(rows, entries=256, rounds=4):
    """Lloyd rounds over all vectors, every distance worked out: rows (vec_id, label, code, error), and the hash."""
    rows = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    sizes = [len(r[1]) for r in rows]
    size = max(set(sizes), key=lambda s: (sizes.count(s), s))
    rows = [(i, [math.floor(1024 * x) for x in e] + [0] * (-size % 4), label) for i, e, label in rows if len(e) == size]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    vectors = np.array([e for _, e, _ in rows], np.int64)
    parts = np.split(vectors, 4, axis=1)
    books = [p[:entries].copy() for p in parts]

    def nearest(points, book):
        far = np.array([((book - p) ** 2).sum(1) for p in points])
        return far.argmin(1), far.min(1)

    for _ in range(rounds):
        for points, book in zip(parts, books):
            of, _ = nearest(points, book)
            for j in set(of.tolist()):
                book[j] = [sum(column) // len(column) for column in zip(*points[of == j].tolist())]
    found = [nearest(p, b) for p, b in zip(parts, books)]
    text = ",".join(str(x) for b in books for x in b.reshape(-1).tolist())
    return [
        (i, label, "".join(f"{of[k]:02x}" for of, _ in found), int(sum(e[k] for _, e in found))) for k, (i, _, label) in enumerate(rows)
    ], hashlib.sha256(text.encode()).hexdigest()


def clustered(n, width, seed):
    r = np.random.default_rng(seed)
    return np.round(r.normal(size=(12, width))[r.integers(0, 12, n)] * 900 + r.normal(size=(n, width)) * 30).astype(np.int64)


@pytest.mark.parametrize("n,seed", [(1, 0), (2, 1), (300, 2), (900, 3)])
def test_tree_covers_separates_and_sums(n, seed):
    points = clustered(n, 4, seed)
    points = np.concatenate([points, points[: n // 3], np.repeat(points[:1], 20, axis=0)])
    tree = C.build(points)
    assert np.array_equal(tree.points[tree.rows], points)
    assert len(np.unique(tree.points, axis=0)) == len(tree.points)
    assert (tree.low[0], tree.high[0]) == (0, len(tree.points)) and tree.counts[-1] == len(points)
    for k in range(len(tree.low)):
        run = tree.points[tree.low[k]:tree.high[k]]
        far = np.sqrt(((run - run[0]) ** 2).sum(1))
        assert far.max() == pytest.approx(tree.radius[k])
        kids = range(tree.child[k], tree.child[k] + tree.children[k])
        if tree.children[k]:
            assert tree.low[kids[0]] == tree.low[k] and tree.high[kids[-1]] == tree.high[k]
            assert all(tree.high[a] == tree.low[a + 1] for a in list(kids)[:-1])
            assert all(tree.radius[c] <= tree.radius[k] / 2 for c in kids)
            centres = tree.points[tree.low[list(kids)]]
            for i, c in enumerate(centres):
                assert all(np.sqrt(((centres[:i] - c) ** 2).sum(1)) > tree.radius[k] / 2)
        else:
            assert len(run) == 1
    of_points = np.bincount(tree.rows, minlength=len(tree.points))
    assert np.array_equal(tree.counts, np.concatenate([[0], np.cumsum(of_points)]))
    assert np.array_equal(tree.sums[-1], points.sum(0))


@pytest.mark.parametrize("seed", range(6))
def test_whole_subtrees_go_where_their_points_go(seed):
    points = clustered(700, 5, seed)
    book = clustered(700, 5, seed)[::29].copy()
    book[5] = book[2]  # a tie: the lower number wins
    tree = C.build(points)
    far = ((points[:, None, :] - book[None]) ** 2).sum(2)
    of, error = C.codes(tree, book)
    assert np.array_equal(of, far.argmin(1)) and np.array_equal(error, far.min(1))
    sums, counts = C.sums_by_entry(tree, book)
    assert np.array_equal(counts, np.bincount(of, minlength=len(book)))
    assert all(np.array_equal(sums[j], points[of == j].sum(0)) for j in range(len(book)))


def test_few_nodes_are_opened_where_entries_are_apart():
    points = clustered(4000, 5, 1)
    book = C.build(points).points[[0]]
    while True:  # one entry a cluster
        far = ((points[:, None, :] - book[None]) ** 2).sum(2).min(1)
        if far.max() < 300 ** 2:
            break
        book = np.concatenate([book, points[[far.argmax()]]])
    tree = C.build(points)
    nodes, _, compared = C.assigned(tree, book)
    assert len(book) == 12 and compared < len(points) * len(book) * 0.05
    assert (tree.high[nodes] - tree.low[nodes]).max() > 100


def test_ties_on_a_grid():
    grid = np.array([[x, y] for x in range(0, 40, 2) for y in range(0, 40, 2)], np.int64)
    book = np.array([[x, y] for x in range(1, 40, 4) for y in range(1, 40, 4)], np.int64)
    of, error = C.codes(C.build(grid), book)
    far = ((grid[:, None, :] - book[None]) ** 2).sum(2)
    assert np.array_equal(of, far.argmin(1)) and np.array_equal(error, far.min(1))


def test_large_components_stay_exact_or_fail():
    points = np.array([[1 << 29, -(1 << 29)], [(1 << 29) - 1, 5], [3, 4]], np.int64)
    of, error = C.codes(C.build(points), points[:2])
    far = [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, q)) for q in points[:2]] for p in points]
    assert of.tolist() == [f.index(min(f)) for f in far] and error.tolist() == [min(f) for f in far]
    with pytest.raises(OverflowError):
        C.build(np.array([[1 << 31, 0], [0, 0]], np.int64))


ODD = [
    (-1, None, 1), (-2, [], 1), (-3, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1), (-4, [1.0, float("nan")] * 3, 1), (-5, [float("inf")] * 6, 1),
    (-6, [1.0, 2.0, 3.0], 1), (None, [0.5] * 6, None), (3, [-0.0001, 0.0, 1.5, -2.25, 7.0, 0.1], None), (3, [9.0] * 6, 2), (3, [9.0] * 6, 2),
]


def made(rows, spark, entries=256):
    prepare(spark)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("v", df_note()).repartition(3)
    coded, books = C.compress(df, entries=entries)
    return coded, C.digest(books)


def df_note():
    from pyspark.sql import functions as F

    return F.lit("a column whose name is used inside")


@pytest.mark.parametrize("entries", [256, 7, 1])
def test_codes_equal_plain_rounds(spark, entries):
    r = np.random.default_rng(4)
    rows = ODD + [(10 + i, (r.normal(size=6) * (1 + i % 3)).tolist(), i % 5) for i in range(400)]
    rows += [(1000 + i, [0.25] * 6, None) for i in range(500)]  # most rows are one vector
    coded, sha = made(rows, spark, entries)
    expected, expected_sha = plain(rows, entries)
    assert sha == expected_sha
    assert sorted(map(tuple, coded.collect()), key=repr) == sorted(expected, key=repr)
    by_label = {}
    for _, label, _, error in expected:
        by_label[label] = by_label.get(label, 0) + error
    got = C.with_label_errors(coded).collect()
    assert len(got) == len(expected) and all(x.label_error == by_label[x.label] for x in got)


def test_few_and_no_vectors(spark):
    coded, sha = made(ODD, spark)
    expected, expected_sha = plain(ODD)
    assert sha == expected_sha and sorted(map(tuple, coded.collect()), key=repr) == sorted(expected, key=repr)
    coded, _ = made(ODD[:5], spark)
    assert coded.count() == 0 and C.with_label_errors(coded).count() == 0
    with pytest.raises(ValueError):
        C.compress(spark.createDataFrame([], "vec_id long, embedding array<double>, label int"), entries=257)


def test_query_equals_plain_rounds(spark):
    from modelferry.llm import queries

    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    expected, sha = plain(rows)
    sums = {}
    for _, label, _, error in expected:
        sums[label] = sums.get(label, 0) + error
    got = queries.op12_cover_tree_codes(spark, sf)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted((i, code, error, sums[label], sha) for i, label, code, error in expected)
