"""SimHash against all pairs; masks; hot buckets."""

import itertools
import random

import numpy as np
import pytest
import xxhash

from modelferry.llm import simhash_dedup as S
from modelferry.llm.common import prepare
from modelferry.llm.components import connected_components


def plain_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Smallest id by id, from all pairs."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (i, a), (j, b) in itertools.combinations(enumerate(prints), 2):
        if (a ^ b).bit_count() <= 3:
            root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def test_masks_cover_every_pair_within_the_radius():
    r = random.Random(1)
    for level in range(S.LEVELS):
        ms = S.masks(level)
        for _ in range(3000):
            x = sum(1 << i for i in r.sample(range(64), r.randint(0, 3)))
            assert any(m & x == 0 for m in ms)


def test_last_level_bounds_a_bucket():
    levels = [S.masks(level) for level in range(S.LEVELS)]
    free = max(64 - (a | b | c | d).bit_count() for a, b, c, d in itertools.product(*levels))
    assert 2 ** free <= S.BUCKET


def texts():
    r = random.Random(4)
    words = ["".join(r.choices("abcdefgh", k=r.randint(2, 6))) for _ in range(200)]
    out = [" ".join(r.choices(words, k=r.randint(0, 40))) for _ in range(60)]
    base = r.choices(words, k=120)
    for _ in range(40):
        t = list(base)
        for _ in range(r.randint(0, 2)):
            t[r.randrange(len(t))] = r.choice(words)
        out.append(" ".join(t))
    return out + [None, "", "  ", "one", "two words", "ONE", " ", out[0].upper(), out[3], "x y z " * 4000]


def test_prints_and_classes_equal_plain(spark):
    prepare(spark)
    rows = list(enumerate(texts()))
    prints = [plain_print(t) for _, t in rows]
    of = plain_components(prints)
    least = {}
    for i, c in enumerate(of):
        least.setdefault(c, i)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in S.classes(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert got == {i: (f"{p:016x}", least[c]) for i, (p, c) in enumerate(zip(prints, of))}


@pytest.mark.parametrize("bucket", [2, 16])
def test_hot_buckets_lose_no_link(spark, monkeypatch, bucket):
    prepare(spark)
    monkeypatch.setattr(S, "BUCKET", bucket)
    r = random.Random(bucket)
    base = [r.getrandbits(64) for _ in range(5)]
    prints = sorted({b ^ sum(1 << i for i in set(r.choices(range(64), k=r.randint(0, 3)))) for b in base for _ in range(80)})
    frame = spark.createDataFrame([(S._signed(p),) for p in prints], "fp long")
    nodes = {x.node: x.component for x in connected_components(S.fingerprint_links(frame)).collect()}
    groups, expected = {}, {}
    for p, c in zip(prints, plain_components(prints)):
        expected.setdefault(c, set()).add(p)
        groups.setdefault(nodes.get(S._signed(p), S._signed(p)), set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_components_of_a_long_chain(spark):
    n = 70
    order = list(np.random.default_rng(2).permutation(n))
    edges = spark.createDataFrame([(int(order[i]), int(order[i + 1])) for i in range(n - 1)] + [(500, 400), (400, 500), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(n)}, 400: 400, 500: 400}
    assert connected_components(edges.where("false")).count() == 0


def test_one_of_each_group_stays(spark):
    prepare(spark)
    long = " ".join(f"word{i}" for i in range(50))
    rows = [(4, long, 1), (2, long, 2), (2, long, 3), (9, "something else entirely here", 4), (None, "only null ids have this text", 5),
            (None, "only null ids have this text", 6), (7, None, 7), (8, "", 8), (None, long, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = S.one_of_each(docs)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted(
        [(2, long), (9, rows[3][1]), (None, rows[4][1]), (7, None)], key=repr)
    assert S.one_of_each(docs.where("false")).count() == 0
