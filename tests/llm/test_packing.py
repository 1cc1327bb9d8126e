"""Packing against best-fit decreasing one piece at a time, and tokens against the tokenizer file."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from modelferry.llm import best_fit_packing as B
from modelferry.llm.common import prepare


def one_by_one(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = [(r, i) for i, r in enumerate(rooms) if r >= n]
        if fit:
            rooms[min(fit)[1]] -= n
        else:
            rooms.append(capacity - n)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_best_fit_decreasing(seed):
    r = random.Random(seed)
    capacity = r.choice([1, 7, 16, 50, 100])
    lengths = [r.randint(1, capacity) for _ in range(r.randint(1, 400))]
    counts = Counter(lengths)
    moves = B.plan(counts, capacity)
    used = defaultdict(list)
    for length, n in counts.items():
        of = moves[length]
        for k in range(n):
            first, sequence, each, offset = [m for m in of if m[0] <= k][-1]
            used[sequence + (k - first) // each].append((offset + (k - first) % each * length, length))
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
    assert sorted(capacity - sum(n for _, n in p) for p in used.values()) == one_by_one(lengths, capacity)


def test_tree_finds_the_tightest():
    r, tree, open_ = random.Random(3), B.RoomTree(100), Counter()
    for _ in range(2000):
        room = r.randint(0, 100)
        if r.random() < 0.4 and open_[room]:
            tree.add(room, -1)
            open_[room] -= 1
        else:
            tree.add(room, 1)
            open_[room] += 1
        least = r.randint(0, 100)
        assert tree.tightest(least) == min((k for k, n in open_.items() if n and k >= least), default=None)


TEXTS = [None, "", "a", "Hello, wörld!  <|endoftext|> x", "日本語" * 50, " \n\t ", "x" * 3000, "the cat " * 2000, "the cat " * 2000, "12345 67890"]


def test_ids_and_pieces(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    prepare(spark)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = spark.createDataFrame([(i if i != 2 else None, t, i) for i, t in enumerate(TEXTS)], "doc_id long, text string, length int")
    rows = B.pack(docs).collect()
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    for i, t in enumerate(TEXTS):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        got = sorted(by_doc[i if i != 2 else None], key=lambda r: r.piece)
        assert [r.piece for r in got] == list(range(len(got))) and sum(r.length for r in got) == len(ids)
        assert all(r.length == 1024 for r in got[1:]) and 1 <= got[0].length <= 1024
        for r in got:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes())
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        assert sum(n for _, n in places) <= 1024
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(places), sorted(places)[1:])) and min(places)[0] == 0
    assert len(sequences) == len(one_by_one([r.length for r in rows], 1024))
    assert B.pack(docs.where("false")).count() == 0
