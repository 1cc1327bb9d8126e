"""Mixing against its target, and sharding laws and shuffles."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from modelferry.llm import mixing as M
from modelferry.llm import sharding as S
from modelferry.llm.common import prepare


def corpus(spark):
    rows = []
    for source, n in (("big", 300), ("mid", 60), ("small", 20), (None, 5)):
        rows += [(len(rows) + i, source, "w " * ((i * 7) % 23 + 1), 0) for i in range(n)]
    rows += [(0, "big", rows[0][2], 0), (None, "mid", None, 0), (None, "mid", None, 0), (9999, "small", "", 0)]
    return spark.createDataFrame(rows, "doc_id long, source string, text string, tokens int")


def test_tokens(spark):
    texts = [None, "", " ", "a", " a ", "a\tb\n c", "\x0ba", "é ñ"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").select(
        "i", M.tokens(M.F.col("text")).alias("n")).collect()
    assert {r.i: r.n for r in rows} == {i: len((t or "").encode().split()) + 1 for i, t in enumerate(texts)}


def test_every_row_stays_and_small_sources_repeat(spark):
    prepare(spark)
    docs = corpus(spark)
    rows = M.order(docs).collect()
    tokens = defaultdict(int)
    for r in docs.collect():
        tokens[r.source] += len((r.text or "").split()) + 1
    got = defaultdict(int)
    for r in rows:
        got[r.source] += r.tokens
    passes = {s: got[s] / tokens[s] for s in tokens}
    assert math.isclose(passes["big"], 1) and max(passes.values()) <= 2 + 25 / min(tokens.values())
    order = sorted(tokens, key=tokens.get)
    assert all(passes[a] >= passes[b] - 0.05 for a, b in zip(order, order[1:]))
    # The first pass holds every row once.
    assert Counter((r.doc_id, r.source) for r in rows if r.pass_no == 0) == Counter((r.doc_id, r.source) for r in docs.collect())
    places = defaultdict(list)
    for r in rows:
        places[(r.source, r.pass_no, r.block)].append(r.place)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    kept = M.mixed(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows)


@pytest.mark.parametrize("share", [0.6, 0.9])
def test_entropy_target(spark, share):
    docs = corpus(spark)
    sized = docs.select("source", M.tokens(M.F.col("text")).alias("tokens"))
    rows = M.source_weights(sized, M.Target(repeats=None, entropy=share * math.log(4))).collect()
    p = np.array([r.weight for r in rows])
    assert math.isclose(p.sum(), 1, rel_tol=1e-9)
    assert math.isclose(-(p * np.log(p)).sum(), share * math.log(4), rel_tol=1e-6)


def test_a_budget_cuts_at_a_document(spark):
    docs = corpus(spark)
    rows = M.order(docs, M.Target(repeats=3, budget=1500)).collect()
    weights = {r.source: r.budget for r in M.source_weights(
        docs.select("source", M.tokens(M.F.col("text")).alias("tokens")), M.Target(repeats=3, budget=1500)).collect()}
    got = defaultdict(int)
    for r in rows:
        got[r.source] += r.tokens
    assert all(weights[s] <= got[s] < weights[s] + 25 for s in weights)


def test_no_documents(spark):
    prepare(spark)
    assert M.order(corpus(spark).where("false")).count() == 0
    assert S.shard(corpus(spark).where("false")).count() == 0
    with pytest.raises(ValueError):
        M.Target(repeats=None)
    with pytest.raises(ValueError):
        M.Target(repeats=0.5)


def test_shards(spark, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(S, "BUCKET_ROWS", 20)
    docs = corpus(spark).unionByName(corpus(spark).where("doc_id = 5").crossJoin(spark.range(90)).drop("id"))
    rows = S.shard(docs, 7).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 7) and r.law == "key"
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    of = defaultdict(set)
    for r in rows:
        of[r.doc_id].add((r.shard, r.grown_shard))
    assert all(len(s) == 1 for s in of.values())
    again = {(r.doc_id, r.shard) for r in S.shard(docs.repartition(3), 8).collect()}
    assert again == {(r.doc_id, r.grown_shard) for r in rows}
    assert sorted(map(repr, S.shard(docs.repartition(5), 7).collect())) == sorted(map(repr, rows))


def test_fisher_yates_is_uniform():
    seen = Counter(tuple(S.fisher_yates(3, s)) for s in range(6000))
    assert len(seen) == 6 and min(seen.values()) > 850
    assert sorted(S.fisher_yates(1000, 1)) == list(range(1000))


def test_written_shards_hold_all_records(spark, folder):
    prepare(spark)
    docs = corpus(spark)
    S.write_shards(docs, folder + "/out", 5)
    back = spark.read.parquet(folder + "/out")
    assert Counter((r.doc_id, r.source, r.text, r.tokens) for r in back.collect()) == Counter(
        (r.doc_id, r.source, r.text, r.tokens) for r in docs.collect())
    expected = {(r.doc_id, r.shard) for r in S.shard(docs, 5).collect()}
    assert {(r.doc_id, r.shard) for r in back.collect()} == expected


def test_slots_are_those_of_a_plain_shuffle(spark, monkeypatch):
    """Buckets by draw, Fisher-Yates in each, one behind the other; repeated rows draw by their number."""
    prepare(spark)
    monkeypatch.setattr(S, "BUCKET_ROWS", 20)
    docs = corpus(spark).unionByName(corpus(spark).where("doc_id = 5").crossJoin(spark.range(90)).drop("id"))
    shards = 4
    now, grown = S.scores(shards)
    hashed = docs.select("doc_id", "source", "text", now.alias("shard"), grown.alias("grown"), S.F.xxhash64(*docs.columns).alias("row"))
    copies, rows = Counter(), []
    for r in hashed.collect():
        copies[r.row] += 1
        rows.append((r.shard, r.row, copies[r.row], r.doc_id, r.source, r.text))
    pairs = spark.createDataFrame([(r[1], r[2]) for r in rows], "row long, copy long").distinct()
    draws = {(r.row, r.copy): r.draw for r in pairs.select(
        "row", "copy", S.F.xxhash64(S.F.lit(S.SEED + 1), "row", "copy").alias("draw")).collect()}
    of = Counter(r[0] for r in rows)
    buckets = defaultdict(list)
    for r in rows:
        draw = draws[r[1], r[2]]
        buckets[r[0], draw % -(-of[r[0]] // 20)].append((draw, *r[1:]))
    expected, at = [], Counter()
    for (shard, bucket), inside in sorted(buckets.items()):
        inside.sort(key=lambda r: r[:3])
        for place, r in zip(S.fisher_yates(len(inside), [S.SEED, shard, bucket]), inside):
            expected.append((shard, at[shard] + int(place), r[3], r[4], r[5]))
        at[shard] += len(inside)
    assert max(b for _, b in buckets) > 1
    got = S.write_shards(docs, S.scratch_path(spark, "plain"), shards)
    assert sorted(map(repr, expected)) == sorted(repr((r.shard, r.slot, r.doc_id, r.source, r.text)) for r in got.collect())
    # The copies of one row do not share a bucket.
    assert len({k for k, v in buckets.items() if any(r[3] == 5 for r in v)}) > 3


def test_shards_keep_columns_with_working_names(spark):
    prepare(spark)
    docs = spark.createDataFrame(
        [(i, "t" * i, i, 2 * i, [i], (i, "x")) for i in range(9)] + [(None, None, None, None, None, None)] * 3,
        "doc_id int, text string, shard int, slot long, n array<int>, __row struct<a: int, b: string>")
    got = S.write_shards(docs, S.scratch_path(spark, "clash"), 3)
    assert {"shard_own", "slot_own", "n_own", "__row_own", "shard", "slot"} <= set(got.columns)
    back = got.select("doc_id", "text", "shard_own", "slot_own", "n_own", "__row_own").collect()
    assert Counter(map(repr, map(tuple, back))) == Counter(map(repr, map(tuple, docs.collect())))
    empty = S.write_shards(docs.where("doc_id > 99"), S.scratch_path(spark, "empty"), 3)
    assert empty.count() == 0 and "slot" in empty.columns
