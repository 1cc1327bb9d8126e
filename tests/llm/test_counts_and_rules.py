"""Quality rules against plain Python; thresholds; edge cases."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from modelferry.llm import quality_rules as Q
from modelferry.llm.common import chunks, prepare


def plain(text):
    t = (text or "").encode()
    words = t.split()
    lines, seen, dup = t.split(b"\n"), set(), 0
    for line in lines:
        if line.split():
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    count = Counter(grams)
    covered = {j for i, g in enumerate(grams) if count[g] > 1 for j in range(i, i + 5)}
    return (len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered))


TEXTS = [
    None, "", " ", "\n\n", "a", "ab\n", "é à b \x0b c", "x y z\nx y z\n x y z", "a b c d e a b c d e", "a " * 30,
    "# * $ %\n# * $ %", "one\r\ntwo\r\none\r\n", "\n".join(["line one is here"] * 4), "w" * 5000, "\t|<>|&\n", "a b c d e f " * 300,
    "日本 語 テキスト\n日本 語 テキスト",
]


@pytest.mark.parametrize("most", [1, 40, 1 << 20])
def test_counts_equal_plain(most):
    import pyarrow as pa

    got = []
    for _, data, bounds in chunks(pa.array(TEXTS, pa.string()), most):
        m = Q.measure(data, bounds, None)
        got += list(zip(*(m[k].tolist() for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))))
    assert got == [plain(t) for t in TEXTS]


def test_ratio_equals_plain():
    import pyarrow as pa

    ratios = np.random.default_rng(1).normal(size=Q.BUCKETS).astype(np.float32)
    for t in TEXTS:
        data = (t or "").encode()
        grams = [data[i:i + Q.GRAM] for i in range(len(data) - Q.GRAM + 1)]
        hashed = [(int.from_bytes(g, "big") * 0x9E3779B97F4A7C15 % (1 << 64)) >> 48 for g in grams]
        expected = float(np.mean([float(ratios[h]) for h in hashed])) if hashed else 0.0
        for around in ([t], ["ab", t, "", "xyz"]):
            out = [v for _, d, b in chunks(pa.array(around, pa.string())) for v in Q.measure(d, b, ratios)["llr"]]
            assert math.isclose(out[around.index(t)], expected, abs_tol=1e-6)


def test_threshold_keeps_good_ones():
    good, bad = np.linspace(0, 1, 1000), np.linspace(-1, 0.5, 500)
    cut = Q.best_threshold(good, bad)
    assert (good < cut).mean() <= Q.LOSS and (bad < cut).mean() > 0.6
    assert Q.best_threshold(good, np.array([])) == -math.inf
    assert -1 < Q.best_threshold(good, np.full(9, -1.0)) < 0


def test_counted_scores_give_the_threshold_of_all(spark):
    rng = np.random.default_rng(3)
    good, bad = np.round(rng.normal(0.5, 0.3, 5000), 2), np.round(rng.normal(-0.5, 0.5, 3000), 2)
    (g, n), (b, m) = (np.unique(x, return_counts=True) for x in (good, bad))
    cut = Q.best_threshold(good, bad, 0.05)
    assert cut == Q.best_threshold(g, b, 0.05, n, m) and (good < cut).mean() <= 0.05 and (bad < cut).mean() > 0.4


def test_every_label_counts(spark):
    """More labelled documents of a class than any bound there was."""
    prepare(spark)
    n = 20_500
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality")).unionByName(
        docs.where("doc_id < 100").select("doc_id", F.lit(0).alias("quality")))
    labelled = Q.labelled_sample(labels)
    counts = Q.bucket_counts(docs, labelled)
    assert labelled.count() == n
    grams = lambda start: sum(len(f"text {i}") - Q.GRAM + 1 for i in range(start, n))
    assert counts.sum(axis=1).tolist() == [grams(0), grams(100)]
    found = Q.score_counts(docs, labelled, Q.log_ratios(counts)).groupBy("sample_quality").agg(F.sum("n").alias("n")).collect()
    assert {r.sample_quality: r.n for r in found} == {1: n - 100, 0: 100}


def test_verdicts_take_effect_and_keep_columns(spark):
    prepare(spark)
    fine = [(i, f"the quick brown fox number {i} jumps over lazy dogs and cats near river {i * 7}", "s", i) for i in range(60)]
    junk = [(100 + i, " | ".join(f"w{i}{j}###" for j in range(20)), "s", i) for i in range(60)]
    odd = [(None, None, None, 1), (1, "", "s", 1), (5, fine[5][1], "s", 1)]
    docs = spark.createDataFrame(fine + junk + odd, "doc_id long, text string, source string, rules int")
    labels = spark.createDataFrame(
        [(i, 1, 0) for i in range(40)] + [(100 + i, 0, 0) for i in range(40)] + [(None, 1, 0), (3, 1, 0)],
        "doc_id long, quality int, toxic int")
    rows = Q.judge(docs, labels, "verdict").select("doc_id", "verdict.*").collect()
    kept = Counter((r.doc_id is not None and r.doc_id < 100 and r.n_words > 0, r.kept) for r in rows)
    assert len(rows) == docs.count()
    assert kept[(True, True)] == 61 and kept[(False, True)] == 0
    none = labels.where("false")
    assert all(r.kept != r.base_failed for r in Q.judge(docs.drop("rules"), none).select("rules.*").collect())
    assert Q.judge(docs.drop("rules").where("false"), labels).count() == 0


def test_clashing_columns_and_repeated_ids(spark):
    prepare(spark)
    docs = spark.createDataFrame(
        [(i % 5, " ".join(f"word{i}x{j}" for j in range(40)), i, "mine", i) for i in range(20)] + [(7, None, None, None, None)],
        "doc_id long, text string, rules int, `q` string, row int")
    labels = spark.createDataFrame([(i, i % 2) for i in range(5)], "doc_id long, quality int")
    with pytest.raises(ValueError):
        Q.judge(docs, labels)
    kept = Q.keep(docs, labels)
    assert kept.columns == docs.columns and kept.exceptAll(docs).count() == 0
    assert {r.q for r in kept.collect()} == {"mine"}
    # Four rows of an id are one sample.
    assert Q.labelled_sample(labels).count() == 5


def test_a_long_text(spark):
    prepare(spark)
    text = " ".join(f"w{i}" for i in range(300_000)) + "\n#$% é"
    docs = spark.createDataFrame([(1, text), (2, "a b")], "doc_id long, text string")
    r = {x.doc_id: x for x in Q.judge(docs, spark.createDataFrame([], "doc_id long, quality int")).select("doc_id", "rules.*").collect()}[1]
    assert (r.n_words, r.n_symbols, r.n_repeat_words, r.kept) == (300_002, 3, 0, True)
    assert r.word_chars == sum(len(w) for w in text.split())
