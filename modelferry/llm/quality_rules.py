"""Quality rules: plain counts, then a log-likelihood ratio of hashed n-grams.

Each text is read as overlapping byte n-grams, hashed into ``BUCKETS`` buckets. Two
multinomials over the buckets are fitted: the raw corpus (every document, whole) and the
trusted target (documents labelled good). A document's score is the mean of
log P(target) - log P(raw) over its n-grams, so length does not count. Every document at
or above the threshold is kept.

Nothing is fitted on a sample: the raw counts cover all documents, the target counts every document labelled good, the
threshold the scores of every labelled document, counted by steps of ``1 / STEPS``. The threshold is deterministic: the lowest
score that separates good and bad best, but never above the ``LOSS`` quantile of the good
ones, so that clean documents stay. Without labels of both classes nothing is rejected by score.

Null text counts as empty: no words, so it fails the base rules. Texts shorter
than an n-gram score 0; long texts are read whole, one at a time above ``CHUNK_BYTES``. A score that equals the threshold is kept.
Repeated rows each get their own verdict; other columns are left alone. An empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelferry.llm.common import chunks, free, mixed, per_text, run_hashes, words_of

GRAM = 5
BUCKETS = 1 << 16
LOSS = 0.002
# Steps of a score that the threshold tells apart; scores lie within about 16 of zero, so their counts are few.
STEPS = 10_000
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
RULES = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("word_chars", T.LongType()),
    T.StructField("n_symbols", T.LongType()), T.StructField("n_dup_lines", T.LongType()),
    T.StructField("n_repeat_words", T.LongType()), T.StructField("llr", T.DoubleType()),
])


def gram_buckets(data: np.ndarray) -> np.ndarray:
    """The bucket of the n-gram that starts at each byte but the last few."""
    n = len(data) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    value = np.zeros(n, np.uint64)
    for i in range(GRAM):
        value = (value << np.uint64(8)) | data[i:i + n]
    return ((value * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 16)).astype(np.int64)


def _inside(bounds: np.ndarray, n: int) -> np.ndarray:
    """Which of n n-grams do not cross the end of a text."""
    ok = np.ones(n + GRAM, bool)
    for i in range(1, GRAM):
        # From a short text this reaches into the one before; those grams cross its end as well.
        before = bounds[1:] - i
        ok[before[before >= 0]] = False
    return ok[:n]


def _repeated_earlier(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values were seen before in the same text; which occur twice or more in it."""
    keyed = mixed(hashes + mixed(owner.astype(np.uint64)))
    order = np.argsort(keyed, kind="stable")
    same = keyed[order][1:] == keyed[order][:-1]
    later, any_ = np.zeros(len(keyed), bool), np.zeros(len(keyed), bool)
    later[order[1:][same]] = True
    any_[order[1:][same]] = True
    any_[order[:-1][same]] = True
    return later, any_


def mean_ratios(data: np.ndarray, bounds: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    """The mean log ratio of texts that lie end to end."""
    buckets = gram_buckets(data)
    ok = _inside(bounds, len(buckets))
    sums = np.zeros(len(data) + 1)
    counts = np.zeros(len(data) + 1)
    np.cumsum(np.where(ok, ratios[buckets], 0.0), out=sums[1:len(buckets) + 1])
    np.cumsum(ok, out=counts[1:len(buckets) + 1])
    sums[len(buckets) + 1:] = sums[len(buckets)]
    counts[len(buckets) + 1:] = counts[len(buckets)]
    grams = counts[bounds[1:]] - counts[bounds[:-1]]
    return np.where(grams > 0, (sums[bounds[1:]] - sums[bounds[:-1]]) / np.maximum(grams, 1), 0.0)


def measure(data: np.ndarray, bounds: np.ndarray, ratios: np.ndarray | None) -> dict[str, np.ndarray]:
    """The rule counts and mean log ratio of texts that lie end to end."""
    n = len(bounds) - 1
    starts, ends, owner = words_of(data, bounds)
    n_words = np.bincount(owner, minlength=n)
    word_flags = np.zeros(len(data) + 1, np.int8)
    word_flags[starts] += 1
    word_flags[ends] -= 1
    letters = np.cumsum(word_flags[:-1], dtype=np.int8).astype(bool) & ((data & 0xC0) != 0x80)

    # Lines: between line feeds and text bounds; only those with a word count.
    feeds = np.flatnonzero(data == 0x0A)
    begins = np.unique(np.concatenate([bounds[:-1], feeds + 1]))
    begins = begins[begins < len(data)]
    line_ends = np.append(begins[1:], len(data))[:len(begins)]
    # A line does not hold its line feed.
    line_ends = line_ends - ((line_ends > begins) & (data[np.maximum(line_ends - 1, 0)] == 0x0A))
    with_word = np.searchsorted(starts, line_ends) > np.searchsorted(starts, begins)
    begins, line_ends = begins[with_word], line_ends[with_word]
    line_owner = np.searchsorted(bounds, begins, "right") - 1
    again, _ = _repeated_earlier(run_hashes(data, begins, line_ends), line_owner)

    repeat = np.zeros(n, np.int64)
    if len(starts) >= WINDOW:
        words = run_hashes(data, starts, ends)
        k = len(words) - WINDOW + 1
        window = np.zeros(k, np.uint64)
        for i in range(WINDOW):
            window = mixed(window + words[i:i + k])
        whole = np.flatnonzero(owner[:k] == owner[WINDOW - 1:])
        _, twice = _repeated_earlier(window[whole], owner[whole])
        cover = np.zeros(len(words) + 1, np.int64)
        np.add.at(cover, whole[twice], 1)
        np.add.at(cover, whole[twice] + WINDOW, -1)
        repeat = np.bincount(owner[np.cumsum(cover[:-1]) > 0], minlength=n)

    llr = np.zeros(n) if ratios is None else mean_ratios(data, bounds, ratios)
    return {
        "n_words": n_words, "word_chars": per_text(letters, bounds),
        "n_symbols": per_text(_SYMBOL[data], bounds),
        "n_dup_lines": np.bincount(line_owner[again], minlength=n), "n_repeat_words": repeat,
        "llr": np.round(llr, 9),
    }


def measured(text: Column, ratios: np.ndarray | None) -> Column:
    """The rule counts of a text as one struct column."""

    @F.pandas_udf(RULES)
    def run(texts: pd.Series) -> pd.DataFrame:
        parts = [measure(data, bounds, ratios) for _, data, bounds in chunks(pa.array(texts, pa.string()))]
        if not parts:
            return pd.DataFrame({f.name: [] for f in RULES})
        return pd.DataFrame({k: np.concatenate([p[k] for p in parts]) for k in parts[0]})

    return run(text)


def scores(text: Column, ratios: np.ndarray) -> Column:
    """The mean log ratio of a text alone, as :func:`measured` gives it."""

    @F.pandas_udf(T.DoubleType())
    def run(texts: pd.Series) -> pd.Series:
        parts = [np.round(mean_ratios(data, bounds, ratios), 9) for _, data, bounds in chunks(pa.array(texts, pa.string()))]
        return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return run(text)


def labelled_sample(labels: DataFrame) -> DataFrame:
    """Every labelled id and its class, bad where labels differ."""
    return labels.where("doc_id is not null and quality in (0, 1)").select(
        F.col("doc_id").cast("long").alias("sample_id"), F.col("quality").cast("int").alias("sample_quality")
    ).groupBy("sample_id").agg(F.min("sample_quality").alias("sample_quality"))


def bucket_counts(docs: DataFrame, sample: DataFrame) -> np.ndarray:
    """Counts by bucket: row 0 of all documents, row 1 of the trusted ones.

    A task sends one row a bucket, so what reaches the driver is bounded by the buckets. Texts and ids are dealt
    by id at any size, as labels grow with the documents and would not stay small enough to broadcast.
    """
    trusted = sample.where("sample_quality = 1").select("sample_id", F.lit(True).alias("trusted"))
    marked = docs.select("doc_id", "text").join(
        trusted.hint("merge"), F.col("doc_id") == F.col("sample_id"), "left"
    ).select("text", F.coalesce("trusted", F.lit(False)).alias("trusted"))

    def count(batches):
        total = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            good = np.array(batch.column("trusted").to_pylist(), bool)
            for first, data, bounds in chunks(batch.column("text")):
                buckets = gram_buckets(data)
                ok = _inside(bounds, len(buckets))
                owner = np.repeat(good[first:first + len(bounds) - 1], np.diff(bounds))[:len(buckets)]
                total[0] += np.bincount(buckets[ok], minlength=BUCKETS)
                total[1] += np.bincount(buckets[ok & owner], minlength=BUCKETS)
        seen = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen), pa.array(total[0][seen]), pa.array(total[1][seen])], names=["bucket", "raw", "target"])

    rows = marked.mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    out = np.zeros((2, BUCKETS), np.int64)
    for bucket, n_raw, n_target in rows.collect():
        out[:, bucket] = n_raw, n_target
    return out


def log_ratios(counts: np.ndarray) -> np.ndarray:
    """log P(target) - log P(raw) by bucket, with one added to each count."""
    p = (counts + 1.0) / (counts.sum(axis=1, keepdims=True) + BUCKETS)
    return (np.log(p[1]) - np.log(p[0])).astype(np.float32)


def best_threshold(
    good: np.ndarray, bad: np.ndarray, loss: float = LOSS, n_good: np.ndarray | None = None, n_bad: np.ndarray | None = None,
) -> float:
    """The cut that separates best, at most the ``loss`` quantile of the good scores. ``n_good`` and ``n_bad`` say how often each score occurs."""
    if not len(good) or not len(bad):
        return float("-inf")
    good, more_good = _counted(good, n_good)
    bad, more_bad = _counted(bad, n_bad)
    cap = float(good[np.searchsorted(more_good[1:], int(loss * (more_good[-1] - 1)), "right")])
    cuts = good[good <= cap]
    # Rejected bad ones count for, rejected good ones against; ties go to the lower cut.
    gain = more_bad[np.searchsorted(bad, cuts)] / more_bad[-1] - more_good[np.searchsorted(good, cuts)] / more_good[-1]
    cut = float(cuts[int(np.argmax(gain))])
    # Half-way to the bad ones below, so that good ones a little under the labelled ones stay.
    below = bad[bad < cut]
    return (cut + float(below.max())) / 2 if len(below) else float("-inf")


def _counted(values: np.ndarray, n: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and how many lie below each and in all."""
    distinct, place = np.unique(values, return_inverse=True)
    return distinct, np.append(0, np.cumsum(np.bincount(place, n).astype(np.int64)))


def score_counts(docs: DataFrame, labelled: DataFrame, ratios: np.ndarray) -> DataFrame:
    """How many labelled documents of each class (``sample_quality``) have a score of that ``step``.

    All are scored where they lie, and scores, not texts, meet the labels. Of rows that share an id the lowest score counts.
    """
    scored = docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("sample_id"), scores(F.col("text"), ratios).alias("llr")
    ).groupBy("sample_id").agg(F.min("llr").alias("llr"))
    return scored.join(labelled, "sample_id").groupBy(
        "sample_quality", F.floor(F.col("llr") * STEPS).alias("step")).agg(F.count(F.lit(1)).alias("n"))


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """Log ratios by bucket and the threshold."""
    labelled = labelled_sample(labels)
    ratios = log_ratios(bucket_counts(docs, labelled))
    rows = score_counts(docs, labelled, ratios).collect()
    found = [np.array([(r.step / STEPS, r.n) for r in rows if r.sample_quality == q]).reshape(-1, 2) for q in (1, 0)]
    return ratios, best_threshold(found[0][:, 0], found[1][:, 0], n_good=found[0][:, 1], n_bad=found[1][:, 1])


def judge(docs: DataFrame, labels: DataFrame, name: str = "rules") -> DataFrame:
    """All columns of the documents and one struct ``name``: the counts, base_failed, kept.

    ``name`` must not be a column of the documents; ``common.free`` finds one that is not.
    """
    if free(name, docs) != name:
        raise ValueError(f"the documents have a column {name} already")
    ratios, threshold = fit(docs, labels)
    # The row goes along whole, so no column of it clashes with a working one.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), measured(F.col("text"), ratios).alias("q"))
    q = F.col("q")
    failed = (q["n_words"] < MIN_WORDS) | (100 * q["n_repeat_words"] > MAX_REPEAT_PERCENT * q["n_words"])
    return rows.select(
        *[F.col("row")[c].alias(c) for c in docs.columns],
        F.struct(
            *[q[f.name].alias(f.name) for f in RULES], failed.alias("base_failed"),
            (~failed & (q["llr"] >= F.lit(threshold))).alias("kept"),
        ).alias(name),
    )


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the rules keep, with their columns, whatever these are called."""
    name = free("rules", docs)
    return judge(docs, labels, name).where(F.col(name)["kept"]).select(*[f"`{c}`" for c in docs.columns])
