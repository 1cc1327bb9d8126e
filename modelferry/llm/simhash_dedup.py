"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint has 64 bits; two documents link when at most ``RADIUS`` (3) bits differ. Each
bit position gets a nonzero vector of 4 bits, and each of the 15 nonzero vectors v makes a mask of
the positions whose vector has an odd product with v. The vectors of 3 differing
positions span at most 3 of 4 dimensions, so some v is orthogonal to all of them: that
mask holds none of the differing bits, and the pair collides in its table. No pair
within the radius is lost, and every collision is checked for its true distance.

Equal fingerprints are one node, so copies never meet as pairs. In a bucket, links that
join its fingerprints are found without listing its pairs. A bucket with more than
``BUCKET`` fingerprints goes to a next level, where the positions get other vectors and
fingerprints must also agree under a second mask. Each mask leaves out under half of
the positions; after four levels at most ``2 ** 11`` fingerprints can share a bucket, at any size of input
(a test holds the masks to that).

Null or wordless text has fingerprint zero and links like any other. Rows with equal ids
share the component of their texts; null ids are ignored when the smallest id is taken. Other columns are left alone.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelferry.llm.common import raw, set_aside
from modelferry.llm.components import connected_components
from modelferry.session import written

RADIUS = 3
SHINGLE = 3
SEED = 42
BITS = 64
#: Fingerprints of a bucket that are compared in one task.
BUCKET = 2048
LEVELS = 4
#: Shingles that are counted at once.
BLOCK = 1 << 15


def fingerprint_of(text: bytes) -> int:
    """The fingerprint of one text as an unsigned number."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.append(0, ends[:-1] + 1)
    if len(words) > SHINGLE:
        starts, ends = starts[:1 - SHINGLE], ends[SHINGLE - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    ones = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), BLOCK):
        spans = zip(starts[at:at + BLOCK].tolist(), ends[at:at + BLOCK].tolist())
        hashes = np.array([digest(line[a:b], SEED) for a, b in spans], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view(np.uint64)[0])


@F.pandas_udf(T.LongType())
def fingerprints(texts: pd.Series) -> pd.Series:
    """Fingerprints as signed 64-bit numbers."""
    values = np.array([fingerprint_of(t) for t in raw(pa.array(texts, pa.string()))], np.uint64)
    return pd.Series(values.view(np.int64))


def hexadecimal(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def masks(level: int) -> list[int]:
    """15 masks over the 64 positions; each level deals the vectors anew, from its own seed."""
    order = np.random.default_rng([SEED, level]).permutation(BITS)
    vector = {int(p): 1 + k % 15 for k, p in enumerate(order)}
    return [sum(1 << p for p in range(BITS) if (vector[p] & v).bit_count() % 2) for v in range(1, 16)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _spread(rows: DataFrame, level: int) -> DataFrame:
    """One row for each fingerprint and mask; a bucket is a path of masks and the bits under all of them."""
    options = F.array(*[F.lit(_signed(m)) for m in masks(level)])
    return rows.select("fp", "seen", "path", F.posexplode(options).alias("v", "mask")).select(
        "fp", F.col("seen").bitwiseOR(F.col("mask")).alias("seen"), (F.col("path") * 16 + F.col("v") + 1).alias("path"),
    ).withColumn("key", F.col("fp").bitwiseAND(F.col("seen")))


def links_of(values: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all fingerprints of one bucket which a chain of steps within the radius joins.

    Breadth first: each fingerprint is compared once with those not yet reached.
    """
    rest, a, b = values, [], []
    while len(rest) > 1:
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            x, front = front[0], front[1:]
            near = np.bitwise_count(rest ^ x) <= radius
            if near.any():
                found = rest[near]
                a.append(np.full(len(found), x))
                b.append(found)
                front, rest = np.concatenate([front, found]), rest[~near]
    if not a:
        return values[:0], values[:0]
    return np.concatenate(a), np.concatenate(b)


def _bucket_links(batches):
    """Links of the buckets in a partition that is sorted by bucket."""
    held: list[np.ndarray] = []
    last = None

    def links(keys: np.ndarray):
        fps = np.unique(keys[:, 2]).view(np.uint64)
        return links_of(fps)

    def out(done: list[np.ndarray]):
        rows = np.concatenate(done)
        new = np.any(rows[1:, :2] != rows[:-1, :2], axis=1)
        cuts = np.concatenate([[0], np.flatnonzero(new) + 1, [len(rows)]])
        pairs = [links(rows[i:j]) for i, j in zip(cuts[:-1], cuts[1:]) if j - i > 1]
        a = np.concatenate([p[0] for p in pairs]) if pairs else np.zeros(0, np.uint64)
        b = np.concatenate([p[1] for p in pairs]) if pairs else np.zeros(0, np.uint64)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    for batch in batches:
        rows = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("path", "key", "fp")], axis=1)
        if not len(rows):
            continue
        last = rows[-1, :2]
        open_ = np.all(rows[:, :2] == last, axis=1)
        if open_.all() and held and np.all(held[-1][-1, :2] == last):
            held.append(rows)
            continue
        cut = int(np.argmax(open_))
        if cut or held:
            yield out([*held, rows[:cut]]) if cut else out(held)
        held = [rows[cut:]]
    if held:
        yield out(held)


def fingerprint_links(prints: DataFrame) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp``; they join what lies within the radius, in chains too."""
    rows = prints.select("fp", F.lit(0).cast("long").alias("seen"), F.lit(0).cast("long").alias("path"))
    found = None
    for level in range(LEVELS):
        spread = _spread(rows, level)
        sizes = spread.groupBy("path", "key").agg(F.count("*").alias("n")).where("n > 1")
        held = written(spread.join(sizes, ["path", "key"]), "buckets")
        small = held.where(F.col("n") <= BUCKET) if level < LEVELS - 1 else held
        # Buckets are small, so a partition holds many; a bucket never spans two.
        links = small.select("path", "key", "fp").repartition("path", "key").sortWithinPartitions(
            "path", "key").mapInArrow(_bucket_links, "a long, b long")
        found = links if found is None else found.unionByName(links)
        rows = held.where(F.col("n") > BUCKET).select("fp", "seen", "path")
        if level == LEVELS - 1 or rows.isEmpty():
            break
    return found


def components(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The documents with ``__fp``; their (id, fp) alone; (fp, root, component) of each fingerprint.

    root names the component by its smallest fingerprint, component by its smallest id.
    """
    marked = docs.withColumn("__fp", fingerprints(F.col("text")))
    narrow = written(marked.select(F.col("doc_id").alias("id"), F.col("__fp").alias("fp")), "prints")
    prints = written(narrow.groupBy("fp").agg(F.min("id").alias("least")), "prints")
    nodes = connected_components(fingerprint_links(prints))
    of = prints.join(nodes, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("root"))
    lowest = of.groupBy("root").agg(F.min("least").alias("component"))
    return marked, narrow, of.join(lowest, "root").select("fp", "root", "component", "least")


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, component_id of every row."""
    _, narrow, of = components(docs)
    return narrow.join(of, "fp").select(
        F.col("id").alias("doc_id"), hexadecimal(F.col("fp")).alias("fingerprint"),
        F.col("component").alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents that stay, with their own columns: of each component the row with the smallest id.

    Null ids come last. Where several rows hold that id, the one with the smallest fingerprint stays,
    then the smallest text hash.
    """
    rows = set_aside(docs, "__fp __stays __id")
    marked, _, of = components(rows)
    stays = of.groupBy("root").agg(F.min(F.struct(F.col("least").isNull(), "least", "fp")).alias("r")).select(
        F.col("r.fp").alias("__stays"), F.col("r.least").alias("__id"))
    own = [F.col(f"`{c}`") for c in rows.columns]
    # One row for each fingerprint that stays, but for rows that share their id.
    return marked.join(stays, (F.col("__fp") == F.col("__stays")) & F.col("doc_id").eqNullSafe(F.col("__id"))).groupBy(
        "__fp").agg(F.min_by(F.struct(*own), F.struct(F.xxhash64("text"), F.length("text"))).alias("row")).select("row.*").toDF(*docs.columns)
