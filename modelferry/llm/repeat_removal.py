"""Repeats across documents, by parsing texts at triggers of a rolling hash.

Every byte covered by a ``LENGTH``-byte string that also starts in a document with a smaller id
is removed. A rolling hash of ``GRAM`` bytes runs over each text, and the grams with the smallest value
of any ``LENGTH``-byte string are its triggers, so each such string holds one, at a place that the
string alone decides. Triggers cut a text into phrases; a phrase reaches as far around its
trigger as strings that hold it can: ``BEFORE`` bytes before, ``LENGTH`` from its start on. The work is done on phrases:

1. Grams: which triggers stand in two texts or more. All others cannot repeat and go.
2. Parse: each remaining phrase as (trigger, digest), with the smallest id that has it. A phrase
   that a smaller id has too is removed whole, in however many copies it comes.
3. Dictionary: where a trigger has different phrases, the suffixes of these phrases are brought into order to
   the depth of ``LENGTH`` bytes, and equal neighbours share their smallest id. Their bytes are compared, not only digests.
4. Marks go back to the texts by phrase.

Full suffix order is not needed, as ``LENGTH`` bounds the depth. Equal texts are one text with the
smallest of their ids; the other copies are removed whole. Texts lie in blocks of about ``BLOCK_BYTES``
in a bucketed table, so that steps read them without moving them again; what steps exchange is
pre-aggregated by block and packed. A trigger or phrase in a third of all texts is one entry a block.

Null text counts as empty. A null id counts as larger than any other. Rows with equal ids do not repeat one another.
Texts under ``LENGTH`` bytes keep everything.
"""

from __future__ import annotations

import hashlib
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelferry.llm.common import BYTE_CODES, mixed, per_text
from modelferry.session import scratch_path, written

LENGTH = 50
GRAM = 24
BEFORE = LENGTH - GRAM
PHRASE = BEFORE + LENGTH
BLOCK_BYTES = 4 << 20
#: Bytes whose hashes are held at once.
SLICE = 1 << 18
LAST_ID = (1 << 63) - 1

_BASES = (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _prefix(data: np.ndarray, which: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of code * base^i over all beginnings, and the inverse powers."""
    n = len(data)
    if which not in _powers or len(_powers[which][0]) <= n:
        size = max(n, SLICE + 2 * PHRASE) + 1
        pair = []
        for base in (_BASES[which], pow(_BASES[which], -1, 1 << 64)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            pair.append(np.cumprod(p, dtype=np.uint64))
        _powers[which] = tuple(pair)
    power, inverse = _powers[which]
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_CODES[data] * power[:n], out=sums[1:])
    return sums, inverse


def _sliding(x: np.ndarray, pick, width: int) -> np.ndarray:
    """pick over each run of ``width`` values, by doubling."""
    size = 1
    while 2 * size <= width:
        x = pick(x[:-size], x[size:])
        size *= 2
    return pick(x[:len(x) - (width - size)], x[width - size:]) if width > size else x


def triggers(data: np.ndarray, bounds: np.ndarray, second: bool = True):
    """(places, grams, lo, hi, digests) of all triggers of texts that lie end to end.

    The phrase of a place is data[place - BEFORE + lo : place - BEFORE + hi]. Without ``second`` digests are left out.
    """
    n, found = len(data), []
    for s in range(0, n, SLICE):
        e = min(s + SLICE, n)  # strings that start in [s, e)
        a, b = max(0, s - BEFORE), min(n, e + PHRASE)
        if b - a < LENGTH:
            continue
        part = data[a:b]
        sums, inverse = _prefix(part, 0)
        k = len(part) - GRAM + 1
        value = mixed((sums[GRAM:] - sums[:k]) * inverse[:k])
        # Grams and strings that cross the end of a text are none.
        crossing = np.zeros(len(part) + 1, np.int32)
        ends = np.unique(bounds[(bounds > a) & (bounds < b)]) - a
        np.add.at(crossing, np.maximum(ends - GRAM + 1, 0), 1)
        np.add.at(crossing, ends, -1)
        value[np.cumsum(crossing)[:k] > 0] = np.uint64(0xFFFFFFFFFFFFFFFF)
        w = len(part) - LENGTH + 1
        least = _sliding(value, np.minimum, BEFORE + 1)[:w]
        crossing[:] = 0
        np.add.at(crossing, np.maximum(ends - LENGTH + 1, 0), 1)
        np.add.at(crossing, ends, -1)
        start = np.arange(w)
        least[(np.cumsum(crossing)[:w] > 0) | (start < s - a) | (start >= e - a)] = 0
        pad = np.zeros(BEFORE, np.uint64)
        most = _sliding(np.concatenate([pad, least, pad]), np.maximum, BEFORE + 1)
        at = np.flatnonzero((most == value) & (most > 0))
        if not len(at):
            continue
        place = at + a
        text = np.searchsorted(bounds, place, "right") - 1
        lo = np.maximum(0, BEFORE - (place - bounds[text]))
        hi = np.minimum(PHRASE, bounds[text + 1] - place + BEFORE)
        digest = np.zeros(0, np.uint64)
        if second:
            sums, inverse = _prefix(part, 1)
            x, y = at - BEFORE + lo, at - BEFORE + hi
            digest = mixed(mixed((sums[y] - sums[x]) * inverse[x]) + (lo * 128 + hi).astype(np.uint64))
        found.append((place, value[at], lo, hi, digest))
    if not found:
        z = np.zeros(0, np.int64)
        return z, z.view(np.uint64), z, z, z.view(np.uint64)
    place, gram, lo, hi, digest = (np.concatenate(x) for x in zip(*found))
    # A trigger near the end of a slice can be found from both sides.
    _, once = np.unique(place, return_index=True)
    return place[once], gram[once], lo[once], hi[once], digest[once] if second else digest


def _texts(block: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes end to end, bounds, ids."""
    texts = [x or b"" for x in block.column("text").cast(pa.large_binary()).to_pylist()]
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=bounds[1:])
    return np.frombuffer(b"".join(texts), np.uint8), bounds, block.column("id").to_numpy()


def _dealt(gram: np.ndarray, n: int) -> np.ndarray:
    """The bucket of each trigger; rises with the trigger."""
    return (((gram >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)


def _packed(key: int, name: str, gram: np.ndarray, n: int, columns: dict[str, np.ndarray]) -> pa.Table:
    """One row a bucket with the values of its triggers as bytes; rows are sorted by trigger."""
    cuts = np.searchsorted(_dealt(gram, n), np.arange(n + 1))
    used = np.flatnonzero(np.diff(cuts))
    return pa.table({
        "bucket": pa.array(used, pa.int64()), name: pa.array(np.full(len(used), key), pa.int64()),
        **{c: pa.array([v[cuts[i]:cuts[i + 1]].tobytes() for i in used], pa.binary()) for c, v in columns.items()}})


def _joined(table: pa.Table, name: str, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(x for x in table.column(name).to_pylist() if x), dtype)


def _lengths(table: pa.Table, name: str, width: int) -> np.ndarray:
    return np.array([len(x) // width for x in table.column(name).to_pylist()], np.int64)


def _by_block(owner: np.ndarray, columns: dict[str, np.ndarray]) -> pa.Table:
    """One row a block with its values as bytes."""
    order = np.argsort(owner, kind="stable")
    blocks, at = np.unique(owner[order], return_index=True)
    cuts = np.append(at, len(order))
    return pa.table({"block": pa.array(blocks, pa.int64()), **{
        c: pa.array([v[order[i:j]].tobytes() for i, j in zip(cuts[:-1], cuts[1:])], pa.binary())
        for c, v in columns.items()}})


def _find(gram, digest, known_gram, known_digest) -> np.ndarray:
    """Where each (gram, digest) stands among known ones sorted by both, or -1."""
    key, known = mixed(gram ^ mixed(digest)), mixed(known_gram ^ mixed(known_digest))
    order = np.argsort(known)
    if not len(known):
        return np.full(len(key), -1)
    at = order[np.minimum(np.searchsorted(known[order], key), len(known) - 1)]
    return np.where((known_gram[at] == gram) & (known_digest[at] == digest), at, -1)


def distinct_texts(docs: DataFrame) -> tuple[DataFrame, int]:
    """Rows (block, k, id, text) of the distinct texts as a bucketed table, and how many blocks.

    A task sends each text once, however many copies it holds.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n = max(4, int(total) // BLOCK_BYTES + 1)

    def once(batches):
        least: dict[str, int] = {}
        for batch in batches:
            ids, keys = batch.column("id").to_pylist(), batch.column("k").to_pylist()
            keep, bare = [], []
            for i, (k, id_) in enumerate(zip(keys, ids)):
                if k not in least or id_ < least[k]:
                    keep.append(i)
                    bare.append(k in least)
                    least[k] = id_
            kept = batch.take(pa.array(keep, pa.int64()))
            texts = pa.array([None if b else t for b, t in zip(bare, kept.column("text").to_pylist())], pa.string())
            yield pa.RecordBatch.from_arrays([kept.column("k"), kept.column("id"), texts], names=["k", "id", "text"])

    rows = docs.select(
        F.md5(text).alias("k"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"), text.alias("text")
    ).mapInArrow(once, "k string, id long, text string").withColumn("block", F.pmod(F.xxhash64("k"), F.lit(n)))
    path, name = scratch_path(spark, "texts"), f"texts_{os.urandom(8).hex()}"
    rows.repartition(n, "block").groupBy("block", "k").agg(
        F.min("id").alias("id"), F.first("text", ignorenulls=True).alias("text")).write.bucketBy(
        n, "block").option("path", path).saveAsTable(name)
    return spark.table(name), n


def _grams(n):
    def run(block: pa.Table) -> pa.Table:
        data, bounds, _ = _texts(block)
        place, gram, *_ = triggers(data, bounds, second=False)
        owner = np.searchsorted(bounds, place, "right").astype(np.uint64)
        _, once = np.unique(mixed(gram + mixed(owner)), return_index=True)
        values, counts = np.unique(gram[once], return_counts=True)
        # A trigger of two texts of this block is sent twice, so it counts as repeated.
        values = np.repeat(values, np.minimum(counts, 2))
        return _packed(block.column("block")[0].as_py(), "block", values, n, {"gram": values})

    return run


def _repeated(bucket: pa.Table) -> pa.Table:
    gram, sizes = _joined(bucket, "gram", np.uint64), _lengths(bucket, "gram", 8)
    owner = np.repeat(bucket.column("block").to_numpy(), sizes)
    values, at, counts = np.unique(gram, return_inverse=True, return_counts=True)
    keep = counts[at] > 1
    gram, owner = gram[keep], owner[keep]
    first = np.ones(len(gram), bool)
    first[1:] = (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])
    return _by_block(owner[first], {"gram": gram[first]})


def _phrases(n):
    def run(block: pa.Table, back: pa.Table) -> pa.Table:
        number = (block if block.num_rows else back).column("block")[0].as_py()
        data, bounds, ids = _texts(block)
        known = np.sort(_joined(back, "gram", np.uint64))
        if not len(known):
            z = np.zeros(0, np.uint64)
            return _packed(number, "block", z, n, {"gram": z, "digest": z, "id": z})
        place, gram, _, _, digest = triggers(data, bounds)
        hit = known[np.minimum(np.searchsorted(known, gram), len(known) - 1)] == gram
        place, gram, digest = place[hit], gram[hit], digest[hit]
        own = ids[np.searchsorted(bounds, place, "right") - 1]
        order = np.lexsort((own, digest, gram))
        gram, digest, own = gram[order], digest[order], own[order]
        first = np.ones(len(gram), bool)
        first[1:] = (gram[1:] != gram[:-1]) | (digest[1:] != digest[:-1])
        gram, digest, own = gram[first], digest[first], own[first]
        return _packed(number, "block", gram, n, {"gram": gram, "digest": digest, "id": own})

    return run


def _parsed(bucket: pa.Table) -> pa.Table:
    """For every phrase its smallest id, and whether its trigger has other phrases."""
    gram, digest = _joined(bucket, "gram", np.uint64), _joined(bucket, "digest", np.uint64)
    own, sizes = _joined(bucket, "id", np.int64), _lengths(bucket, "gram", 8)
    owner = np.repeat(bucket.column("block").to_numpy(), sizes)
    order = np.lexsort((own, digest, gram))
    gram, digest, own, owner = gram[order], digest[order], own[order], owner[order]
    new_gram = np.ones(len(gram), bool)
    new_gram[1:] = gram[1:] != gram[:-1]
    new = new_gram.copy()
    new[1:] |= digest[1:] != digest[:-1]
    least = own[new][np.cumsum(new) - 1]
    kinds = np.add.reduceat(new.astype(np.int64), np.flatnonzero(new_gram))
    several = (kinds > 1)[np.cumsum(new_gram) - 1]
    return _by_block(owner, {"gram": gram, "digest": digest, "id": least, "several": several.astype(np.uint8)})


def _known(back: pa.Table):
    return (_joined(back, "gram", np.uint64), _joined(back, "digest", np.uint64), _joined(back, "id", np.int64),
            _joined(back, "several", np.uint8))


def _entries(n):
    def run(block: pa.Table, back: pa.Table) -> pa.Table:
        number = (block if block.num_rows else back).column("block")[0].as_py()
        known_gram, known_digest, least, several = _known(back)
        keep = several > 0
        known_gram, known_digest, least = known_gram[keep], known_digest[keep], least[keep]
        columns = {"gram": np.uint64, "digest": np.uint64, "id": np.int64, "lo": np.uint8, "hi": np.uint8}
        empty = {c: np.zeros(0, t) for c, t in columns.items()} | {"phrase": np.zeros((0, PHRASE), np.uint8)}
        if not len(known_gram):
            return _packed(number, "block", empty["gram"], n, empty)
        data, bounds, ids = _texts(block)
        place, gram, lo, hi, digest = triggers(data, bounds)
        at = _find(gram, digest, known_gram, known_digest)
        own = ids[np.searchsorted(bounds, place, "right") - 1]
        pick = np.flatnonzero(at >= 0)
        pick = pick[own[pick] == least[at[pick]]]
        _, once = np.unique(at[pick], return_index=True)
        pick = pick[once]
        pick = pick[np.argsort(gram[pick], kind="stable")]
        padded = np.concatenate([np.zeros(BEFORE, np.uint8), data, np.zeros(LENGTH, np.uint8)])
        phrase = padded[place[pick][:, None] + np.arange(PHRASE)]
        return _packed(number, "block", gram[pick], n, {
            "gram": gram[pick], "digest": digest[pick], "id": own[pick], "lo": lo[pick].astype(np.uint8),
            "hi": hi[pick].astype(np.uint8), "phrase": phrase})

    return run


def _ordered(bucket: pa.Table) -> pa.Table:
    """Which strings of each phrase a smaller id has in another phrase: one bit for each start."""
    gram, digest = _joined(bucket, "gram", np.uint64), _joined(bucket, "digest", np.uint64)
    own, sizes = _joined(bucket, "id", np.int64), _lengths(bucket, "gram", 8)
    lo, hi = (_joined(bucket, c, np.uint8).astype(np.int64) for c in ("lo", "hi"))
    phrase = _joined(bucket, "phrase", np.uint8).reshape(-1, PHRASE)
    owner = np.repeat(bucket.column("block").to_numpy(), sizes)
    mask = np.zeros(len(gram), np.uint32)
    weights = np.cumprod(np.full(LENGTH, _BASES[1], np.uint64), dtype=np.uint64)
    for o in range(BEFORE + 1):
        whole = np.flatnonzero((lo <= o) & (o + LENGTH <= hi))
        value = np.zeros(len(whole), np.uint64)
        for t in range(LENGTH):
            value += BYTE_CODES[phrase[whole, o + t]] * weights[t]
        _, at, counts = np.unique(value, return_inverse=True, return_counts=True)
        whole = whole[counts[at] > 1]
        if not len(whole):
            continue
        strings = np.ascontiguousarray(phrase[whole, o:o + LENGTH]).view(f"V{LENGTH}").ravel()
        _, at = np.unique(strings, return_inverse=True)
        least = np.full(int(at.max()) + 1, LAST_ID)
        np.minimum.at(least, at, own[whole])
        mask[whole[least[at] < own[whole]]] |= np.uint32(1 << o)
    keep = mask > 0
    return _by_block(owner[keep], {"gram": gram[keep], "digest": digest[keep], "mask": mask[keep]})


def _marked(block: pa.Table, back: pa.Table) -> pa.Table:
    """The digest row of each text."""
    data, bounds, ids = _texts(block)
    cover = np.zeros(len(data) + 1, np.int32)
    parse, marks = (back.filter(pc.equal(back.column("kind"), k)) for k in ("parse", "marks"))
    known_gram, known_digest, least, _ = _known(parse)
    if len(known_gram) and len(data):
        place, gram, lo, hi, digest = triggers(data, bounds)
        own = ids[np.searchsorted(bounds, place, "right") - 1]
        at = _find(gram, digest, known_gram, known_digest)
        begin = place - BEFORE
        whole = np.flatnonzero((at >= 0) & (own > least[at]))
        np.add.at(cover, begin[whole] + lo[whole], 1)
        np.add.at(cover, begin[whole] + hi[whole], -1)
        mask = _joined(marks, "mask", np.uint32)
        if len(mask):
            to = _find(gram, digest, _joined(marks, "gram", np.uint64), _joined(marks, "digest", np.uint64))
            some = np.flatnonzero((to >= 0) & (at >= 0) & (own == least[at]))
            for o in range(BEFORE + 1):
                hit = some[(mask[to[some]] >> np.uint32(o)) & np.uint32(1) > 0]
                np.add.at(cover, begin[hit] + o, 1)
                np.add.at(cover, begin[hit] + o + LENGTH, -1)
    removed = np.cumsum(cover[:-1], dtype=np.int32) > 0
    starts = removed.copy()
    starts[1:] &= ~removed[:-1]
    cuts = bounds[:-1][np.diff(bounds) > 0]
    starts[cuts] = removed[cuts]
    shas = [
        hashlib.sha256(data[a:b][~removed[a:b]].tobytes()).hexdigest() for a, b in zip(bounds[:-1], bounds[1:])]
    return pa.table({
        "k": block.column("k"), "least": block.column("id"), "removed": pa.array(per_text(removed, bounds)),
        "spans": pa.array(per_text(starts, bounds)), "sha": pa.array(shas, pa.string())})


def repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    texts, n = distinct_texts(docs)
    long = texts.where(F.octet_length("text") >= LENGTH)
    packed = "bucket long, block long, "

    def met(step, back, schema):
        return long.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(step, schema)

    grams = long.groupBy("block").applyInArrow(_grams(n), packed + "gram binary")
    repeated = written(grams.groupBy("bucket").applyInArrow(_repeated, "block long, gram binary"), "grams")
    phrases = met(_phrases(n), repeated, packed + "gram binary, digest binary, id binary")
    parse = written(phrases.groupBy("bucket").applyInArrow(
        _parsed, "block long, gram binary, digest binary, id binary, several binary"), "parse")
    entries = met(_entries(n), parse, packed + "gram binary, digest binary, id binary, lo binary, hi binary, phrase binary")
    marks = written(entries.groupBy("bucket").applyInArrow(
        _ordered, "block long, gram binary, digest binary, mask binary"), "marks")
    back = parse.select(F.lit("parse").alias("kind"), "*").unionByName(
        marks.select(F.lit("marks").alias("kind"), "*"), allowMissingColumns=True)
    found = texts.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(
        _marked, "k string, least long, removed long, spans long, sha string")
    found = written(found, "found")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.md5(text).alias("k"), F.octet_length(text).cast("long").alias("n_bytes"))
    copy = (F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)) > F.col("least")) & (F.col("n_bytes") >= LENGTH)
    return rows.join(found, "k").select(
        "doc_id", "n_bytes", F.when(copy, F.col("n_bytes")).otherwise(F.col("removed")).alias("n_removed"),
        F.when(copy, F.lit(1).cast("long")).otherwise(F.col("spans")).alias("n_spans"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.col("sha")).alias("kept_sha256"))
