"""Best-fit packing: documents into sequences of at most ``CAPACITY`` tokens.

Best-fit decreasing puts the longest piece next into the open sequence with the least room that
still takes it. Pieces of one length are interchangeable, and so are sequences with one room left: the whole
packing follows from how many pieces there are of each length, at most ``CAPACITY`` numbers. So the driver
plans with these counts alone, exactly as best-fit decreasing would place the pieces one
by one: a segment tree over the possible rooms finds the tightest open one in
logarithmic time, and all sequences with that room are filled in one move. The plan's size
depends on ``CAPACITY`` only. Spark then numbers the pieces of each length and looks each
number up in the moves.

A document is its token ids and then the end id. Only longer documents are cut, from the end,
so that all pieces but the first are full. A null or empty text is one token. Rows with equal ids are packed each
on their own. Ids follow the tokenizer file; a test holds the rank file used for speed to the same ids.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_right
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from modelferry.llm.common import raw
from modelferry.session import written

CAPACITY = 1024
END_ID = 2
RANKS = "byte_bpe_50k.tiktoken"
SPECIAL = "<|endoftext|>"
SPECIAL_ID = 50256

_encoders: dict[str, object] = {}


def encoder(name: str = RANKS):
    """The public vocabulary as ranks: the ids of the tokenizer file ``byte_bpe_50k.json``, several times as fast."""
    if name not in _encoders:
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(name), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _encoders[name] = tiktoken.Encoding(
            "public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={SPECIAL: SPECIAL_ID})
    return _encoders[name]


def piece_bounds(n: int, capacity: int = CAPACITY) -> list[int]:
    """Where the pieces of a document of n tokens start and end; only the first may be shorter."""
    first = n % capacity or min(n, capacity)
    return [0, *range(first, n + 1, capacity)] if n else [0]


def pieces(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32) of all documents."""

    def cut(batches):
        encode = encoder().encode
        for batch in batches:
            rows: list[tuple[int | None, int, int, int, int]] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), raw(batch.column("text"))):
                ids = np.array([*encode(text.decode(), allowed_special="all"), END_ID], "<u4")
                bounds = piece_bounds(len(ids), capacity)
                rows += [
                    (doc_id, i, a, b - a, zlib.crc32(ids[a:b].tobytes()))
                    for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:]))]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            columns = zip(*rows) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in map(list, columns)], names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        cut, "doc_id long, piece long, start long, length long, ids_crc32 long")


class RoomTree:
    """A segment tree over the rooms 0..capacity: how many open sequences have each."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.sums = [0] * (2 * self.leaves)

    def add(self, room: int, n: int) -> None:
        node = room + self.leaves
        while node:
            self.sums[node] += n
            node //= 2

    def tightest(self, least: int) -> int | None:
        """The smallest room of at least ``least`` that is open."""
        node = least + self.leaves
        if self.sums[node]:
            return least
        while node > 1:
            if node % 2 == 0 and self.sums[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.sums[2 * node] else 2 * node + 1
                return node - self.leaves
            node //= 2
        return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> dict[int, list[tuple[int, int, int, int]]]:
    """By length, moves (first piece number, first sequence, pieces to a sequence, offset of the first).

    A move takes the pieces of a length from its first number up to the next move's. The nth goes into sequence
    first + n // each, at offset + n % each * length.
    """
    tree, held = RoomTree(capacity), defaultdict(list)  # room -> runs (first sequence, how many)
    moves: dict[int, list[tuple[int, int, int, int]]] = {}
    opened = 0

    def keep(room: int, first: int, n: int) -> None:
        if room and n:
            held[room].append((first, n))
            tree.add(room, n)

    for length in sorted(counts, reverse=True):
        left, done = counts[length], 0
        moves[length] = []
        while left:
            room = tree.tightest(length)
            if room is None:
                room, first, n = capacity, opened, -(-left // (capacity // length))
                opened += n
            else:
                first, n = held[room].pop()
                tree.add(room, -n)
            # Best fit fills a sequence on: after a piece its room is tighter than any other that fits.
            each = room // length
            whole = min(n, left // each)
            moves[length].append((done, first, each, capacity - room))
            done, left = done + whole * each, left - whole * each
            keep(room - each * length, first, whole)
            rest = n - whole
            if rest and left:
                keep(room - left * length, first + whole, 1)
                moves[length].append((done, first + whole, each, capacity - room))
                done, left, whole, rest = done + left, 0, whole + 1, rest - 1
            keep(room, first + whole, rest)
    return moves


def numbered(rows: DataFrame, salt: int = 256) -> DataFrame:
    """Adds ``number``: gapless from 0 among the pieces of each length.

    A length may hold most of the pieces, so each is numbered in ``salt`` parts and the sizes of the parts before are added.
    """
    salted = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salt)))
    sizes = salted.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = sizes.select("length", "part", (F.sum("n").over(
        Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32"))
    return salted.withColumn("inside", inside).join(before, ["length", "part"]).withColumn(
        "number", F.col("before") + F.col("inside") - 1).drop("part", "inside", "before")


def placed(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces."""
    n_rows = rows.count()
    counts = {int(r[0]): int(r[1]) for r in rows.groupBy("length").count().collect()}
    moves = plan(counts, capacity)

    def look_up(batches):
        for batch in batches:
            lengths, numbers = batch.column("length").to_pylist(), batch.column("number").to_pylist()
            out = []
            for length, number in zip(lengths, numbers):
                of = moves[length]
                first, sequence, each, offset = of[bisect_right(of, number, key=lambda m: m[0]) - 1]
                out.append((sequence + (number - first) // each, offset + (number - first) % each * length))
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names]
                + [pa.array([x[i] for x in out], pa.int64()) for i in range(2)],
                names=[*names, "sequence_id", "offset"])

    # Parts of some ten thousand pieces.
    salt = max(16, n_rows // 20_000)
    return numbered(rows, salt).mapInArrow(
        look_up, "doc_id long, piece long, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Tokens are made once; the pieces are written before they are counted.
    """
    return placed(written(pieces(docs, capacity), "pieces"), capacity)
