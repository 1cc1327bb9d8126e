"""Compressed vectors: four codebooks by Lloyd rounds over partition-local cover trees.

A vector is cut into ``PARTS`` equal parts, and each part is replaced by the number of its codebook's nearest entry. All
arithmetic is on integers: a component x counts as floor(1024 * x).

Each task builds cover trees of its own vectors, one for each part, in blocks of ``BLOCK``. A node stands for a run of
distinct points within its radius; children halve the radius and their centres are further apart than that.
Cumulative sums over the points in tree order, repeated points counted, give the sum and number of any node's points.
The trees are written once and read in every round. In a round, a node whose nearest entry stays nearest for
all points within its radius (triangle inequality: its distance plus the radius is less than that of any
other entry minus the radius) is added to that entry as a whole; only other nodes are opened, and single points are compared
exactly, ties to the lower number. A task hands over one sum for each entry, so nothing is shuffled but
those, and the driver holds codebooks only: at most 256 entries of one vector's components.

Defined cases: vectors that are null, empty, or hold null or non-finite components are dropped, and so are those whose
dimension is not the commonest (of equally common ones the largest counts); a dimension that ``PARTS`` does not divide is filled up
with zeros. Rows with equal ids are coded each on their own; the first entries are the rows with the
smallest (id, vector), null ids last, and fewer than 256 rows give as many entries. Null labels are one label.
Distances must fit in 63 bits, or the job fails with a message. An empty table gives no rows. Columns beside the three are ignored.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from modelferry.session import written

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
BLOCK = 1024
# Nodes compared with the codebook at once.
NODES_AT_ONCE = 2048


# -- cover trees --------------------------------------------------------------

def _number_type(points: np.ndarray, book: np.ndarray | None = None):
    """A float type that holds all squared distances exactly."""
    most = max((int(np.abs(x).max()) for x in (points, book) if x is not None and x.size), default=0)
    largest = 4 * most * most * points.shape[1]
    if largest < 1 << 53:
        return np.float64
    if largest < 1 << 63:
        return np.longdouble
    raise OverflowError(f"components up to {most} make squared distances beyond 63 bits")


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows, as floats."""
    kind = _number_type(a, b)
    a, b = a.astype(kind), b.astype(kind)
    # Every product and sum is an integer that the type holds exactly.
    return (a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T)


@dataclass(frozen=True)
class CoverTree:
    """Nodes in order of depth, children of a node side by side.

    ``points`` are distinct and in tree order, so node k covers points low[k] to high[k] - 1 and its centre is
    point low[k]. ``rows`` gives the point of each row. ``sums`` and ``counts`` are cumulative from 0.
    """

    points: np.ndarray
    rows: np.ndarray
    low: np.ndarray
    high: np.ndarray
    radius: np.ndarray
    child: np.ndarray
    children: np.ndarray
    sums: np.ndarray
    counts: np.ndarray


def build(vectors: np.ndarray) -> CoverTree:
    """The cover tree of integer rows."""
    points, rows, repeated = np.unique(vectors, axis=0, return_inverse=True, return_counts=True)
    far = np.sqrt(np.maximum(squared_distances(points, points), 0)).astype(np.float64)
    depth: list[list[np.ndarray]] = [[np.arange(len(points))]]
    nodes: list[tuple[np.ndarray, float, list[np.ndarray]]] = []
    while depth[-1]:
        below = []
        for held in depth[-1]:
            radius = float(far[held[0], held].max())
            split = _split(held, far, radius / 2) if len(held) > 1 else []
            nodes.append((held, radius, split))
            below += split
        depth.append(below)
    children = np.array([len(s) for _, _, s in nodes])
    child = 1 + np.cumsum(children) - children
    # Points in tree order: a node's children, in order, share out its run; the first child has its centre.
    low, size = np.zeros(len(nodes), np.int64), np.array([len(h) for h, _, _ in nodes])
    order = np.zeros(len(points), np.int64)
    for k, (held, _, split) in enumerate(nodes):
        if split:
            c = int(child[k])
            low[c:c + len(split)] = low[k] + np.cumsum(size[c:c + len(split)]) - size[c:c + len(split)]
        else:
            order[low[k]] = held[0]
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    kept, repeated = points[order], repeated[order]
    sums = np.zeros((len(kept) + 1, points.shape[1]), np.int64)
    np.cumsum(kept * repeated[:, None], axis=0, out=sums[1:])
    return CoverTree(
        kept, place[rows.reshape(-1)], low, low + size, np.array([r for _, r, _ in nodes]), child, children, sums,
        np.concatenate([[0], np.cumsum(repeated)]))


def _split(held: np.ndarray, far: np.ndarray, reach: float) -> list[np.ndarray]:
    """Points within reach of the first, and so on with the first of the rest."""
    out = []
    while len(held):
        near = far[held[0], held] <= reach
        out.append(held[near])
        held = held[~near]
    return out


def assigned(tree: CoverTree, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nodes that go to one entry as a whole, those entries, and how many comparisons with an entry it took."""
    nodes, entries, compared = [], [], 0
    front = np.array([0])
    while len(front):
        opened = []
        for first in range(0, len(front), NODES_AT_ONCE):
            some = front[first:first + NODES_AT_ONCE]
            squared = squared_distances(tree.points[tree.low[some]], book)
            compared += squared.size
            best = squared.argmin(1)
            radius = tree.radius[some]
            sure = radius == 0
            if len(book) > 1:
                at = np.arange(len(some))
                nearest = np.sqrt(squared[at, best].astype(np.float64))
                squared[at, best] = np.inf
                second = np.sqrt(squared.min(1).astype(np.float64))
                # A margin for the rounding of roots; whoever is in doubt is opened.
                sure |= second - radius > (nearest + radius) * (1 + 1e-9) + 1e-6
            else:
                sure[:] = True
            nodes.append(some[sure])
            entries.append(best[sure])
            opened.append(some[~sure])
        rest = np.concatenate(opened)
        n = tree.children[rest]
        front = np.repeat(tree.child[rest] - np.cumsum(n) + n, n) + np.arange(n.sum())
    return np.concatenate(nodes), np.concatenate(entries), compared


def sums_by_entry(tree: CoverTree, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and number of the points of each entry."""
    nodes, entries, _ = assigned(tree, book)
    sums, counts = np.zeros(book.shape, np.int64), np.zeros(len(book), np.int64)
    np.add.at(sums, entries, tree.sums[tree.high[nodes]] - tree.sums[tree.low[nodes]])
    np.add.at(counts, entries, tree.counts[tree.high[nodes]] - tree.counts[tree.low[nodes]])
    return sums, counts


def codes(tree: CoverTree, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of each row."""
    nodes, entries, _ = assigned(tree, book)
    of = np.empty(len(tree.points), np.int64)
    sizes = tree.high[nodes] - tree.low[nodes]
    of[np.repeat(tree.low[nodes] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())] = np.repeat(entries, sizes)
    _number_type(tree.points, book)
    apart = tree.points - book[of]
    return of[tree.rows], (apart * apart).sum(1)[tree.rows]


# -- the job ------------------------------------------------------------------

def whole_numbers(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(SCALE) * x.cast("double")).cast("long"))


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(math.inf)))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def kept(vectors: DataFrame, id_name: str, vector: str, label: str) -> DataFrame:
    """Rows (vec_id, label, v) of usable vectors of the commonest dimension, as integers, filled up to full parts."""
    found = vectors.select(F.col(id_name).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("v")).where(
        usable(F.col("v")))
    common = found.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    size = common["size"] if common else PARTS
    filler = F.array_repeat(F.lit(0).cast("long"), -size % PARTS)
    return found.where(F.size("v") == size).select("vec_id", "label", F.concat(whole_numbers(F.col("v")), filler).alias("v"))


def _blocks(rows: DataFrame) -> DataFrame:
    """Rows (ids, labels, trees): blocks of vectors with a tree for each part."""
    kind = to_arrow_type(rows.schema["label"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def block(table: pa.Table) -> pa.RecordBatch:
            ids, labels, vectors = (table.column(c).combine_chunks() for c in ("vec_id", "label", "v"))
            whole = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
            trees = [pickle.dumps(build(np.ascontiguousarray(part)), 5) for part in np.split(whole, PARTS, axis=1)]
            ends = pa.array([0, len(ids)], pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(ends, ids), pa.ListArray.from_arrays(ends, labels.cast(kind)), pa.array([trees], pa.list_(pa.binary()))],
                names=["ids", "labels", "trees"])

        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= BLOCK:
                table = pa.Table.from_batches(held)
                yield block(table.slice(0, BLOCK))
                held = table.slice(BLOCK).to_batches()
        if sum(b.num_rows for b in held):
            yield block(pa.Table.from_batches(held))

    label = rows.schema["label"].dataType.simpleString()
    return rows.mapInArrow(run, f"ids array<bigint>, labels array<{label}>, trees array<binary>")


def _loaded(batch: pa.RecordBatch) -> Iterator[list[CoverTree]]:
    for trees in batch.column("trees"):
        yield [pickle.loads(t.as_py()) for t in trees]


def _round_sums(blocks: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """Rows (part, entry, n, sums) of used entries."""
    width = books[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((PARTS, *books[0].shape), np.int64), np.zeros((PARTS, len(books[0])), np.int64)
        for batch in batches:
            for trees in _loaded(batch):
                for part, (tree, book) in enumerate(zip(trees, books)):
                    s, n = sums_by_entry(tree, book)
                    sums[part] += s
                    counts[part] += n
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry], pa.int64()),
             pa.array(list(sums[part, entry]), pa.list_(pa.int64()))], names=["part", "entry", "n", "sums"])

    made = blocks.select("trees").mapInArrow(run, "part int, entry int, n bigint, sums array<bigint>")
    return made.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(width)]).alias("sums"))


def _coded(blocks: DataFrame, books: list[np.ndarray], label_type) -> DataFrame:
    kind = to_arrow_type(label_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, trees in enumerate(_loaded(batch)):
                found = [codes(tree, book) for tree, book in zip(trees, books)]
                entries = np.stack([c for c, _ in found], 1).astype(np.uint8)
                error = np.sum([e for _, e in found], axis=0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids")[i].values, batch.column("labels")[i].values.cast(kind),
                     pa.array([row.tobytes().hex() for row in entries], pa.string()), pa.array(error, pa.int64())],
                    names=["vec_id", "label", "code", "error"])

    return blocks.mapInArrow(run, f"vec_id bigint, label {label_type.simpleString()}, code string, error bigint")


def first_books(rows: DataFrame, entries: int) -> list[np.ndarray]:
    """The parts of the rows with the smallest ids; at most ``entries`` rows reach the driver."""
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "v").select("v").limit(entries).collect()
    return [np.ascontiguousarray(p) for p in np.split(np.array([r.v for r in first], np.int64), PARTS, axis=1)]


def digest(books: list[np.ndarray]) -> str:
    """Hash of all components in order of part, entry and position."""
    return hashlib.sha256(",".join(str(x) for book in books for x in book.reshape(-1).tolist()).encode()).hexdigest()


def compress(
    vectors: DataFrame, id_name: str = "vec_id", vector: str = "embedding", label: str = "label",
    entries: int = ENTRIES, rounds: int = ROUNDS,
) -> tuple[DataFrame, list[np.ndarray]]:
    """Rows (vec_id, label, code, error) and the codebooks."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits a part, so there may be 1 to 256 entries")
    rows = kept(vectors, id_name, vector, label)
    label_type = rows.schema["label"].dataType
    books = first_books(rows, entries) if not rows.isEmpty() else []
    if not books:
        return _coded(rows.sparkSession.createDataFrame(
            [], f"ids array<bigint>, labels array<{label_type.simpleString()}>, trees array<binary>"), [], label_type), books
    blocks = written(_blocks(rows), "cover-trees")
    for _ in range(rounds):
        books = [book.copy() for book in books]
        for r in _round_sums(blocks, books).collect():
            books[r.part][r.entry] = [s // r.n for s in r.sums]
    return _coded(blocks, books, label_type), books


def with_label_errors(coded: DataFrame) -> DataFrame:
    """Adds label_error: the sum of error over all rows of the label, null labels together."""
    coded = written(coded, "codes")
    sums = coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of_label"))).drop("of_label")
