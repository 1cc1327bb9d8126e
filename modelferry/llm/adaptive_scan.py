"""Nearest neighbours by largest inner product: inverted lists with an adaptive dimension scan.

Inner products become distances by one more coordinate, sqrt(M^2 - |x|^2) with M the largest norm (0 for queries):
the smaller the distance, the larger the inner product. All vectors are turned by one random
rotation and read in blocks of columns. Under a random rotation the share of a squared distance
that falls into the first t of D columns has a Beta(t/2, (D-t)/2) distribution. After each column block
a candidate is given up when its partial distance is beyond the query's bound times the upper limit of that share
(``SIGMAS`` deviations above the mean): the hypothesis that the full distance is within the bound is rejected.
The bound is the query's distance to its (k+1)th nearest in a sample, which the true one can only undercut.

Lists come from k-means on a sample of at most ``SAMPLE`` vectors (by smallest hash); every vector is put into the list of
its nearest centre. How many lists a query probes is fitted on the same sample to find ``COVER`` of the
neighbours there. Equal vectors are one candidate with their k+1 smallest ids, as no others can be
among the nearest k. Lists are scanned in blocks of candidates and of queries, so that no task holds a list or all queries.

Scores are inner products of the original vectors in double precision, ties go to smaller ids. Vectors
that are null, empty, zero or hold null or non-finite components take no part, nor do rows without id or whose dimension is not the most
frequent one. Rows with one id count once, at their best score; a query never finds its own id. No valid vector: no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from modelferry.session import written

NEAREST = 20
SAMPLE = 20_000
BOUND_SAMPLE = 8_192
LIST_ROWS, MAX_LISTS = 1_024, 4_096
BLOCK_ROWS = 2_048
QUERY_ROWS = 4_096
COLUMNS = 16
SIGMAS = 2.8
COVER = 0.98
SEED = 3
#: Pairs of queries and candidates that are held at once.
PAIRS = 1 << 18


def valid(vectors: DataFrame) -> DataFrame:
    """(id, v) of the vectors that take part, as doubles."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    good = vectors.select(F.col("vec_id").cast("long").alias("id"), v.alias("v")).where(
        "id is not null and v is not null and size(v) > 0"
    ).where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))).where(
        F.exists("v", lambda x: x != 0))
    sizes = good.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).select("d")
    first = sizes.first()
    return good.where(F.size("v") == (first.d if first else 0))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Lists of one length as rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros((0, 1))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


class Space:
    """The rotation, the centres and how many lists to probe."""

    def __init__(self, sample: np.ndarray, ids: np.ndarray, n: int, largest: float):
        rng = np.random.default_rng(SEED)
        self.largest = largest
        d = sample.shape[1] + 1
        self.rotation = np.linalg.qr(rng.normal(size=(d, d)))[0].astype(np.float32)
        x = self.candidates(sample)
        lists = int(min(MAX_LISTS, max(1, n // LIST_ROWS), len(x)))
        self.centres = x[rng.choice(len(x), lists, replace=False)].copy()
        for _ in range(6):
            of = self.lists_of(x)
            sums = np.zeros((lists, d))
            np.add.at(sums, of, x)
            counts = np.bincount(of, minlength=lists)
            self.centres[counts > 0] = (sums[counts > 0] / counts[counts > 0, None]).astype(np.float32)
        self.bounds_from = x[:BOUND_SAMPLE]
        self.known, self.known_ids = sample[:BOUND_SAMPLE], ids[:BOUND_SAMPLE]
        self.known_lists = self.lists_of(self.bounds_from)
        self.probes = self._probes(sample, x)

    def candidates(self, v: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.largest ** 2 - (v * v).sum(axis=1), 0))
        return np.column_stack([v, rest]).astype(np.float32) @ self.rotation

    def queries(self, v: np.ndarray) -> np.ndarray:
        return np.column_stack([v, np.zeros(len(v))]).astype(np.float32) @ self.rotation

    def order(self, x: np.ndarray) -> np.ndarray:
        return (self.centres * self.centres).sum(axis=1) - 2 * (x @ self.centres.T)

    def lists_of(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.int64), *[
            self.order(x[i:i + 4096]).argmin(axis=1) for i in range(0, len(x), 4096)]]).astype(np.int64)

    def asked(self, w: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """For each query its bound, the lists it probes, and its nearest k+1 of the sample, as places in it.

        The lists are those of the nearest centres and those of the nearest in the sample.
        """
        x, k = self.bounds_from, min(NEAREST + 1, len(self.bounds_from))
        bounds, lists, near = [], [], []
        for i in range(0, len(w), 256):
            y = self.queries(w[i:i + 256])
            dist = (x * x).sum(axis=1) - 2 * (y @ x.T) + (y * y).sum(axis=1)[:, None]
            best = np.argpartition(dist, k - 1, axis=1)[:, :k]
            near.append(best)
            last = np.take_along_axis(dist, best, axis=1).max(axis=1) * 1.0001 + 1e-5
            bounds.append(last if k > NEAREST else np.full(len(y), np.inf))
            ranked = np.argsort(self.order(y), axis=1, kind="stable")[:, :self.probes]
            lists += [np.unique(np.append(r, self.known_lists[b])) for r, b in zip(ranked, best)]
        return np.concatenate(bounds), lists, np.concatenate(near)

    def _probes(self, sample: np.ndarray, x: np.ndarray) -> int:
        lists = len(self.centres)
        q = self.queries(sample[-256:])
        dist = (x * x).sum(axis=1) - 2 * (q @ x.T)
        near = np.argsort(dist, axis=1)[:, 1:NEAREST + 1]
        rank = np.argsort(np.argsort(self.order(q), axis=1, kind="stable"), axis=1)
        at = np.take_along_axis(rank, self.lists_of(x)[near], axis=1)
        covered = np.bincount(at.ravel(), minlength=lists).cumsum() / max(1, at.size)
        return int(min(lists, np.searchsorted(covered, COVER) + 1))


def scan(x: np.ndarray, q: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, candidate) that no column block gives up."""
    d = x.shape[1]
    steps = list(range(0, d, COLUMNS))
    if d - steps[-1] < COLUMNS // 2 and len(steps) > 1:
        steps.pop()
    found_q, found_x = [], []
    rows = max(1, PAIRS // max(1, len(x)))
    for at in range(0, len(q), rows):
        y, limit = q[at:at + rows], bound[at:at + rows]
        partial, alive = None, None
        for step, a in enumerate(steps):
            b = steps[step + 1] if step + 1 < len(steps) else d
            xb, yb = np.ascontiguousarray(x[:, a:b]), np.ascontiguousarray(y[:, a:b])
            share = b / d + SIGMAS * np.sqrt(2 * b * (d - b) / (d * d * (d + 2))) if b < d else 1.0
            if alive is None:  # all pairs
                dist = (xb * xb).sum(axis=1) - 2 * (yb @ xb.T) + (yb * yb).sum(axis=1)[:, None]
                partial = dist if partial is None else partial + dist
                keep = partial <= (limit * share)[:, None]
                if b == d or keep.mean() < 0.15:
                    alive = np.nonzero(keep)
                    partial = partial[alive]
            else:
                diff = xb[alive[1]] - yb[alive[0]]
                partial = partial + (diff * diff).sum(axis=1)
                keep = partial <= limit[alive[0]] * share
                alive, partial = (alive[0][keep], alive[1][keep]), partial[keep]
        found_q.append(alive[0] + at)
        found_x.append(alive[1])
    return np.concatenate(found_q), np.concatenate(found_x)


def _met(space: Space):
    empty = {"query": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())}

    def run(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        if not candidates.num_rows or not queries.num_rows:
            return pa.table(empty)
        v, w = _matrix(candidates.column("v")), _matrix(queries.column("v"))
        qi, xi = scan(space.candidates(v), space.queries(w), queries.column("bound").to_numpy().astype(np.float32))
        # Row by row, so that equal vectors have equal scores wherever they stand.
        score = np.concatenate([np.zeros(0), *[
            (v[xi[i:i + 65536]] * w[qi[i:i + 65536]]).sum(axis=1) for i in range(0, len(qi), 65536)]])
        first = candidates.column("rep").to_numpy()
        order = np.lexsort((first[xi], -score, qi))
        qi, xi, score = qi[order], xi[order], score[order]
        place = np.arange(len(qi)) - np.searchsorted(qi, qi)
        keep = place <= NEAREST
        qi, xi, score = qi[keep], xi[keep], score[keep]
        ids = candidates.column("ids").combine_chunks()
        sizes = np.diff(ids.offsets.to_numpy())[xi]
        begins = ids.offsets.to_numpy()[:-1][xi]
        at = np.repeat(begins - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        return pa.table({
            "query": pa.array(np.repeat(queries.column("rep").to_numpy()[qi], sizes)),
            "id": pa.array(ids.values.to_numpy()[at]), "score": pa.array(np.repeat(score, sizes))})

    return run


def nearest(vectors: DataFrame, every: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score for the queries whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    rows = valid(vectors)
    reps = rows.groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("n"))
    by_vector = Window.partitionBy("v").orderBy("id")
    few = rows.withColumn("place", F.row_number().over(by_vector)).where(F.col("place") <= NEAREST + 1)
    distinct = written(few.groupBy("v").agg(
        F.min("id").alias("rep"), F.sort_array(F.collect_list("id")).alias("ids")), "vectors")
    n, largest = distinct.agg(F.count("*"), F.max(F.sqrt(F.aggregate(
        "v", F.lit(0.0), lambda a, x: a + x * x)))).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if not n:
        return spark.createDataFrame([], schema)
    sample = distinct.select("v", "rep").orderBy(F.xxhash64(F.lit(SEED), "rep"), "rep").limit(SAMPLE).toArrow()
    space = Space(_matrix(sample.column("v")), sample.column("rep").to_numpy(), n, float(largest))

    def assign(batches):
        for b in batches:
            lists = space.lists_of(space.candidates(_matrix(b.column("v"))))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lists)], names=[*b.schema.names, "list"])

    def probe(batches):
        for b in batches:
            if not b.num_rows:
                continue
            w = _matrix(b.column("v"))
            bound, lists, near = space.asked(w)
            scores = [(space.known[at] * q).sum(axis=1) for at, q in zip(near, w)]
            yield pa.RecordBatch.from_arrays(
                [b.column("v"), b.column("rep"), pa.array(bound.astype(np.float64)),
                 pa.array(lists, pa.list_(pa.int64())), pa.array(list(space.known_ids[near]), pa.list_(pa.int64())),
                 pa.array(scores, pa.list_(pa.float64()))],
                names=["v", "rep", "bound", "lists", "near", "scores"])

    listed = written(distinct.mapInArrow(assign, "v array<double>, rep long, ids array<long>, list long"), "lists")
    asked = written(rows.where(F.col("id") % every == 0).join(reps, "v").select("v", "rep", "id"), "asked")
    askers = asked.groupBy("rep").agg(F.first("v").alias("v")).select("v", "rep")
    asking = written(askers.mapInArrow(
        probe, "v array<double>, rep long, bound double, lists array<long>, near array<long>, scores array<double>"), "asking")
    probing = asking.select("v", "rep", "bound", F.explode("lists").alias("list"))
    # At most MAX_LISTS rows. Candidates go only to the queries that probe their list, in as many parts as these fill.
    sizes = written(listed.groupBy("list").agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("n_blocks")).join(
        probing.groupBy("list").agg(F.ceil(F.count("*") / QUERY_ROWS).alias("n_parts")), "list"), "sizes")

    def numbers(n):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    probes = probing.join(F.broadcast(sizes), "list").select(
        "v", "rep", "bound", F.pmod(F.xxhash64("rep"), "n_parts").alias("part"), "list", numbers("n_blocks").alias("block"))
    candidates = listed.join(F.broadcast(sizes), "list").select(
        "v", "rep", "ids", "list", F.pmod(F.xxhash64(F.lit(SEED), "rep"), "n_blocks").alias("block"),
        numbers("n_parts").alias("part"))
    keys = ["list", "block", "part"]
    found = candidates.groupBy(*keys).cogroup(probes.groupBy(*keys)).applyInArrow(
        _met(space), "query long, id long, score double")
    # What the sample gave counts as found, so that no query stays short.
    given = asking.select(F.col("rep").alias("query"), F.explode(F.arrays_zip("near", "scores")).alias("g")).select(
        "query", F.col("g.near").alias("id"), F.col("g.scores").alias("score"))
    found = found.unionByName(given).groupBy("query", "id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    top = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= NEAREST + 1)
    # Every row of a vector asks once; its own id is left out.
    ids = asked.select(F.col("id").alias("query_id"), F.col("rep").alias("query")).distinct()
    own = Window.partitionBy("query_id").orderBy("place")
    return ids.join(top, "query").where("id <> query_id").withColumn("rank", F.row_number().over(own)).where(
        F.col("rank") <= NEAREST).select("query_id", "rank", F.col("id").alias("vec_id"), "score")
