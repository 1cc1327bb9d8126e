"""What several operators share: tables, Arrow batches, byte arrays of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from modelferry.session import configure

# Rows of one Arrow batch; texts can be long, and a Python worker has little memory.
BATCH_ROWS = 512
# Bytes of text that array operators work on at once.
CHUNK_BYTES = 1 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings for the operators; sends the package to the executors."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free(name: str, docs: DataFrame) -> str:
    """``name``, or the first longer one that no column of ``docs`` has."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def set_aside(docs: DataFrame, working: str) -> DataFrame:
    """The documents with other names for columns that are called like a working one; ``toDF`` names them back."""
    taken = working.split()
    names: list[str] = []
    for c in docs.columns:
        names.append(free(f"{c}_own", docs) if c.lower() in taken else c)
    return docs.toDF(*names)


def raw(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes, null as empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of whole texts: (first row, their bytes end to end, their bounds).

    A run holds at most ``most`` bytes, or one longer text. Null counts as empty.
    """
    texts = raw(column)
    first, size = 0, 0
    for i, t in enumerate(texts + [b"\0" * 0]):
        last = i == len(texts)
        if last or (size and size + len(t) > most):
            if i > first:
                run = texts[first:i]
                bounds = np.zeros(len(run) + 1, np.int64)
                np.cumsum([len(x) for x in run], out=bounds[1:])
                yield first, np.frombuffer(b"".join(run), np.uint8), bounds
            first, size = i, 0
        size += len(t)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_CODES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = 0x9FB21C651E98DF25


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of data[start:end] of each run; runs do not overlap, in order."""
    lengths = ends - starts
    out = np.zeros(len(starts), np.uint64)
    full = np.flatnonzero(lengths)
    if not len(full):
        return out
    lengths = lengths[full]
    firsts = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(firsts, lengths)
    powers = np.full(int(lengths.max()), _BASE, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    values = BYTE_CODES[data[place + np.repeat(starts[full], lengths)]] * powers[place]
    out[full] = mixed(np.add.reduceat(values, firsts) + lengths.astype(np.uint64))
    return out


def words_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the words of texts that lie end to end."""
    inside = ~IS_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = bounds[:-1][np.diff(bounds) > 0]
    begins[cuts] = inside[cuts]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    stops[cuts[cuts > 0] - 1] = inside[cuts[cuts > 0] - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(bounds, starts, "right") - 1


def per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many flags are set in each text."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]
