"""Sharding by a two-pass external shuffle.

First pass: every record goes whole to a shard and, inside it, to one of the shard's buckets, both by seeded
hashes; a shard has as many buckets as keep each at about ``BUCKET_BYTES``, so one fits in the memory of a task.
Second pass: each bucket is put in the order of a seeded Fisher-Yates shuffle and written as one
file; a shard is its buckets' files in turn. A bucket is sorted by draw first, so a lost task makes the same order again.

Rows that repeat in all columns would draw alike. Their hashes are counted first; such rows alone are counted as
whole rows, and each copy draws by its number, so any number of them spreads over the buckets of its shard.

Law ``key``: the id and the number of shards decide the shard. It is the highest score of seeded hashes, one for
each shard: one more shard takes rows only into itself, because all other scores stay.
Rows with equal ids share a shard, null ids too. Size is the UTF-8 bytes of the text (null: none)
plus 16 for the record. Null texts count as empty. An empty table gives no rows. A longer text than a bucket
is a bucket's one large row. Columns may have any names; maps, which Spark cannot compare, are refused.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from modelferry.llm.common import set_aside
from modelferry.session import scratch_path, written

SHARDS = 40
SEED = 5
RECORD_BYTES = 16
BUCKET_BYTES = 64 << 20
#: Rows of a bucket, for records that are almost empty.
BUCKET_ROWS = 50_000
LAW = "key"


def fisher_yates(n: int, seed) -> np.ndarray:
    """Places 0..n-1 for n rows: from the last place down, each is swapped with a random one up to it."""
    rng = np.random.default_rng(seed)
    order = np.arange(n)
    picks = np.floor(rng.random(n) * np.arange(1, n + 1)).astype(np.int64)
    for i in range(n - 1, 0, -1):
        j = picks[i]
        order[i], order[j] = order[j], order[i]
    return order


def scores(shards: int) -> tuple[Column, Column]:
    """The shard of ``doc_id`` among ``shards``, and among one more; ties go to the smaller number."""
    score = [F.xxhash64(F.lit(SEED), F.lit(i), F.col("doc_id")) for i in range(shards + 1)]
    best = F.greatest(*score[:shards]) if shards > 1 else score[0]
    now = F.coalesce(*[F.when(s == best, F.lit(i)) for i, s in enumerate(score[:shards])])
    return now, F.when(score[shards] > best, F.lit(shards)).otherwise(now)


def _size() -> Column:
    return (F.octet_length(F.coalesce("text", F.lit(""))) + RECORD_BYTES).cast("long")


def bucket_counts(docs: DataFrame, shards: int) -> list[int]:
    """How many buckets each shard needs for its bytes and rows."""
    now, _ = scores(shards)
    sums = docs.groupBy(now.alias("shard")).agg(F.sum(_size()).alias("bytes"), F.count("*").alias("n")).collect()
    counts = [1] * shards
    for r in sums:
        counts[r.shard] = max(1, -(-r.bytes // BUCKET_BYTES), -(-r.n // BUCKET_ROWS))
    return counts


def _numbered(docs: DataFrame) -> DataFrame:
    """The rows with ``__row``, a hash of all columns, and ``__copy``, their number among equal rows."""
    own = [F.col(f"`{c}`") for c in docs.columns]
    hashed = docs.withColumn("__row", F.xxhash64(*own))
    # Read back from files, so that its measured size decides how Spark joins it.
    often = written(hashed.groupBy("__row").count().where("count > 1").select("__row"), "repeated")
    alone = hashed.join(often, "__row", "left_anti").select(*own, "__row", F.lit(1).cast("long").alias("__copy"))
    counted = hashed.join(often, "__row", "left_semi").groupBy("__row", *own).agg(F.count("*").alias("__n"))
    return alone.unionByName(counted.select(*own, "__row", F.explode(F.sequence(F.lit(1).cast("long"), "__n")).alias("__copy")))


def _ordered(bucket: pa.Table) -> pa.Table:
    """One bucket with each record's place in its file."""
    rows = bucket.sort_by([("__draw", "ascending"), ("__row", "ascending"), ("__copy", "ascending")])
    shard, number = rows.column("shard")[0].as_py(), rows.column("bucket")[0].as_py()
    places = fisher_yates(rows.num_rows, [SEED, shard, number])
    return rows.drop_columns(["__draw", "__row", "__copy"]).append_column("__place", pa.array(places, pa.int64()))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> DataFrame:
    """Write the records with all columns in folders shard=n/bucket=m, one file a bucket, in its order; gives :func:`read_shards`.

    Columns of the documents that are called like a working one are written as ``<name>_own``.
    """
    docs = set_aside(docs, "shard bucket slot n before inside __row __copy __n __draw __place")
    own = [F.col(f"`{c}`") for c in docs.columns]
    now, _ = scores(shards)
    counts = F.array(*[F.lit(n).cast("long") for n in bucket_counts(docs, shards)])
    spread = _numbered(docs).select(
        *own, "__row", "__copy", now.alias("shard"), F.xxhash64(F.lit(SEED + 1), "__row", "__copy").alias("__draw")).withColumn(
        "bucket", F.pmod(F.col("__draw"), F.get(counts, F.col("shard"))))
    files = spread.select(*own, "shard", "bucket").schema
    # Sorted by its folders already, a task's part is written without another order.
    spread.groupBy("shard", "bucket").applyInArrow(_ordered, StructType([*files, StructField("__place", LongType())])).sortWithinPartitions(
        "shard", "bucket", "__place").drop("__place").write.option("maxRecordsPerFile", 0).partitionBy("shard", "bucket").parquet(path)
    return read_shards(docs.sparkSession, path, files)


def read_shards(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The written records with shard and slot, their place in the shard: rows of the buckets before theirs, and of their file."""
    files = spark.read.schema(schema).parquet(path)
    sizes = files.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = sizes.select("shard", "bucket", (F.sum("n").over(
        Window.partitionBy("shard").orderBy("bucket")) - F.col("n")).alias("before"))
    placed = files.select("*", F.col("_metadata.row_index").alias("inside"))
    return placed.join(before, ["shard", "bucket"]).withColumn("slot", F.col("before") + F.col("inside")).drop("before", "inside", "bucket")


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Shuffle the records into written shards, and give doc_id, size, text_crc32, law, shard, slot (gapless from 0) and
    grown_shard of each as it stands in its file."""
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    stands = write_shards(docs, scratch_path(docs.sparkSession, "shards"), shards)
    _, grown = scores(shards)
    return stands.select(
        "doc_id", _size().alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.lit(LAW).alias("law"),
        "shard", "slot", grown.alias("grown_shard"))
