"""Session settings the jobs rely on."""

from __future__ import annotations

import os
import shutil
import tempfile
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# What correctness and skew handling need; sizes are left to the cluster.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where that costs a shuffle for what follows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Ids are hexadecimal digests, of which this takes half the space.
    "spark.sql.parquet.compression.codec": "zstd",
    # Groups a task gathers texts for by hash before it sorts instead.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "8192",
}

CHECKPOINT_SETTING = "spark.checkpoint.dir"
# Whether Spark removes the shuffle files of an execution when it ends.
SHUFFLES_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_shipped: set[tuple[str, str]] = set()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a running session, and give its tasks this package."""
    for name, value in REQUIRED.items():
        spark.conf.set(name, value)
    ship(spark, os.path.dirname(os.path.abspath(__file__)))
    return spark


def ship(spark: SparkSession, package: str) -> None:
    """Send a package folder to the executors, once by application.

    File copies and model descriptions run there and import it, wherever the
    driver was started.
    """
    key = (spark.sparkContext.applicationId, package)
    if key not in _shipped:
        name = os.path.basename(package)
        made = os.path.join(tempfile.mkdtemp(prefix="run-", dir="/tmp"), name)
        archive = shutil.make_archive(made, "zip", os.path.dirname(package), name)
        spark.sparkContext.addPyFile(archive)
        _shipped.add(key)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see. A local one is made only where all runs in one process."""
    named = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder that all executors of {master} see")
    made = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(made)
    return made


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    made = f"{shared_folder(spark).rstrip('/')}/{name}-{os.urandom(8).hex()}"
    for block in _blocks():
        block[made] = False
    return made


_thread = threading.local()


def _blocks() -> list[dict[str, bool]]:
    """Paths handed out in each open ``cleared`` block of this thread, outermost first, and whether they are kept."""
    if not hasattr(_thread, "blocks"):
        _thread.blocks = []
    return _thread.blocks


@contextmanager
def cleared(spark: SparkSession) -> Iterator[None]:
    """Removes what this thread stages inside the block once it ends; after an error what it kept as well.

    For jobs that leave their results elsewhere: a DataFrame that reads what was staged inside may not be used
    afterwards, unless :func:`kept` wrote it.
    """
    made: dict[str, bool] = {}
    _blocks().append(made)
    ended = False
    try:
        yield
        ended = True
    finally:
        _blocks().pop()
        for path, keep in made.items():
            if not (keep and ended):
                _remove(spark, path)


def kept(df: DataFrame, name: str) -> DataFrame:
    """Like :func:`written`, but outlives the innermost ``cleared`` block."""
    path = scratch_path(df.sparkSession, name)
    if _blocks():
        _blocks()[-1][path] = True
    return _stored(df, path)


def _remove(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read back from a table in the shared folder.

    Cuts the lineage where a result feeds several jobs; a lost executor then
    costs a read, not a second run.
    """
    return _stored(df, scratch_path(df.sparkSession, name))


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes inside remove their shuffle files as they end.

    Else these stay until the driver's garbage collector finds the plan unused, which on a large heap may be after the whole
    job. Nothing reads them again: who needs the rows reads what was written.
    """
    before = spark.conf.get(SHUFFLES_SETTING, "false")
    spark.conf.set(SHUFFLES_SETTING, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLES_SETTING, before)


def _stored(df: DataFrame, path: str) -> DataFrame:
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
