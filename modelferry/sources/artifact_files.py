"""Artifact files: listing and reading (S7, X1, X2). Copying is in ``file_copy``."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from functools import lru_cache, reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modelferry.operators.metadata import run_metadata
from modelferry.session import written

# Files lie at <root>/<run_id>/artifacts/<path>.
_MODEL_FILE = "model/MLmodel"
_REQUIREMENTS_FILE = "model/requirements.txt"
# Names that unfinished copies have.
PARTIAL = ".copying-"
# How each scheme is named by the file system library.
SCHEMES = {"file": "file", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "hdfs": "hdfs", "viewfs": "viewfs", "abfs": "abfs", "abfss": "abfss"}
# What a task looks into below one folder before it gives the rest back, and rows of one frame.
WALK_FOLDERS, WALK_ENTRIES, LISTED_AT_ONCE = 256, 20_000, 5_000


def _below(root: str, address: Column) -> Column:
    """The part of an address below the root. Both may be written with or without a scheme."""
    start = root.rstrip("/").split("://")[-1].removeprefix("file:") + "/"
    return F.substr(address, F.instr(address, start) + F.lit(len(start)))


def _placed(files: DataFrame, root: str) -> DataFrame:
    """run_id and path of addresses: the first '/artifacts/' below the root divides them."""
    below = _below(root, F.col("address"))
    run = F.split_part(below, F.lit("/artifacts/"), F.lit(1))
    inside = F.substr(below, F.length(run) + F.lit(len("/artifacts/") + 1))
    rest = [c for c in files.columns if c != "address"]
    return files.select(run.alias("run_id"), inside.alias("path"), "address", *rest).where(F.col("path") != "")


def _contents(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """Files of one name with their content."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    found = reader.load(root).select(
        F.col("path").alias("address"), F.col("length").alias("size_bytes"), "content")
    return _placed(found, root)


def walk(address: str, list_folder, folders: int, entries: int) -> Iterator[tuple[str, bool, int]]:
    """(address, is_folder, size_bytes) of the files below a folder, level by level.

    After ``folders`` folders or ``entries`` names, those not yet looked into are given back as folders.
    """
    waiting, seen = deque([address]), 0
    while waiting and folders > 0 and seen < entries:
        folders -= 1
        for place, is_folder, size in list_folder(waiting.popleft()):
            seen += 1
            if is_folder:
                waiting.append(place)
            else:
                yield place, False, size
    for place in waiting:
        yield place, True, 0


def _names(address: str) -> list[tuple[str, bool, int]]:
    """What lies in a folder. Every name counts."""
    from pyarrow import fs

    system, path = locate(address)
    start, base = len(path.rstrip("/")), address.rstrip("/")
    return [(base + i.path[start:], i.type == fs.FileType.Directory, i.size or 0) for i in system.get_file_info(fs.FileSelector(path))]


def _walked(subtrees: DataFrame) -> DataFrame:
    """Files below the folders (``address``), and the folders that are left over."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple[str, bool, int]] = []
        for batch in batches:
            for address in batch["address"]:
                for row in walk(address, _names, WALK_FOLDERS, WALK_ENTRIES):
                    rows.append(row)
                    if len(rows) == LISTED_AT_ONCE:
                        yield pd.DataFrame(rows, columns=["address", "is_folder", "size_bytes"])
                        rows = []
        if rows:
            yield pd.DataFrame(rows, columns=["address", "is_folder", "size_bytes"])

    return subtrees.select("address").mapInPandas(run, "address string, is_folder boolean, size_bytes long")


def list_artifacts(spark: SparkSession, root: str) -> DataFrame:
    """run_id, path, size_bytes, address of every file, whatever its name; contents are not read.

    Each task walks subtrees up to a budget and gives the rest back, which the next round deals out anew. So neither the
    driver nor a task holds a tree, a wide folder is spread after one round, and a deep tree takes no round for each
    level. Left-over files of broken copies are passed over.
    """
    locate(root)
    subtrees, found = spark.createDataFrame([(root.rstrip("/"),)], "address string"), []
    left = 1
    while left:
        # As many tasks as there are subtrees, up to what the session runs at once several times over.
        tasks = min(left, 4 * spark.sparkContext.defaultParallelism)
        round_ = written(_walked(subtrees.repartition(tasks, "address") if left > 1 else subtrees), "listing")
        found.append(round_.where(~F.col("is_folder")))
        subtrees = round_.where("is_folder")
        left = subtrees.count()
    files = reduce(DataFrame.unionByName, found)
    files = files.where(~F.split_part("address", F.lit("/"), F.lit(-1)).startswith(PARTIAL))
    return _placed(files.select("address", "size_bytes"), root).select("run_id", "path", "size_bytes", "address")


def read_metadata(spark: SparkSession, root: str) -> DataFrame:
    """Flavors, requirements and Python version by run."""
    models = _contents(spark, root, "MLmodel").where(F.col("path") == _MODEL_FILE)
    needs = _contents(spark, root, "requirements.txt").where(F.col("path") == _REQUIREMENTS_FILE)
    return run_metadata(models, needs)


@lru_cache(maxsize=64)
def _filesystem(root: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(root)


def locate(address: str):
    """(file system, path) of an address, as Spark writes it: characters are not escaped.

    An address without a scheme must be absolute. Any scheme that is not listed in
    ``SCHEMES`` is refused, so that a file never lands on the disk of an executor
    by mistake. File systems are kept by authority, so a task connects once to each store.
    """
    scheme, colon, rest = address.partition(":")
    if not colon or "/" in scheme:
        scheme, rest = "file", address
    if scheme not in SCHEMES:
        raise ValueError(f"cannot reach {address}: the scheme must be one of {', '.join(sorted(SCHEMES))}")
    if scheme == "file":
        if not rest.startswith("/"):
            raise ValueError(f"{address} is not absolute")
        return _filesystem("file:///")[0], "/" + rest.lstrip("/")
    if not rest.startswith("//"):
        raise ValueError(f"{address} names no store")
    store, _, key = rest[2:].partition("/")
    system, base = _filesystem(f"{SCHEMES[scheme]}://{store}/")
    return system, f"{base.rstrip('/')}/{key}"
