"""Folder listings through the Hadoop file system, on the driver.

Only commit folders are listed here, never data files or artifacts.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _hadoop(spark, path)
    return system.exists(where)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``, sorted."""
    system, where = _hadoop(spark, path)
    if not system.exists(where):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(where) if s.isDirectory())


def names(spark: SparkSession, path: str) -> list[str] | None:
    """Names directly below ``path``, sorted; None where there is no such folder."""
    system, where = _hadoop(spark, path)
    if not system.exists(where):
        return None
    return sorted(s.getPath().getName() for s in system.listStatus(where))


def mark(spark: SparkSession, path: str) -> None:
    """Create a folder as a sign that something is complete."""
    system, where = _hadoop(spark, path)
    if not system.mkdirs(where):
        raise OSError(f"cannot create {path}")


def claim(spark: SparkSession, path: str) -> None:
    """Create an empty file that must not exist yet; of two callers one fails."""
    system, where = _hadoop(spark, path)
    system.create(where, False).close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder or file with all below it, if it is there."""
    system, where = _hadoop(spark, path)
    system.delete(where, True)
