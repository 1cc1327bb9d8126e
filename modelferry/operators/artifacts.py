"""Which files move, and where to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelferry.functions.names import folders_above, parent_path
from modelferry.functions.text import strip_space


def in_folders(files: DataFrame, folders: DataFrame, with_itself: bool = True) -> DataFrame:
    """Files with each of the (run_id, model_path) folders they lie in.

    Each file is laid out by the folders above it and these are looked up, so
    files and folders of a large run never meet as pairs. A folder may also be
    the file itself.
    """
    laid = files.withColumn("model_path", F.explode(folders_above(F.col("path"), with_itself)))
    return laid.join(folders, ["run_id", "model_path"])


def artifact_manifest(
    judged: DataFrame, mapped: DataFrame, source_artifacts: DataFrame, target_artifacts: DataFrame,
    download_artifacts: bool = True, include_run_artifacts: bool = True,
) -> DataFrame:
    """run_id, target_run_id, path, parent, size_bytes of every file to copy.

    Always the model files of versions being cloned, unless the target has their
    folder already. With both flags also every file of newly cloned runs. Files
    with a blank path, and files the target holds, are left out.
    """
    files = source_artifacts.where(strip_space(F.col("path")) != "").select("run_id", "path", "size_bytes")
    folders = judged.where(F.col("reason").isNull() & ~F.col("on_target")).select(
        "run_id", "target_run_id", "model_path"
    ).distinct()
    wanted = in_folders(files, folders).select("run_id", "target_run_id", "path", "size_bytes")
    if download_artifacts and include_run_artifacts:
        fresh = mapped.where(F.col("is_new")).select("run_id", "target_run_id")
        wanted = wanted.unionByName(
            files.join(fresh, "run_id").select("run_id", "target_run_id", "path", "size_bytes")
        )
    held = target_artifacts.select(F.col("run_id").cast("string").alias("target_run_id"), "path")
    return (
        wanted.dropDuplicates(["target_run_id", "path"])
        .join(held, ["target_run_id", "path"], "left_anti")
        .select("run_id", "target_run_id", "path", parent_path(F.col("path")).alias("parent"), "size_bytes")
    )
