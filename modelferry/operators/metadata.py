"""What model files say about a model."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelferry.functions.text import requirement_lines

MLMODEL_SCHEMA = "run_id string, flavors string, python_version string"


def _describe(content: bytes) -> tuple[str | None, str | None]:
    """Flavors in file order and the Python version; (None, None) when unreadable."""
    import yaml

    try:
        flavors = yaml.safe_load(content).get("flavors", {})
        names = ", ".join(flavors.keys())
    except Exception:  # any malformed file is simply without metadata
        return None, None
    try:
        version = flavors.get("python_function", {}).get("python_version")
    except Exception:
        version = None
    return names, None if version is None else str(version)


def _describe_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        pairs = [_describe(c) for c in batch["content"]]
        yield pd.DataFrame({
            "run_id": batch["run_id"],
            "flavors": [p[0] for p in pairs],
            "python_version": [p[1] for p in pairs],
        })


def model_flavors(files: DataFrame) -> DataFrame:
    """(run_id, content) of MLmodel files -> flavors, python_version."""
    return files.select("run_id", "content").mapInPandas(_describe_batches, MLMODEL_SCHEMA)


def model_requirements(files: DataFrame) -> DataFrame:
    """(run_id, content) of requirements files -> requirements."""
    return files.select("run_id", requirement_lines(F.col("content").cast("string")).alias("requirements"))


def run_metadata(mlmodel_files: DataFrame, requirement_files: DataFrame) -> DataFrame:
    """run_id, flavors, requirements, python_version, for the inventory."""
    return model_flavors(mlmodel_files).join(
        model_requirements(requirement_files), "run_id", "full_outer"
    ).select("run_id", "flavors", "requirements", "python_version")
