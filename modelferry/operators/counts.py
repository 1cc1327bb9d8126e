"""Counts by run, by version and by experiment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelferry.functions.names import DEFAULT_MODEL_PATH
from modelferry.operators.joins import outer_lookup

COUNTS = ("params", "metrics", "model_files")


def run_counts(run_params: DataFrame, run_metrics: DataFrame, run_artifacts: DataFrame) -> DataFrame:
    """run_id, params, metrics, model_files.

    ``model_files`` are the direct children of the model folder. The three tables
    are stacked and summed once, so a run's rows meet only as partial sums.
    """
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")

    def counted(df: DataFrame, column: str) -> DataFrame:
        return df.select("run_id", *[(one if c == column else none).alias(c) for c in COUNTS])

    folder = f"{DEFAULT_MODEL_PATH}/"
    child = F.split_part(F.col("path"), F.lit("/"), F.lit(2))
    children = (
        run_artifacts.where(F.col("path").startswith(folder) & (F.col("path") != folder))
        .select("run_id", child.alias("child")).distinct()
    )
    stacked = (
        counted(run_params, "params")
        .unionByName(counted(run_metrics, "metrics"))
        .unionByName(counted(children, "model_files"))
    )
    return stacked.groupBy("run_id").agg(*[F.sum(c).alias(c) for c in COUNTS])


def with_counts(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """Rows with a run_id, plus its counts, 0 where there are none."""
    joined = rows.join(counts, "run_id", "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in COUNTS})


def version_counts(versions: DataFrame, runs: DataFrame, counts: DataFrame) -> DataFrame:
    """Counts attached to every version; a shared run counts for each.

    A version whose run is unreadable has none.
    """
    readable = with_counts(runs.select("run_id"), counts)
    looked = outer_lookup(
        versions.select("model_name", "version", "run_id"), readable, ["run_id"], ["model_name", "version"]
    )
    return looked.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in COUNTS})


def runs_per_experiment(runs: DataFrame, cap: int | None = None) -> DataFrame:
    """experiment_id, runs; a cap on runs limits the count (A3)."""
    n = F.count(F.lit(1))
    if cap is not None:
        n = F.least(n, F.lit(cap).cast("bigint"))
    return runs.groupBy("experiment_id").agg(n.alias("runs"))


def runs_per_model(versions: DataFrame, runs: DataFrame, per_experiment: DataFrame) -> DataFrame:
    """Sum over the distinct experiments of a model's versions (A3)."""
    pairs = (
        versions.where(F.col("run_id").isNotNull()).select("model_name", "run_id")
        .join(runs.select("run_id", "experiment_id"), "run_id")
        .select("model_name", "experiment_id").distinct()
    )
    return pairs.join(per_experiment, "experiment_id", "left").groupBy("model_name").agg(
        F.count(F.lit(1)).alias("experiments"),
        F.coalesce(F.sum("runs"), F.lit(0)).alias("runs"),
    )
