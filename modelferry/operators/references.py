"""From versions to runs to experiments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelferry.functions.names import target_experiment_name
from modelferry.operators.joins import outer_lookup

NO_RUN, READY, BLOCKED = "NO_RUN", "READY", "BLOCKED"
RUN_MISSING = "run missing"


def version_states(versions: DataFrame, runs: DataFrame) -> DataFrame:
    """Versions with their run's columns and ``run_state``.

    A version without run_id counts as ready; one whose run is gone is blocked.
    """
    looked = outer_lookup(
        versions, runs.withColumn("_found", F.lit(True)), ["run_id"], ["model_name", "version"]
    )
    state = (
        F.when(F.col("run_id").isNull(), NO_RUN)
        .when(F.col("_found"), READY)
        .otherwise(BLOCKED)
    )
    return looked.withColumn("run_state", state).drop("_found")


def _used_experiments(versions: DataFrame, runs: DataFrame) -> DataFrame:
    """Distinct experiments of the runs that versions point to."""
    pointed = versions.where(F.col("run_id").isNotNull()).select("run_id").distinct()
    return pointed.join(runs.select("run_id", "experiment_id"), "run_id").select(
        "experiment_id"
    ).distinct()


def _wanted_experiments(versions: DataFrame, runs: DataFrame, extra_ids) -> DataFrame:
    used = _used_experiments(versions, runs)
    if not extra_ids:
        return used
    id_type = runs.schema["experiment_id"].dataType
    listed = runs.sparkSession.createDataFrame([(str(i),) for i in extra_ids], "experiment_id string")
    listed = listed.select(F.col("experiment_id").cast(id_type))
    return used.union(listed).distinct()


def referenced_experiments(
    versions: DataFrame, runs: DataFrame, experiments: DataFrame, extra_ids=()
) -> DataFrame:
    """Existing experiments that versions' runs or ``extra_ids`` name."""
    wanted = _wanted_experiments(versions, runs, extra_ids)
    return experiments.join(wanted, "experiment_id", "left_semi").select(*experiments.columns)


def dangling(
    versions: DataFrame, runs: DataFrame, experiments: DataFrame, extra_ids=()
) -> DataFrame:
    """References that lead nowhere: kind, model_name, version, id, message."""
    lost_runs = (
        versions.where(F.col("run_id").isNotNull())
        .join(runs.select("run_id"), "run_id", "left_anti")
        .select(
            F.lit("version_run").alias("kind"), "model_name", "version",
            F.col("run_id").cast("string").alias("id"),
            F.concat(
                "model_name", F.lit(" version "), F.col("version").cast("string"),
                F.lit(" points to run "), F.col("run_id").cast("string"), F.lit(", which is lost"),
            ).alias("message"),
        )
    )
    no_name = F.lit(None).cast("string")
    no_version = F.lit(None).cast("int")
    lost_experiments = (
        _wanted_experiments(versions, runs, extra_ids)
        .join(experiments.select("experiment_id"), "experiment_id", "left_anti")
        .select(
            F.lit("run_experiment").alias("kind"),
            no_name.alias("model_name"), no_version.alias("version"),
            F.col("experiment_id").cast("string").alias("id"),
            F.concat(
                F.lit("wanted experiment "), F.col("experiment_id").cast("string"), F.lit(" is lost"),
            ).alias("message"),
        )
    )
    return lost_runs.unionByName(lost_experiments)


def named_experiments(
    versions: DataFrame, runs: DataFrame, experiments: DataFrame, root: str, prefix: str = ""
) -> DataFrame:
    """Experiments used by versions, '(id: X)' when gone, with target name."""
    used = _used_experiments(versions, runs)
    return used.join(experiments.select("experiment_id", "name"), "experiment_id", "left").select(
        "experiment_id",
        experiment_label(F.col("name"), F.col("experiment_id")).alias("experiment_name"),
        target_experiment_name(F.col("name"), root, prefix).alias("target_name"),
    )


def experiment_label(name, experiment_id):
    """Name, or the id in words, in a fixed form."""
    return F.coalesce(name, F.concat(F.lit("(id: "), experiment_id.cast("string"), F.lit(")")))
