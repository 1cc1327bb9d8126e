"""What belongs to a run of the job: filters, caps, restriction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelferry.functions.names import is_reserved_tag
from modelferry.functions.text import WHITE_SPACE, strip_space
from modelferry.operators.ranking import first_rows, sampled_segments, version_segments
from modelferry.schemas import Snapshot

ACTIVE = "active"


def scope_models(models: DataFrame) -> DataFrame:
    """Drop three-level names (P1); any table with ``model_name`` will do."""
    return models.where(~F.col("model_name").contains("."))


def allow_models(models: DataFrame, names) -> DataFrame:
    """Keep allowed names; both sides are stripped, and an empty list allows all.

    ``names`` is a list given by a person, or a DataFrame with ``model_name``.
    """
    if isinstance(names, DataFrame):
        wanted = names.select(strip_space(F.col("model_name")).alias("_name")).distinct()
        return models.withColumn("_name", strip_space(F.col("model_name"))).join(
            wanted, "_name", "left_semi"
        ).select(*models.columns)
    stripped = {n.strip(WHITE_SPACE) for n in names}
    if not stripped:
        return models
    return models.where(strip_space(F.col("model_name")).isin(*stripped))


def of_models(rows: DataFrame, models: DataFrame) -> DataFrame:
    """Rows of the given models."""
    return rows.join(models.select("model_name"), "model_name", "left_semi").select(*rows.columns)


def cap_versions(versions: DataFrame, n: int | None) -> DataFrame:
    """At most ``n`` versions a model, newest first; None keeps all."""
    if n is None:
        return versions
    return first_rows(
        versions, ["model_name"], [F.desc("version")], n,
        lambda df: version_segments(df, newest_first=True),
    )


def cap_runs(runs: DataFrame, n: int | None) -> DataFrame:
    """At most ``n`` runs an experiment, latest start first; None keeps all."""
    if n is None:
        return runs
    # Largest first as an ascending number, runs without a start last.
    age = F.coalesce(-F.col("start_ms"), F.lit(2**63 - 1)).alias("age")
    return first_rows(
        runs.where(F.col("experiment_id").isNotNull()), ["experiment_id"],
        [F.desc_nulls_last("start_ms"), F.asc("run_id")], n,
        lambda df: sampled_segments(df, [age, F.col("run_id")]),
    )


def lifecycle(runs: DataFrame, include_deleted: bool) -> DataFrame:
    """Active runs, or all of them (P5)."""
    return runs if include_deleted else runs.where(F.col("lifecycle") == ACTIVE)


def drop_reserved_tags(tags: DataFrame) -> DataFrame:
    """Tags of runs and experiments that may be copied."""
    return tags.where(~is_reserved_tag(F.col("key")))


def nothing(df: DataFrame) -> DataFrame:
    """No rows, same schema: an entity that is switched off."""
    return df.where(F.lit(False))


def restrict(snapshot: Snapshot, names: DataFrame) -> Snapshot:
    """The snapshot with only the named models and their versions.

    Runs and experiments stay whole; they are reached through versions.
    """
    models = allow_models(snapshot.models, names)
    return snapshot.with_tables(models=models, versions=of_models(snapshot.versions, models))


def with_runs_of(snapshot: Snapshot, names: DataFrame) -> Snapshot:
    """The versions of the models with these exact names, their runs, and what belongs to both; the rest stays whole."""
    def only(df: DataFrame | None, keys: DataFrame, key: str) -> DataFrame | None:
        return None if df is None else df.join(keys, key, "left_semi")

    versions = only(snapshot.versions, names, "model_name")
    runs = versions.where(F.col("run_id").isNotNull()).select("run_id").distinct()
    tables = ("runs", "run_params", "run_metrics", "run_artifacts", "run_tags")
    return snapshot.with_tables(
        versions=versions, version_tags=only(snapshot.version_tags, names, "model_name"),
        **{t: only(getattr(snapshot, t), runs, "run_id") for t in tables})
