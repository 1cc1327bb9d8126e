"""Discovery and inventory of a source registry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from modelferry.operators import inventory as inv
from modelferry.operators import scope
from modelferry.operators.counts import run_counts
from modelferry.operators.references import dangling, referenced_experiments
from modelferry.operators.upsert import merge_inventory
from modelferry.options import Options
from modelferry.schemas import Snapshot
from modelferry.sources.tracking_store import TrackingStore


@dataclass(frozen=True)
class Discovery:
    """What one run of the job deals with; all lazy.

    ``versions`` are capped for migration, ``all_versions`` are not.
    """

    models: DataFrame
    versions: DataFrame
    all_versions: DataFrame
    experiments: DataFrame
    runs: DataFrame


Stage = Callable[[DataFrame, str], DataFrame]


def lazily(df: DataFrame, name: str) -> DataFrame:
    """No staging: everything stays one plan."""
    return df


def discover(snapshot: Snapshot, options: Options, stage: Stage = lazily) -> Discovery:
    """Scope, cap and resolve a snapshot."""
    models = scope.allow_models(scope.scope_models(snapshot.models), list(options.model_names))
    in_scope = scope.of_models(snapshot.versions, models) if stage is lazily else _in_scope(snapshot, models, options, stage)
    versions = scope.cap_versions(in_scope, options.max_versions_per_model)
    if options.migrate_experiments:
        experiments = referenced_experiments(
            versions, snapshot.runs, snapshot.experiments, options.extra_experiment_ids
        )
    else:
        experiments = scope.nothing(snapshot.experiments)
    experiments = stage(experiments, "experiments")
    listed = snapshot.runs.join(experiments.select("experiment_id"), "experiment_id", "left_semi")
    runs = scope.cap_runs(
        scope.lifecycle(listed.select(*snapshot.runs.columns), options.include_deleted_runs),
        options.max_runs_per_experiment,
    )
    return Discovery(models, versions, in_scope, experiments, runs)


def _in_scope(snapshot: Snapshot, models: DataFrame, options: Options, stage: Stage) -> DataFrame:
    """Versions of the models. Scope is a filter on names; versions whose model is lost are few, and known once their names
    are staged, so the versions need not move."""
    versions = scope.allow_models(scope.scope_models(snapshot.versions), list(options.model_names))
    lost = versions.select("model_name").distinct().join(models.select("model_name"), "model_name", "left_anti")
    return versions.where("model_name is not null").join(stage(lost, "lost-models"), "model_name", "left_anti")


def lost_references(snapshot: Snapshot, found: Discovery, options: Options) -> DataFrame:
    """References of the discovered versions that lead nowhere."""
    return dangling(
        found.versions, snapshot.runs, snapshot.experiments, options.extra_experiment_ids
    )


def inventory_report(
    snapshot: Snapshot, options: Options, target_host: str,
    metadata: DataFrame | None = None, failures: DataFrame | None = None, now: Column | None = None,
    requirements: DataFrame | None = None,
) -> DataFrame:
    """The inventory of the models in scope, with error rows where reading failed."""
    found = discover(snapshot, options)
    counts = run_counts(snapshot.run_params, snapshot.run_metrics, snapshot.run_artifacts)
    # Without a cap every existing experiment of a version is in reach.
    capped = options.max_versions_per_model is not None
    # Scope is a filter on names here; versions without a model drop out at the end.
    versions = scope.allow_models(scope.scope_models(snapshot.versions), list(options.model_names))
    scoped = snapshot.with_tables(models=found.models, versions=versions)
    rows = inv.inventory(
        scoped, counts, options, target_host, found.experiments if capped else None, metadata, now, requirements
    )
    if failures is None:
        return rows
    errors = inv.error_rows(
        scope.of_models(failures, found.models), snapshot.host, target_host, now
    )
    return inv.with_error_rows(rows, errors)


def track_inventory(rows: DataFrame, store: TrackingStore, now: Column | None = None) -> None:
    """Upsert an inventory into the tracking table."""
    store.create()
    store.update(lambda tracking: merge_inventory(tracking, rows, now))
