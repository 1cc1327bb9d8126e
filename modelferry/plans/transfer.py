"""Migration of a source registry into a target registry."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelferry.functions.names import normal_host, target_model_name
from modelferry.operators import rewrite as rw
from modelferry.operators import retries, scope
from modelferry.operators.artifacts import artifact_manifest, in_folders
from modelferry.operators.counts import run_counts
from modelferry.operators.joins import outer_lookup
from modelferry.operators.reconcile import model_outcomes, reconcile, target_rollup
from modelferry.operators.upsert import apply_outcomes, pending
from modelferry.options import Options
from modelferry.plans.survey import Discovery, Stage, discover, lazily
from modelferry.schemas import Snapshot
from modelferry.session import cleared, kept, written
from modelferry.sources.file_copy import copy_artifacts
from modelferry.sources.registry import read_registry, write_registry
from modelferry.sources.retry_queue import read_queue, write_queue
from modelferry.sources.tracking_store import TrackingStore


# What of a version goes on to the target; it gets a creation time of its own.
VERSION = ("model_name", "version", "run_id", "user_id", "stage", "model_path", "description")
# What of a run goes on; its name is a tag, and files' addresses are looked up where they are copied.
RUN = ("run_id", "experiment_id", "run_user", "status", "lifecycle", "start_ms", "end_ms")
# What tracking and reports read of a verdict.
VERDICT = ("model_name", "version", "reason")


def with_target_model(versions: DataFrame, options: Options) -> DataFrame:
    """With ``target_model``, which follows from the name and so is not stored."""
    return versions.withColumn("target_model", target_model_name(F.col("model_name"), options.model_prefix))


def _with_ids(places: DataFrame, source: Snapshot, options: Options) -> DataFrame:
    return rw.placed_artifacts(rw.run_ids(places, source.host), options.artifact_root)


@dataclass(frozen=True)
class Transfer:
    """What one migration deals with.

    ``versions`` are those to clone; ``mapping`` and ``mapped`` say where
    experiments and runs go, ``places`` says it without the runs' target ids. ``stage`` got all that feeds many tables.
    """

    source: Snapshot
    target: Snapshot
    options: Options
    found: Discovery
    stage: Stage
    versions: DataFrame
    mapping: DataFrame
    places: DataFrame
    mapped: DataFrame

    def judged(self, *only: str) -> DataFrame:
        """Versions with target run, model path and failure reason, staged; with ``only``, these columns alone."""
        verdicts = rw.judged_versions(
            self.versions.drop("target_model"), self.places, self.source.run_artifacts, self.target.run_artifacts,
            lambda places: _with_ids(places, self.source, self.options),
        )
        return with_target_model(self.stage(verdicts.select(*only) if only else verdicts, "judged"), self.options)

    def manifest(self, judged: DataFrame) -> DataFrame:
        """Files to copy for the versions and the new runs."""
        return artifact_manifest(
            judged, self.mapped, self.source.run_artifacts, self.target.run_artifacts,
            self.options.download_artifacts, self.options.include_run_artifacts,
        )


def plan_transfer(
    source: Snapshot, target: Snapshot, options: Options, stage: Stage = lazily
) -> Transfer:
    """Decide what is new, where it goes, and what cannot be created.

    ``stage`` gets the results that feed many tables; :func:`written` puts them
    into the shared folder, so that they are worked out once.
    """
    found = discover(source, options, stage)
    versions = rw.new_versions(
        rw.with_model_path(found.versions).select(*VERSION), target.versions, source.host, options.model_prefix,
        options.skip_existing_versions,
    )
    if not options.migrate_models:
        versions = scope.nothing(versions)
    versions = with_target_model(stage(versions.drop("target_model"), "to-clone"), options)
    experiments = found.experiments
    if not options.migrate_experiments:
        # Only the experiments that versions need are made, on demand.
        pointed = versions.where(F.col("run_id").isNotNull()).select("run_id")
        used = source.runs.join(pointed.distinct(), "run_id", "left_semi").select("experiment_id").distinct()
        experiments = source.experiments.join(used, "experiment_id", "left_semi")
    mapping = rw.experiment_map(
        experiments.select(*source.experiments.columns), target.experiments,
        options.experiment_root, options.experiment_prefix, options.create_missing_experiments,
    )
    candidates = rw.candidate_runs(found.runs.select(*RUN), source.runs, versions)
    places = stage(rw.run_places(candidates, mapping, target.runs, source.host), "run-map")
    return Transfer(source, target, options, found, stage, versions, mapping, places, _with_ids(places, source, options))


def with_addresses(manifest: DataFrame, mapped: DataFrame, source: Snapshot) -> DataFrame:
    """The manifest with source and target file addresses."""
    homes = source.runs.select("run_id", F.col("artifact_uri").alias("_home"))
    places = mapped.select("run_id", F.col("target_artifact_uri").alias("_place"))
    return manifest.join(homes, "run_id").join(places, "run_id").withColumns({
        "source_address": F.concat_ws("/", "_home", "path"),
        "target_address": F.concat_ws("/", "_place", "path"),
    }).drop("_home", "_place")


def fail_uncopied(judged: DataFrame, copied: DataFrame) -> DataFrame:
    """Versions whose model files could not be copied become failures.

    ``copied`` is the manifest with ok and error. Other files may fail alone.
    """
    lost = copied.where(~F.col("ok")).select("run_id", "path", F.col("error").alias("_error"))
    depends = F.col("reason").isNull() & ~F.col("on_target")
    waiting = judged.where(depends)
    hit = waiting.select("run_id", "model_path").distinct()
    broken = in_folders(lost, hit).groupBy("run_id", "model_path").agg(F.min("_error").alias("_error"))
    failed = F.concat(
        F.lit("Model artifacts of run "), F.col("run_id").cast("string"),
        F.lit(" cannot be copied: "), F.col("_error"),
    )
    looked = outer_lookup(waiting, broken, ["run_id", "model_path"], ["model_name", "version"]).withColumn(
        "reason", F.left(failed, F.lit(rw.REASON_LENGTH))).drop("_error")
    # The others' verdicts stand, so they stay where they are.
    return looked.unionByName(judged.where(~depends))


def assumed_copied(manifest: DataFrame) -> DataFrame:
    """The manifest as if all files had been copied."""
    return manifest.withColumns({"ok": F.lit(True), "bytes": F.col("size_bytes"), "error": F.lit(None).cast("string")})


@dataclass(frozen=True)
class Outcome:
    """Results of a finished transfer, read back from what was written."""

    summary: DataFrame
    failures: DataFrame
    created_versions: DataFrame
    copied: DataFrame
    run_failures: DataFrame
    file_failures: DataFrame


def run_transfer(
    source: Snapshot, target: Snapshot, options: Options, target_path: str, commit: str,
    copy_files: bool = True, now: Column | None = None,
) -> Outcome:
    """Copy the files, write all records as one commit, and sum up.

    Files that failed earlier and are due at ``now`` are copied along (R10). With ``copy_files`` off the
    manifest is recorded as if it had been copied. What was staged on the way is removed; the outcome's tables stay.
    """
    if copy_files and not options.artifact_root:
        raise ValueError("set artifact_root, the address below which copied files go")
    with cleared(source.models.sparkSession):
        return _transferred(source, target, options, target_path, commit, copy_files, now)


def _transferred(
    source: Snapshot, target: Snapshot, options: Options, target_path: str, commit: str, copy_files: bool, now: Column | None,
) -> Outcome:
    plan = plan_transfer(source, target, options, written)
    mapped, judged = plan.mapped, plan.judged()
    manifest = plan.manifest(judged)
    if copy_files:
        queue = read_queue(source.models.sparkSession, target_path)
        wanted = retries.with_due(with_addresses(manifest, mapped, source), queue, target.run_artifacts, now)
        copied = kept(copy_artifacts(wanted, options.copy_threads), "copied")
        judged = fail_uncopied(judged, copied)
    else:
        copied = kept(assumed_copied(manifest), "copied")
    host = source.host
    created = kept(rw.target_versions(judged, target.versions, host, now), "created")
    failures = kept(rw.version_failures(judged), "failures")
    models = plan.found.models if options.migrate_models else scope.nothing(plan.found.models)
    fresh = rw.target_models(rw.new_models(models, target.models, options.model_prefix), host, now)
    records = {
        "run_params": rw.target_params(mapped, source.run_params),
        "run_metrics": rw.target_metrics(mapped, source.run_metrics),
        "metric_points": rw.metric_history(mapped, source.run_metrics, source.metric_points, written),
        "run_tags": rw.target_run_tags(mapped, source.run_tags, host),
        "run_artifacts": copied.where("ok").select(F.col("target_run_id").alias("run_id"), "path", "size_bytes"),
        "experiment_tags": rw.target_experiment_tags(plan.mapping, source.experiment_tags, host),
        "experiments": rw.target_experiments(plan.mapping, host),
        "runs": rw.target_runs(mapped, source.run_tags, host),
        "version_tags": rw.target_version_tags(created, source.version_tags, host),
        "versions": created,
        "model_tags": rw.target_model_tags(models, fresh, source.model_tags, host, options.model_prefix),
        "models": fresh,
    }
    write_registry(records, target_path, host, commit)
    if copy_files:
        # After the commit: a file that is queued and held as well leaves the queue next time.
        write_queue(retries.next_queue(queue, copied, target.run_artifacts, now), target_path)
    experiments = plan.mapping if options.migrate_experiments else scope.nothing(plan.mapping)
    summary = kept(rw.migration_summary(models, experiments, created), "summary")
    return Outcome(summary, failures, created, copied, kept(rw.run_failures(mapped), "run-failures"), rw.file_failures(copied))


def migrate_all(
    source: Snapshot, target_path: str, target_host: str, options: Options, commit: str,
    copy_files: bool = True, now: Column | None = None,
) -> Outcome:
    """Migrate everything in scope."""
    target = rw.with_provenance(
        read_registry(source.models.sparkSession, target_path, target_host, may_be_new=True), source.host)
    return run_transfer(source, target, options, target_path, commit, copy_files, now)


def migrate_pending(
    source: Snapshot, target_path: str, target_host: str, options: Options,
    store: TrackingStore, commit: str, copy_files: bool = True, now: Column | None = None,
) -> DataFrame:
    """Migrate the models that wait, update tracking, return the summary.

    With nothing pending and no failed file due, nothing is written and the summary is all zero. The
    tracking table names the models, so the allowlist does not apply.
    """
    with cleared(store.spark):
        summary = _pending_transferred(source, target_path, target_host, options, store, commit, copy_files, now)
        return kept(summary, "summary")


def _pending_transferred(
    source: Snapshot, target_path: str, target_host: str, options: Options,
    store: TrackingStore, commit: str, copy_files: bool, now: Column | None,
) -> DataFrame:
    tracking = store.read()
    waiting = pending(tracking, source.host)
    if waiting.isEmpty() and not (copy_files and not retries.due(read_queue(store.spark, target_path), now).isEmpty()):
        zero = F.lit(0).cast("bigint")
        return tracking.sparkSession.range(1).select(*[zero.alias(n) for n in rw.SUMMARY])
    options = replace(options, model_names=())
    chosen = scope.restrict(source, waiting)
    done = migrate_all(chosen, target_path, target_host, options, commit, copy_files, now)
    if options.migrate_models:
        outcomes = finished_models(
            scope.scope_models(chosen.models), tracking, target_path, done, source.host,
            target_host, options.model_prefix,
        )
        store.update(lambda state: apply_outcomes(state, outcomes, now))
    return done.summary


def finished_models(
    models: DataFrame, tracking: DataFrame, target_path: str, done: Outcome,
    host: str, target_host: str, prefix: str,
) -> DataFrame:
    """Tracking updates from the target as it is after the commit.

    Only the finished models' versions, their runs and their records are looked at.
    """
    names = models.select(target_model_name(F.col("model_name"), prefix).alias("model_name"))
    target = rw.with_provenance(scope.with_runs_of(read_registry(models.sparkSession, target_path, target_host), names), host)
    counts = run_counts(target.run_params, target.run_metrics, target.run_artifacts)
    rollup = target_rollup(target, counts, host, normal_host(target_host))
    cloned = done.created_versions.select(F.col("source_model_name").alias("model_name"), "version")
    return model_outcomes(
        models, tracking, rollup, cloned, done.failures, host, target_host, prefix
    )


def reconciliation(source: Snapshot, target: Snapshot, options: Options) -> DataFrame:
    """Version-by-version comparison of the models in scope."""
    found = discover(source, options)
    target = rw.with_provenance(target, source.host)
    return reconcile(
        source.with_tables(models=found.models, versions=found.all_versions), target,
        run_counts(source.run_params, source.run_metrics, source.run_artifacts),
        run_counts(target.run_params, target.run_metrics, target.run_artifacts),
        options.model_prefix,
    )
