"""Pending models in many commits, planned once.

The plan covers all waiting models. Each model has a batch, and an experiment, a run or a file belongs to the first
batch that needs it. What does not depend on copied files is written once, each batch's part into the folder of
its commit, which no reader looks at yet. Verdicts, files to copy and version tags are staged by batch. A batch then
copies its files, writes its versions, commits, and updates tracking; it reads its own part of what was staged, and no
source table again.

A run that breaks keeps the batches it finished. The next call under the same name plans what still waits and goes on
with new numbers; parts of batches that never committed are not read by anyone.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from modelferry.functions.names import target_model_name
from modelferry.functions.text import strip_space
from modelferry.operators import rewrite as rw
from modelferry.operators import retries, scope
from modelferry.operators.ranking import batches
from modelferry.operators.rewrite import BATCH
from modelferry.operators.upsert import apply_outcomes, pending
from modelferry.options import Options
from modelferry.plans.transfer import (
    Outcome, Transfer, assumed_copied, fail_uncopied, finished_models, migrate_pending, plan_transfer, with_addresses,
    with_target_model,
)
from modelferry.schemas import Snapshot
from modelferry.session import cleared, kept, scratch_path, written
from modelferry.sources.file_copy import copy_artifacts
from modelferry.sources.registry import committed, read_registry, write_parts, write_registry
from modelferry.sources.retry_queue import read_queue, write_queue
from modelferry.sources.tracking_store import TrackingStore


@dataclass(frozen=True)
class Staged:
    """What the batches read: datasets partitioned by batch below ``path``, and the numbers versions go on from."""

    path: str
    last_versions: DataFrame
    schemas: dict[str, StructType]

    def put(self, df: DataFrame, name: str) -> None:
        # Rebalancing keeps a batch's part in few files, and splits a large one.
        self.schemas[name] = df.schema
        df.hint("rebalance", BATCH).write.partitionBy(BATCH).parquet(f"{self.path}/{name}")

    def put_batch(self, df: DataFrame, name: str, batch: int) -> None:
        self.schemas[name] = StructType([*df.schema, StructField(BATCH, LongType())])
        df.write.mode("overwrite").parquet(f"{self.path}/{name}/{BATCH}={batch}")

    def all(self, name: str) -> DataFrame:
        return self.last_versions.sparkSession.read.schema(self.schemas[name]).parquet(f"{self.path}/{name}")

    def of(self, name: str, batch: int) -> DataFrame:
        """One batch's rows; other batches' files are not opened."""
        return self.all(name).where(F.col(BATCH) == batch).drop(BATCH)


def _first(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(BATCH).alias(BATCH))


def model_batches(models: DataFrame, waiting: DataFrame) -> DataFrame:
    """(model_name, batch_id) of models; names are compared without spaces around them."""
    numbers = _first(waiting.select(strip_space(F.col("model_name")).alias("_name"), BATCH), "_name")
    named = models.select("model_name", strip_space(F.col("model_name")).alias("_name"))
    return named.join(numbers, "_name").select("model_name", BATCH)


def with_batches(plan: Transfer, numbers: DataFrame) -> Transfer:
    """The plan with a batch for each experiment and run: the first that needs it, or the first of all."""
    source = plan.source
    users = plan.found.versions.where(F.col("run_id").isNotNull()).join(numbers, "model_name")
    by_experiment = _first(
        _first(users, "run_id").join(source.runs.select("run_id", "experiment_id"), "run_id"), "experiment_id")
    by_run = _first(plan.versions.where(F.col("run_id").isNotNull()).join(numbers, "model_name"), "run_id")
    first = F.lit(0).cast("bigint")
    mapping = plan.mapping.join(by_experiment, "experiment_id", "left").withColumn(BATCH, F.coalesce(BATCH, first))
    mapped = plan.mapped.join(by_run, "run_id", "left").join(
        by_experiment.withColumnRenamed(BATCH, "_listed"), "experiment_id", "left"
    ).withColumn(BATCH, F.coalesce(F.least(BATCH, "_listed"), first)).drop("_listed")
    return replace(plan, mapping=written(mapping, "experiment-batches"), mapped=written(mapped, "run-batches"))


def stage(
    plan: Transfer, numbers: DataFrame, target_path: str, name: str, options: Options, copy_files: bool,
    first: int, last: int, now: Column | None,
) -> Staged:
    """Write what does not depend on files into the commits' folders, and stage the rest by batch."""
    source, target, mapped, host = plan.source, plan.target, plan.mapped, plan.source.host
    targets = numbers.select(target_model_name(F.col("model_name"), options.model_prefix).alias("model_name"), BATCH)
    numbered = target.versions.join(targets, "model_name", "left_semi").groupBy("model_name").agg(F.max("version").alias("version"))
    staged = Staged(scratch_path(source.models.sparkSession, "batches"), written(numbered, "last-versions"), {})
    judged = plan.judged()
    # What follows from the name is not moved and stored once more.
    staged.put(judged.drop("target_model").join(numbers, "model_name"), "judged")
    manifest = plan.manifest(judged)
    if copy_files:
        manifest = with_addresses(manifest, mapped, source)
    wanted = manifest.join(mapped.select("run_id", BATCH), "run_id")
    if copy_files:
        # Files that failed earlier go with the first batch.
        queue = read_queue(source.models.sparkSession, target_path).withColumn(BATCH, F.lit(first))
        wanted = retries.with_due(wanted, queue, target.run_artifacts, now)
    staged.put(wanted, "manifest")
    cloned = judged.where(F.col("reason").isNull()).select("model_name", "version")
    tags = source.version_tags.join(cloned, ["model_name", "version"], "left_semi")
    staged.put(tags.join(numbers, "model_name"), "version_tags")
    models = plan.found.models if options.migrate_models else scope.nothing(plan.found.models)
    staged.put(models.join(numbers, "model_name"), "models")
    staged.put(plan.mapping, "mapping")
    fresh = rw.target_models(rw.new_models(models, target.models, options.model_prefix), host, now)
    targets_of_experiments = _first(
        plan.mapping.where("target_experiment_id is not null").withColumnRenamed("target_experiment_id", "id"), "id"
    ).withColumnRenamed("id", "experiment_id")
    experiment_tags = rw.target_experiment_tags(plan.mapping, source.experiment_tags, host)
    model_tags = rw.target_model_tags(models, fresh, source.model_tags, host, options.model_prefix)
    write_parts(
        {
            "run_params": rw.target_params(mapped, source.run_params),
            "run_metrics": rw.target_metrics(mapped, source.run_metrics),
            "metric_points": rw.metric_history(mapped, source.run_metrics, source.metric_points, written),
            "run_tags": rw.target_run_tags(mapped, source.run_tags, host),
            "experiment_tags": experiment_tags.join(targets_of_experiments, "experiment_id"),
            "experiments": rw.target_experiments(plan.mapping, host).join(targets_of_experiments, "experiment_id"),
            "runs": rw.target_runs(mapped, source.run_tags, host),
            "model_tags": model_tags.join(targets, "model_name"),
            "models": fresh.join(targets, "model_name"),
        },
        target_path, host, F.concat(F.lit(f"{name}-"), F.lpad(F.col(BATCH).cast("string"), 6, "0")),
        [f"{name}-{batch:06d}" for batch in range(first, last + 1)],
    )
    return staged


def _copied(staged: Staged, batch: int, options: Options, copy_files: bool) -> DataFrame:
    """Copies the batch's files; its manifest with ok, bytes, error. Staged beside that of the earlier batches."""
    manifest = staged.of("manifest", batch)
    done = copy_artifacts(manifest, options.copy_threads) if copy_files else assumed_copied(manifest)
    staged.put_batch(done, "copied", batch)
    return staged.of("copied", batch)


def _commit(
    source: Snapshot, staged: Staged, batch: int, target_path: str, target_host: str, commit: str, options: Options,
    store: TrackingStore, copy_files: bool, now: Column | None,
) -> None:
    """Copy, write and commit one batch, and update tracking."""
    host = source.host
    copied = _copied(staged, batch, options, copy_files)
    # A run's files are copied by the first batch that needs them, and later ones depend on them as well.
    verdicts = with_target_model(staged.of("judged", batch), options)
    judged = fail_uncopied(verdicts, staged.all("copied").where(F.col(BATCH) <= batch))
    created = written(rw.target_versions(judged, staged.last_versions, host, now), "created")
    failures = written(rw.version_failures(judged), "failures")
    write_registry(
        {
            "run_artifacts": copied.where("ok").select(F.col("target_run_id").alias("run_id"), "path", "size_bytes"),
            "version_tags": rw.target_version_tags(created, staged.of("version_tags", batch), host),
            "versions": created,
        },
        target_path, host, commit,
    )
    if copy_files:
        write_queue(retries.next_queue(read_queue(store.spark, target_path), copied, scope.nothing(copied), now), target_path)
    models, mapping = staged.of("models", batch), staged.of("mapping", batch)
    summary = rw.migration_summary(models, mapping if options.migrate_experiments else scope.nothing(mapping), created)
    staged.put_batch(summary, "summary", batch)
    if options.migrate_models:
        done = Outcome(summary, failures, created, copied, scope.nothing(failures), rw.file_failures(copied))
        outcomes = finished_models(models, store.read(), target_path, done, host, target_host, options.model_prefix)
        store.update(lambda state: apply_outcomes(state, outcomes, now))


def migrate_pending_in_batches(
    source: Snapshot, target_path: str, target_host: str, options: Options,
    store: TrackingStore, commit: str, copy_files: bool = True, now: Column | None = None,
) -> DataFrame:
    """Migrate the models that wait, ``options.batch_size`` to a commit; the summary of all.

    Each batch is a set of whole jobs, so the size should be thousands where there are many models.
    """
    if copy_files and not options.artifact_root:
        raise ValueError("set artifact_root, the address below which copied files go")
    with cleared(store.spark):
        summary = _batches_transferred(source, target_path, target_host, options, store, commit, copy_files, now)
        return kept(summary, "summary")


def _batches_transferred(
    source: Snapshot, target_path: str, target_host: str, options: Options,
    store: TrackingStore, commit: str, copy_files: bool, now: Column | None,
) -> DataFrame:
    spark = store.spark
    done = [c for c in committed(spark, target_path) if re.fullmatch(re.escape(commit) + r"-\d{6,}", c)]
    first = 1 + max((int(c.rpartition("-")[2]) for c in done), default=-1)
    waiting = written(batches(pending(store.read(), source.host), "model_name", options.batch_size), "batches")
    # Numbers go on after the commits of an earlier call.
    waiting = waiting.withColumn(BATCH, F.col(BATCH) + first)
    last = waiting.agg(F.max(BATCH)).first()[0]
    if last is None:
        return migrate_pending(source, target_path, target_host, options, store, commit, copy_files, now)
    options = replace(options, model_names=())
    chosen = scope.restrict(source, waiting.select("model_name"))
    target = rw.with_provenance(read_registry(spark, target_path, target_host, may_be_new=True), source.host)
    plan = plan_transfer(chosen, target, options, written)
    numbers = written(model_batches(scope.scope_models(chosen.models), waiting), "model-batches")
    plan = with_batches(plan, numbers)
    plan = replace(
        plan, mapping=plan.mapping.withColumn(BATCH, F.greatest(BATCH, F.lit(first))),
        mapped=plan.mapped.withColumn(BATCH, F.greatest(BATCH, F.lit(first))))
    staged = stage(plan, numbers, target_path, commit, options, copy_files, first, last, now)
    for batch in range(first, last + 1):
        _commit(source, staged, batch, target_path, target_host, f"{commit}-{batch:06d}", options, store, copy_files, now)
    return staged.all("summary").agg(*[F.sum(n).alias(n) for n in rw.SUMMARY])
