"""Source against target, version by version and model by model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelferry.functions.names import normal_host, target_experiment_url, target_model_name, target_model_url
from modelferry.functions.status import (
    FAILED_VERSION, MIGRATED, NO_ARTIFACTS, RUN_DELETED,
    counts_match, migration_status, version_status,
)
from modelferry.functions.text import cut, joined_sorted
from modelferry.operators.counts import COUNTS, with_counts
from modelferry.operators.joins import outer_lookup, parted_lookup
from modelferry.operators.long_texts import cells, text_parts
from modelferry.schemas import Snapshot

# Message length and separators in the tracking comments.
REASON_LENGTH = 60
REASON_SEPARATOR = "; "
URL_SEPARATOR = " | "


def tagged_versions(versions: DataFrame) -> DataFrame:
    """Target versions made by migration."""
    tag = F.col("source_model_version")
    return versions.where(tag.isNotNull() & (tag != ""))


def latest_by_tag(versions: DataFrame) -> DataFrame:
    """The newest target version of each (model, source version)."""
    return tagged_versions(versions).groupBy("model_name", "source_model_version").agg(
        F.max_by(F.struct("version", "run_id"), "version").alias("_last")
    ).select("model_name", "source_model_version", "_last.version", "_last.run_id")


def _readable(snapshot_runs: DataFrame, counts: DataFrame, side: str) -> DataFrame:
    """run_id, found flag and counts, named for one side."""
    return with_counts(snapshot_runs.select("run_id"), counts).select(
        F.col("run_id").alias(f"{side}_run_id"), F.lit(True).alias(f"{side}_run"),
        *[F.col(c).alias(f"{side}_{c}") for c in COUNTS],
    )


def reconcile(
    source: Snapshot, target: Snapshot, source_counts: DataFrame, target_counts: DataFrame, prefix: str
) -> DataFrame:
    """One row for each source version."""
    versions = source.versions.select(
        "model_name", "version", F.col("run_id").alias("source_run_id"),
        target_model_name(F.col("model_name"), prefix).alias("target_model"),
        F.col("version").cast("string").alias("source_model_version"),
    )
    host = normal_host(source.host)
    arrived = latest_by_tag(target.versions.where(F.col("source_host") == host)).select(
        F.col("model_name").alias("target_model"), "source_model_version",
        F.col("run_id").alias("target_run_id"), F.lit(True).alias("has_target"),
    )
    paired = versions.join(arrived, ["target_model", "source_model_version"], "left")
    version = ["model_name", "version"]
    with_source = outer_lookup(
        paired, _readable(source.runs, source_counts, "source"), ["source_run_id"], version
    )
    both = outer_lookup(
        with_source, _readable(target.runs, target_counts, "target"), ["target_run_id"], version
    )
    has_target = F.col("has_target").isNotNull()
    source_run, target_run = F.col("source_run").isNotNull(), F.col("target_run").isNotNull()

    def source_count(c: str) -> Column:
        return F.coalesce(F.col(f"source_{c}"), F.lit(0))

    def target_count(c: str) -> Column:
        return F.when(has_target, F.coalesce(F.col(f"target_{c}"), F.lit(0)))

    def match(c: str) -> Column:
        return counts_match(has_target, target_run, source_count(c), target_count(c))

    return both.select(
        F.col("model_name").alias("source_model"), "version", "target_model",
        version_status(has_target, source_run, source_count("model_files")).alias("status"),
        source_run.alias("source_run_accessible"),
        source_count("params").cast("int").alias("source_params"),
        target_count("params").cast("int").alias("target_params"),
        match("params").alias("params_match"),
        source_count("metrics").cast("int").alias("source_metrics"),
        target_count("metrics").cast("int").alias("target_metrics"),
        match("metrics").alias("metrics_match"),
        source_count("model_files").cast("int").alias("source_model_files"),
        target_count("model_files").cast("int").alias("target_model_files"),
        match("model_files").alias("artifacts_match"),
    )


def report_summary(report: DataFrame) -> DataFrame:
    """One row of totals."""
    status = F.col("status")
    return report.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(status == MIGRATED).alias("migrated"),
        F.count_if(status == FAILED_VERSION).alias("failed"),
        F.count_if(status == RUN_DELETED).alias("run_deleted"),
        F.count_if(status == NO_ARTIFACTS).alias("no_artifacts"),
    )


def target_rollup(target: Snapshot, counts: DataFrame, host: str, target_host: str) -> DataFrame:
    """By target model: tagged versions, counts of their runs, experiment pages.

    Rows are summed by (model, experiment) first: the distinct experiments of a
    model then meet in one task, its versions never do.
    """
    made = tagged_versions(target.versions).where(F.col("source_host") == normal_host(host))
    runs = with_counts(target.runs.select("run_id", "experiment_id"), counts)
    looked = parted_lookup(
        made.select("model_name", "version", "run_id"), runs, ["run_id"], ["model_name", "version"]
    )
    pairs = looked.groupBy("model_name", "experiment_id").agg(
        F.count(F.lit(1)).alias("versions"), *[F.sum(c).alias(c) for c in COUNTS]
    )
    url = target_experiment_url(F.lit(target_host), F.col("experiment_id"))
    urls = joined_sorted(F.collect_list(F.when(F.col("experiment_id").isNotNull(), url)), URL_SEPARATOR)
    return pairs.groupBy("model_name").agg(
        F.sum("versions").alias("versions"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS],
        F.nullif(urls, F.lit("")).alias("experiment_urls"),
    )


def failure_parts(failures: DataFrame) -> DataFrame:
    """By model and segment of versions: failed versions and their reasons in order, one row a part."""
    return text_parts(failures, ["model_name"], "version", cut(F.col("reason"), REASON_LENGTH), REASON_SEPARATOR)


def failure_comments(failures: DataFrame) -> DataFrame:
    """By model: failed versions and their reasons in order."""
    return cells(failure_parts(failures), ["model_name"], REASON_SEPARATOR).select(
        "model_name", F.col("rows").alias("failed"), F.col("text").alias("comments"))


def model_outcomes(
    models: DataFrame, tracking: DataFrame, rollup: DataFrame, cloned: DataFrame,
    failures: DataFrame, host: str, target_host: str, prefix: str,
) -> DataFrame:
    """The tracking update of every processed model.

    ``cloned`` is (model_name, version) of the versions made now. A model that
    is not tracked has no migratable versions, so it never completes.
    """
    host = normal_host(host)
    migratable = tracking.where(F.col("source_host") == host).select(
        "model_name", F.col("source_versions_migratable").alias("_migratable")
    )
    made = cloned.groupBy("model_name").agg(F.count(F.lit(1)).alias("_made"))
    named = models.select(
        "model_name", target_model_name(F.col("model_name"), prefix).alias("_target")
    )
    joined = (
        named.join(migratable, "model_name", "left")
        .join(made, "model_name", "left")
        .join(failure_comments(failures), "model_name", "left")
        .join(rollup.withColumnRenamed("model_name", "_target"), "_target", "left")
    )

    def count(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0))

    return joined.select(
        F.lit(host).alias("source_host"), "model_name",
        count("versions").cast("int").alias("target_versions"),
        count("_made").cast("int").alias("target_runs"),
        count("params").cast("int").alias("target_params"),
        count("metrics").cast("int").alias("target_metrics"),
        count("model_files").cast("int").alias("target_artifacts"),
        migration_status(count("versions"), count("_migratable"), count("failed")).alias("migration_status"),
        F.nullif(F.col("comments"), F.lit("")).alias("migration_comments"),
        target_model_url(F.lit(target_host), F.col("_target")).alias("target_model_url"),
        F.col("experiment_urls").alias("target_experiment_urls"),
    )
