"""Every operator as a query on the driver tables: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from modelferry import Options, Snapshot
from modelferry.functions import errors, names, status, text
from modelferry.operators import byte_bins, counts, inventory, metadata, ranking, reconcile, references, rewrite, scope, upsert
from modelferry.plans import batched, survey, transfer
from modelferry.session import configure, scratch_path, ship, written
from modelferry.sources import artifact_files, file_copy, pages, registry, reports, retry_queue, storage, tracking_store
from modelferry.streaming import live_tracking

Query = Callable[[SparkSession, str], DataFrame]

OPTIONS = Options(model_prefix="mig_", artifact_root="dbfs:/moved", skip_existing_versions=True, batch_size=10)
# Ids given by hand: one that exists, one that does not.
EXTRA_EXPERIMENTS = (0, 987654321)
PAGE_SIZE = 100
# Files that a query has on disk at once where it can go on in rounds; one with its folders and its copy takes about 30 KB on a local disk.
FILES_AT_ONCE = 200_000

_registered: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query under its function name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark, os.path.dirname(os.path.abspath(__file__)))
        return function(configure(spark), sf_dir)

    _registered[function.__name__] = run
    return function


def all_queries() -> dict[str, Query]:
    return dict(_registered)


def _source_counts(s: Snapshot) -> DataFrame:
    return counts.run_counts(s.run_params, s.run_metrics, s.run_artifacts)


def _now():
    return F.timestamp_millis(F.lit(fx.COMMIT_MS))


def _plan(spark: SparkSession, sf_dir: str) -> transfer.Transfer:
    """The plan, staged as the job stages it."""
    return transfer.plan_transfer(fx.source(spark, sf_dir), fx.target(spark, sf_dir), OPTIONS, written)


# -- discovery --------------------------------------------------------------

@query
def scoped_models(spark, sf_dir):
    return scope.scope_models(fx.source(spark, sf_dir).models).select(
        names.normalize_host(F.col("source_host")).alias("source_host"), "model_name", "creation_ms"
    )


@query
def allowed_models(spark, sf_dir):
    """Allowlist of models with a version in production, written untidily."""
    s = fx.source(spark, sf_dir)
    listed = s.versions.where(F.col("stage") == "Production").select(
        F.concat(F.lit("\t "), "model_name", F.lit(" \n")).alias("model_name")
    )
    return scope.allow_models(s.models, listed).select("model_name")


@query
def capped_versions(spark, sf_dir):
    return scope.cap_versions(fx.source(spark, sf_dir).versions, 2).select("model_name", "version", "run_id")


@query
def capped_runs(spark, sf_dir):
    return scope.cap_runs(fx.source(spark, sf_dir).runs, 3).select("experiment_id", "run_id", "start_ms")


@query
def capped_runs_large(spark, sf_dir):
    """A cap so high that segments are counted first."""
    return scope.cap_runs(fx.source(spark, sf_dir).runs, 150).select("experiment_id", "run_id", "start_ms")


@query
def active_runs(spark, sf_dir):
    return scope.lifecycle(fx.source(spark, sf_dir).runs, False).select("run_id", "experiment_id", "lifecycle")


@query
def version_status(spark, sf_dir):
    s = fx.source(spark, sf_dir)
    return references.version_states(s.versions, s.runs).select("model_name", "version", "run_id", "run_state")


@query
def referenced_experiments(spark, sf_dir):
    s = fx.source(spark, sf_dir)
    return references.referenced_experiments(s.versions, s.runs, s.experiments, EXTRA_EXPERIMENTS).orderBy(
        "experiment_id"
    )


@query
def dangling_references(spark, sf_dir):
    s = fx.source(spark, sf_dir)
    return references.dangling(s.versions, s.runs, s.experiments, EXTRA_EXPERIMENTS)


@query
def experiment_names(spark, sf_dir):
    s = fx.source(spark, sf_dir)
    return references.named_experiments(s.versions, s.runs, s.experiments, OPTIONS.experiment_root, "team_")


@query
def targeted_discovery(spark, sf_dir):
    """What the pending models bring along: versions, experiments and runs by model."""
    waiting = upsert.pending(fx.tables(spark, sf_dir)["tracking_prev"], fx.SOURCE_HOST)
    s = scope.restrict(fx.source(spark, sf_dir), waiting)
    held = s.versions.groupBy("model_name").agg(F.count(F.lit(1)).alias("versions"))
    per_experiment = counts.runs_per_experiment(scope.lifecycle(s.runs, False))
    reach = counts.runs_per_model(s.versions, s.runs, per_experiment)
    return s.models.select("model_name").join(held, "model_name", "left").join(
        reach, "model_name", "left"
    ).na.fill(0)


@query
def migration_scope(spark, sf_dir):
    """Rows of each entity that a run of the job deals with."""
    found = survey.discover(fx.source(spark, sf_dir), OPTIONS)
    parts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("entity"), "n")
        for name, df in (
            ("models", found.models), ("versions", found.versions),
            ("experiments", found.experiments), ("runs", found.runs),
        )
    ]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


# -- counts and inventory ---------------------------------------------------

@query
def run_counts(spark, sf_dir):
    return _source_counts(fx.source(spark, sf_dir))


@query
def version_counts(spark, sf_dir):
    s = fx.source(spark, sf_dir)
    return counts.version_counts(s.versions, s.runs, _source_counts(s))


@query
def runs_per_experiment(spark, sf_dir):
    return counts.runs_per_experiment(fx.source(spark, sf_dir).runs)


@query
def runs_per_model(spark, sf_dir):
    s = fx.source(spark, sf_dir)
    return counts.runs_per_model(s.versions, s.runs, counts.runs_per_experiment(s.runs))


@query
def inventory_report(spark, sf_dir):
    return survey.inventory_report(fx.source(spark, sf_dir), Options(), fx.TARGET_HOST).drop("last_updated_at")


@query
def inventory_with_metadata(spark, sf_dir):
    """Flavors and versions from model files, requirements from whole texts."""
    s = fx.source(spark, sf_dir)
    flavors = metadata.model_flavors(_mlmodel_files(spark, sf_dir))
    texts = metadata.model_requirements(_requirement_files(spark, sf_dir))
    flavors, texts = (df.withColumn("run_id", F.col("run_id").cast("bigint")) for df in (flavors, texts))
    return survey.inventory_report(s, Options(), fx.TARGET_HOST, flavors, requirements=texts).select(
        "model_name", "flavors", "python_version", "requirements"
    )


@query
def inventory_summary(spark, sf_dir):
    return inventory.inventory_summary(
        survey.inventory_report(fx.source(spark, sf_dir), Options(), fx.TARGET_HOST)
    )


@query
def error_rows(spark, sf_dir):
    failed = fx.tables(spark, sf_dir)["inventory_failures"]
    return survey.inventory_report(
        fx.source(spark, sf_dir), Options(), fx.TARGET_HOST, failures=failed
    ).select("model_name", "readiness", "source_versions", "stages", "discovery_comments")


# -- tracking ---------------------------------------------------------------

_MERGED_SOURCE = ("readiness", "source_versions", "source_versions_migratable")


def _inventory_of_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = fx.source(spark, sf_dir)
    return inventory.inventory(s, _source_counts(s), Options(), fx.TARGET_HOST)


@query
def merge_inventory(spark, sf_dir):
    tracking = fx.tables(spark, sf_dir)["tracking_prev"]
    return upsert.merge_inventory(
        tracking, _inventory_of_all(spark, sf_dir).select(*tracking.columns), source_columns=_MERGED_SOURCE
    )


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = fx.target(spark, sf_dir)
    plan = _plan(spark, sf_dir)
    judged = plan.judged(*transfer.VERDICT)
    tracking = fx.tables(spark, sf_dir)["tracking_prev"]
    rollup = reconcile.target_rollup(target, _source_counts(target), fx.SOURCE_HOST, fx.TARGET_HOST)
    cloned = judged.where(F.col("reason").isNull()).select("model_name", "version")
    return reconcile.model_outcomes(
        plan.found.models, tracking, rollup, cloned, rewrite.version_failures(judged),
        fx.SOURCE_HOST, fx.TARGET_HOST, OPTIONS.model_prefix,
    )


@query
def model_outcomes(spark, sf_dir):
    return _outcomes(spark, sf_dir)


@query
def apply_outcomes(spark, sf_dir):
    tracking = fx.tables(spark, sf_dir)["tracking_prev"]
    return upsert.apply_outcomes(tracking, _outcomes(spark, sf_dir))


@query
def reset_failed(spark, sf_dir):
    return upsert.reset_status(fx.tables(spark, sf_dir)["tracking_prev"])


@query
def pending_models(spark, sf_dir):
    return upsert.pending(fx.tables(spark, sf_dir)["tracking_prev"], fx.SOURCE_HOST + "/")


@query
def status_counts(spark, sf_dir):
    return upsert.status_counts(fx.tables(spark, sf_dir)["tracking_prev"])


@query
def tracking_report(spark, sf_dir):
    """Through the store and a delivered report."""
    store = tracking_store.TrackingStore(spark, scratch_path(spark, "tracking"))
    store.create()
    store.write(fx.tables(spark, sf_dir)["tracking_prev"])
    path = scratch_path(spark, "report")
    kept = [f"{c}" for c in fx.tables(spark, sf_dir)["tracking_prev"].columns]
    reports.write_report(upsert.tracking_report(store.read()).select(*kept), path, "orc")
    return spark.read.orc(path)


# -- migration records ------------------------------------------------------

@query
def new_versions(spark, sf_dir):
    s, t = fx.source(spark, sf_dir), fx.target(spark, sf_dir)
    return rewrite.new_versions(s.versions, t.versions, s.host, "mig_", True).select(
        "model_name", "version", "target_model"
    )


@query
def new_models(spark, sf_dir):
    s, t = fx.source(spark, sf_dir), fx.target(spark, sf_dir)
    return rewrite.new_models(s.models, t.models, "mig_").select("model_name", "target_model")


@query
def new_experiments(spark, sf_dir):
    return rewrite.new_experiments(_plan(spark, sf_dir).mapping)


@query
def candidate_runs(spark, sf_dir):
    return _plan(spark, sf_dir).mapped.select("run_id", "experiment_id", "lifecycle")


@query
def run_id_map(spark, sf_dir):
    return _plan(spark, sf_dir).mapped.select(
        "run_id", "experiment_id", "target_experiment_id", "target_run_id", "is_new"
    )


@query
def new_runs(spark, sf_dir):
    return rewrite.new_runs(_plan(spark, sf_dir).mapped).select("run_id", "target_experiment_id")


@query
def target_experiments(spark, sf_dir):
    return rewrite.target_experiments(_plan(spark, sf_dir).mapping, fx.SOURCE_HOST)


@query
def target_experiment_tags(spark, sf_dir):
    tags = fx.source(spark, sf_dir).experiment_tags
    return rewrite.target_experiment_tags(_plan(spark, sf_dir).mapping, tags, fx.SOURCE_HOST)


def _created_models(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    s, t = fx.source(spark, sf_dir), fx.target(spark, sf_dir)
    models = scope.scope_models(s.models)
    return models, rewrite.target_models(rewrite.new_models(models, t.models, "mig_"), s.host, _now())


@query
def target_models(spark, sf_dir):
    return _created_models(spark, sf_dir)[1]


@query
def target_model_tags(spark, sf_dir):
    models, created = _created_models(spark, sf_dir)
    tags = fx.source(spark, sf_dir).model_tags
    return rewrite.target_model_tags(models, created, tags, fx.SOURCE_HOST, "mig_")


@query
def target_runs(spark, sf_dir):
    return rewrite.target_runs(_plan(spark, sf_dir).mapped, fx.source(spark, sf_dir).run_tags, fx.SOURCE_HOST)


@query
def target_run_tags(spark, sf_dir):
    return rewrite.target_run_tags(_plan(spark, sf_dir).mapped, fx.source(spark, sf_dir).run_tags, fx.SOURCE_HOST)


@query
def target_params(spark, sf_dir):
    return rewrite.target_params(_plan(spark, sf_dir).mapped, fx.source(spark, sf_dir).run_params)


@query
def metric_history(spark, sf_dir):
    s = fx.source(spark, sf_dir)
    return rewrite.metric_history(_plan(spark, sf_dir).mapped, s.run_metrics, s.metric_points, written)


def _created_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = _plan(spark, sf_dir).judged()
    return rewrite.target_versions(judged, fx.target(spark, sf_dir).versions, fx.SOURCE_HOST, _now())


@query
def target_versions(spark, sf_dir):
    return _created_versions(spark, sf_dir).drop("_version")


@query
def target_version_tags(spark, sf_dir):
    tags = fx.source(spark, sf_dir).version_tags
    return rewrite.target_version_tags(written(_created_versions(spark, sf_dir), "created"), tags, fx.SOURCE_HOST)


@query
def migration_failures(spark, sf_dir):
    return rewrite.version_failures(_plan(spark, sf_dir).judged(*transfer.VERDICT))


@query
def run_failures(spark, sf_dir):
    """Runs without a place where missing experiments may not be made."""
    plan = transfer.plan_transfer(
        fx.source(spark, sf_dir), fx.target(spark, sf_dir), replace(OPTIONS, create_missing_experiments=False), written)
    return rewrite.run_failures(plan.mapped)


@query
def failure_comments(spark, sf_dir):
    return reconcile.failure_comments(rewrite.version_failures(_plan(spark, sf_dir).judged(*transfer.VERDICT)))


@query
def failure_parts(spark, sf_dir):
    return reconcile.failure_parts(rewrite.version_failures(_plan(spark, sf_dir).judged(*transfer.VERDICT)))


@query
def artifact_manifest(spark, sf_dir):
    plan = _plan(spark, sf_dir)
    return plan.manifest(plan.judged())


@query
def model_manifest(spark, sf_dir):
    """Model files only: one of the two flags is off."""
    options = Options(model_prefix="mig_", skip_existing_versions=True, include_run_artifacts=False)
    plan = transfer.plan_transfer(fx.source(spark, sf_dir), fx.target(spark, sf_dir), options, written)
    return plan.manifest(plan.judged())


@query
def migration_summary(spark, sf_dir):
    plan = _plan(spark, sf_dir)
    created = rewrite.target_versions(plan.judged(), fx.target(spark, sf_dir).versions, fx.SOURCE_HOST)
    return rewrite.migration_summary(plan.found.models, plan.found.experiments, created)


@query
def model_batches(spark, sf_dir):
    return ranking.batches(fx.source(spark, sf_dir).models.select("model_name"), "model_name", OPTIONS.batch_size)


# -- reconciliation ---------------------------------------------------------

def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transfer.reconciliation(fx.source(spark, sf_dir), fx.target(spark, sf_dir), OPTIONS)


@query
def reconcile_report(spark, sf_dir):
    return _report(spark, sf_dir)


@query
def reconcile_summary(spark, sf_dir):
    return reconcile.report_summary(_report(spark, sf_dir))


@query
def target_rollup(spark, sf_dir):
    t = fx.target(spark, sf_dir)
    return reconcile.target_rollup(t, _source_counts(t), fx.SOURCE_HOST, fx.TARGET_HOST)


@query
def latest_target_versions(spark, sf_dir):
    return reconcile.latest_by_tag(fx.target(spark, sf_dir).versions)


# -- expressions ------------------------------------------------------------

@query
def sanitized_names(spark, sf_dir):
    t = fx.tables(spark, sf_dir)
    spoken = t["models"].select("model_name").union(t["experiments"].select("name"))
    return spoken.select(
        F.col("model_name").alias("name"), names.path_token(F.col("model_name")).alias("token")
    )


@query
def sanitized_texts(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return documents.select("doc_id", names.path_token(F.col("text")).alias("token"))


@query
def retry_classes(spark, sf_dir):
    log = fx.tables(spark, sf_dir)["error_log"]
    retryable = errors.is_retryable(F.col("status_code"), F.col("message"))
    return log.select(
        "call_id", retryable.alias("retryable"),
        errors.wait_seconds(F.col("attempt"), retryable).alias("wait_seconds"),
    )


@query
def requirements_text(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return documents.select("doc_id", text.requirement_lines(F.col("text")).alias("requirements"))


@query
def readiness_codes(spark, sf_dir):
    rows = survey.inventory_report(
        fx.source(spark, sf_dir), Options(), fx.TARGET_HOST,
        failures=fx.tables(spark, sf_dir)["inventory_failures"],
    )
    return rows.select("model_name", status.readiness_code(F.col("readiness")).alias("readiness_code"))


# -- files, stores and streams ----------------------------------------------

def _mlmodel_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model description by run, made from documents."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    lines = F.concat(
        F.lit("flavors:\n  python_function:\n    python_version: 3."),
        (F.col("doc_id") % 4 + 9).cast("string"), F.lit(".1\n  "), F.col("source"),
        F.lit(":\n    data: d\n"),
    )
    body = F.when(F.col("doc_id") % 5 == 0, F.lit("flavors: [broken\n")).otherwise(lines)
    return documents.select(F.col("doc_id").cast("string").alias("run_id"), body.cast("binary").alias("content"))


def _requirement_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return documents.select(F.col("doc_id").cast("string").alias("run_id"), F.col("text").cast("binary").alias("content"))


@query
def model_metadata(spark, sf_dir):
    return metadata.run_metadata(_mlmodel_files(spark, sf_dir), _requirement_files(spark, sf_dir))


@query
def paged_extract(spark, sf_dir):
    """All models as saved pages, each page twice, with a last token that leads nowhere.

    Beside them the same pages once more in a circle, and once more behind a page nobody points to.
    """
    models = fx.source(spark, sf_dir).models.select("model_name", "creation_ms")
    item = models.schema
    numbered = ranking.batches(models, "model_name", PAGE_SIZE)
    held = written(numbered.groupBy("batch_id").agg(
        F.collect_list(F.struct("model_name", "creation_ms")).alias("items")), "page-items")
    last = held.agg(F.max("batch_id").alias("m")).scalar()

    def token(letter, number):
        return F.concat(F.lit(letter), number.cast("string"))

    number = F.col("batch_id")
    saved = held.select(
        F.lit("models").alias("request_key"), F.when(number > 0, token("p", number)).alias("page_token"),
        token("p", number + 1).alias("next_page_token"), "items",
    )
    circle = held.select(
        F.lit("models").alias("request_key"), token("c", number).alias("page_token"),
        token("c", F.when(number < last, number + 1).otherwise(F.lit(0))).alias("next_page_token"), "items")
    stray = held.select(
        F.lit("models").alias("request_key"), token("s", number).alias("page_token"),
        F.when(number < last, token("s", number + 1)).otherwise(F.lit("p1")).alias("next_page_token"), "items")
    path = scratch_path(spark, "pages")
    saved.unionByName(saved).unionByName(circle).unionByName(stray).write.json(path)
    items, problems = pages.read_paged_extract(spark, path, item)
    none = F.lit(None).cast("string")
    return items.select("model_name", "creation_ms", none.alias("lost_token"), none.alias("kind")).unionByName(
        problems.select(
            none.alias("model_name"), F.lit(None).cast("bigint").alias("creation_ms"),
            F.col("page_token").alias("lost_token"), "kind",
        )
    )


def write_texts(files: DataFrame) -> int:
    """Write (address, text) rows as files from the executors; the number written."""

    def save(batches):
        for batch in batches:
            for address, body in zip(batch["address"], batch["text"]):
                system, path = artifact_files.locate(address)
                system.create_dir(path.rsplit("/", 1)[0], recursive=True)
                with system.open_output_stream(path) as out:
                    out.write(body.encode())
            yield batch[["address"]]

    return files.select("address", "text").mapInPandas(save, "address string").count()


def write_joined(rows: DataFrame, order: list[str]) -> int:
    """Write the texts of (address, text) rows as one file an address, in order and a line end between them; the rows read.

    A file is written row by row as its rows arrive sorted, so a worker holds a batch of rows, never a file. Null texts
    are left out; a file without any other is empty.
    """

    def save(batches):
        current, out = None, None
        try:
            for batch in batches:
                for address, body in zip(batch["address"], batch["text"]):
                    if address != current:
                        if out is not None:
                            out.close()
                        system, path = artifact_files.locate(address)
                        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
                        current, out, begun = address, system.open_output_stream(path), False
                    if isinstance(body, str):
                        out.write(("\n" + body if begun else body).encode())
                        begun = True
                yield batch[["address"]]
        finally:
            if out is not None:
                out.close()

    placed = rows.repartition("address").sortWithinPartitions("address", *order)
    return placed.select("address", "text").mapInPandas(save, "address string").count()


def remove_runs(runs: DataFrame, root: str) -> None:
    """Remove the folders of runs (``run_id``) below a root from the executors, then what is left of the root."""

    def remove(batches):
        for batch in batches:
            for address in batch["address"]:
                system, path = artifact_files.locate(address)
                system.delete_dir(path)
            yield batch[["address"]]

    folders = runs.select(F.concat_ws("/", F.lit(root), "run_id").alias("address")).distinct()
    # By number, as rows this narrow would all be one task.
    tasks = 4 * runs.sparkSession.sparkContext.defaultParallelism
    folders.repartition(tasks, "address").mapInPandas(remove, "address string").count()
    storage.remove(runs.sparkSession, root)


def _round_trip(spark: SparkSession, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(run, place, text) rows written as files, listed, copied, and listed again: the copies' log and what arrived.

    Both are staged, so the files are removed afterwards.
    """
    root, moved = scratch_path(spark, "tree"), scratch_path(spark, "moved")
    write_texts(texts.select(F.concat_ws("/", F.lit(root), "run", F.lit("artifacts"), "place").alias("address"), "text"))
    listed = artifact_files.list_artifacts(spark, root)
    manifest = listed.select(
        "run_id", "path", "size_bytes", F.col("address").alias("source_address"),
        F.concat_ws("/", F.lit(moved), "run_id", F.lit("artifacts"), "path").alias("target_address"),
    )
    log = scratch_path(spark, "copied")
    file_copy.copy_artifacts(manifest, OPTIONS.copy_threads).write.parquet(log)
    copied = spark.read.parquet(log).select("run_id", "path", "ok", "bytes")
    arrived = artifact_files.list_artifacts(spark, moved).select(
        "run_id", "path", F.col("size_bytes").alias("arrived_bytes")
    )
    for folder in (root, moved):
        remove_runs(listed, folder)
    return copied, arrived


@query
def artifact_copy(spark, sf_dir):
    """Whole texts written as artifact files, listed, copied, and listed again.

    Small files take more room in folders and blocks than in bytes, so runs go through in rounds of about ``FILES_AT_ONCE``
    files, and the files of one round are removed before the next. A run is in one round whole.
    """
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    place = F.when(F.col("doc_id") % 3 == 0, "model/MLmodel").when(
        F.col("doc_id") % 6 == 1, "model/code/pkg/__init__.py").when(
        F.col("doc_id") % 3 == 1, "model/.cfg"
    ).otherwise(F.concat(F.lit("plots/_a/b/"), "source", F.lit(".png")))
    texts = documents.select(F.floor(F.col("doc_id") / 3).cast("string").alias("run"), place.alias("place"), "text")
    rounds = max(1, -(-documents.count() // FILES_AT_ONCE))
    number = F.pmod(F.xxhash64("run"), F.lit(rounds))
    done = [_round_trip(spark, texts.where(number == k)) for k in range(rounds)]
    copied, arrived = (reduce(DataFrame.unionByName, parts) for parts in zip(*done))
    return copied.join(arrived, ["run_id", "path"], "left")


@query
def copy_bins(spark, sf_dir):
    """Ranges and bins of files from one byte to many bins: every text, one in 50 as a file of many times its size."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    files = documents.select(
        F.concat(F.lit("s3://moved/"), F.col("doc_id").cast("string")).alias("target_address"),
        F.when(F.col("doc_id") % 50 == 7, F.col("n_chars") * 1_000_000).when(F.col("doc_id") % 50 == 8, F.lit(1)).when(
            F.col("doc_id") % 50 != 9, F.octet_length("text")).cast("bigint").alias("size_bytes"))
    ranges = written(byte_bins.byte_ranges(files, file_copy.RANGE_BYTES), "ranges")
    placed, _ = byte_bins.byte_bins(ranges, [F.col("target_address"), F.col("range_no")], file_copy.BIN_BYTES)
    return placed.select("target_address", "range_no", "n_ranges", "range_start", "range_length", "bin")


@query
def copy_large_files(spark, sf_dir):
    """Texts of a source as one file each, up to many bins long, copied by ranges and read back whole."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root, moved = scratch_path(spark, "large"), scratch_path(spark, "moved")
    write_joined(documents.select(
        F.concat_ws("/", F.lit(root), "lang", F.lit("artifacts/model"), (F.col("doc_id") % 3).cast("string")).alias("address"),
        "doc_id", "text"), ["doc_id", "text"])
    manifest = artifact_files.list_artifacts(spark, root).select(
        "run_id", "path", "size_bytes", F.col("address").alias("source_address"),
        F.concat_ws("/", F.lit(moved), "run_id", F.lit("artifacts"), "path").alias("target_address"))
    # Small bins, so that these files have many ranges.
    copied = written(file_copy.copy_artifacts(manifest, OPTIONS.copy_threads, bin_bytes=1 << 18, range_bytes=1 << 16), "copied")
    arrived = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(moved).select(
        F.regexp_extract("path", r"/([^/]+)/artifacts/", 1).alias("run_id"), F.regexp_extract("path", "/artifacts/(.*)$", 1).alias("path"),
        F.md5("content").alias("digest"))
    return copied.select("run_id", "path", "ok", "bytes").join(arrived, ["run_id", "path"], "full_outer")


def _stored_target(spark: SparkSession, sf_dir: str) -> str:
    """The target registry of the fixtures, written as an earlier transfer."""
    t, path = fx.target(spark, sf_dir), scratch_path(spark, "target")
    tables = {n: getattr(t, n) for n in registry.WRITE_ORDER if getattr(t, n, None) is not None}
    registry.write_registry(tables, path, fx.SOURCE_HOST, "earlier")
    return path


@query
def migrate_all(spark, sf_dir):
    path = _stored_target(spark, sf_dir)
    return transfer.migrate_all(
        fx.source(spark, sf_dir), path, fx.TARGET_HOST, OPTIONS, "now", copy_files=False
    ).summary


def _with_files(spark: SparkSession, sf_dir: str) -> tuple[Snapshot, Snapshot, str, str, Options, DataFrame]:
    """Source and target whose files are the documents; those of one id in 17 are not there yet.

    With the target's address, the root of all files, options, and the files (address, text, lost).
    """
    root, path = scratch_path(spark, "files"), scratch_path(spark, "target")
    s, t = fx.source(spark, sf_dir), fx.target(spark, sf_dir)

    def home(folder, *below):
        return F.concat_ws("/", F.lit(f"{root}/{folder}"), F.col("run_id").cast("string"), *map(F.lit, below))

    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    place = F.when(F.col("doc_id") % 3 == 0, "model/MLmodel").when(
        F.col("doc_id") % 3 == 1, "model/requirements.txt").otherwise(F.concat(F.lit("plots/"), "source", F.lit(".png")))
    files = documents.where("doc_id % 31 <> 0").select(
        F.concat_ws("/", F.lit(f"{root}/from"), F.floor(F.col("doc_id") / 3).cast("string"), place).alias("address"),
        "text", (F.col("doc_id") % 17 == 5).alias("lost"))
    write_texts(files.where("not lost"))
    # The source's files are not listed, so no folder more than their paths have.
    s = s.with_tables(runs=s.runs.withColumn("artifact_uri", home("from")))
    t = t.with_tables(runs=t.runs.withColumn("artifact_uri", home("to/old", "artifacts")))
    tables = {n: getattr(t, n) for n in registry.WRITE_ORDER if getattr(t, n, None) is not None}
    registry.write_registry(tables, path, fx.SOURCE_HOST, "earlier")
    return s, t, path, root, replace(OPTIONS, artifact_root=f"{root}/to/new"), files


@query
def migrate_with_files(spark, sf_dir):
    """A migration that moves files, some of which are lost: files that arrived, versions made, failures."""
    s, t, path, root, options, _ = _with_files(spark, sf_dir)
    done = transfer.migrate_all(s, path, fx.TARGET_HOST, options, "now")
    arrived = artifact_files.list_artifacts(spark, f"{root}/to").select(
        F.lit("file").alias("kind"), F.split_part("run_id", F.lit("/"), F.lit(-1)).alias("name"), "path",
        F.col("size_bytes").alias("n"))
    known = registry.read_registry(spark, path, fx.TARGET_HOST).run_artifacts.join(
        t.run_artifacts.select(F.col("run_id").cast("string").alias("run_id"), "path"), ["run_id", "path"], "left_anti")
    none = F.lit(None).cast("string").alias("path")
    return arrived.unionByName(
        known.select(F.lit("record").alias("kind"), F.col("run_id").alias("name"), "path", F.lit(0).cast("bigint").alias("n"))
    ).unionByName(
        done.created_versions.select(F.lit("version").alias("kind"), F.col("model_name").alias("name"), none, F.col("version").cast("bigint").alias("n"))
    ).unionByName(
        done.failures.select(F.lit("failure").alias("kind"), F.col("model_name").alias("name"), none, F.col("version").cast("bigint").alias("n"))
    )


@query
def file_failures(spark, sf_dir):
    """Files that could not be copied, as reported and as queued."""
    s, _, path, _, options, _ = _with_files(spark, sf_dir)
    done = transfer.migrate_all(s, path, fx.TARGET_HOST, options, "now", now=_now())
    queued = retry_queue.read_queue(spark, path)
    reported = done.file_failures.select("run_id", "path", F.lit("reported").alias("kind"), F.lit(1).alias("attempts"), F.lit(0).cast("bigint").alias("wait_ms"))
    return reported.unionByName(
        queued.select("run_id", "path", F.lit("queued").alias("kind"), "attempts", (F.col("next_ms") - fx.COMMIT_MS).alias("wait_ms")))


@query
def retried_files(spark, sf_dir):
    """What later migrations copy: nothing before the time has come, then exactly what failed, then nothing."""
    s, _, path, _, options, files = _with_files(spark, sf_dir)
    parts = []
    for commit, after in (("one", 0), ("two", 1), ("three", 3600), ("four", 7200)):
        if commit == "three":
            write_texts(files.where("lost"))
        # Versions are switched off after the first time, so that only the queue asks for files.
        done = transfer.migrate_all(
            s, path, fx.TARGET_HOST, options if commit == "one" else replace(options, migrate_models=False), commit,
            now=F.timestamp_millis(F.lit(fx.COMMIT_MS + after * 1000)))
        if commit != "one":
            parts.append(done.copied.select(F.lit(commit).alias("commit"), F.col("run_id").cast("string").alias("run_id"), "path", "ok"))
    parts.append(retry_queue.read_queue(spark, path).select(F.lit("queued").alias("commit"), "run_id", "path", F.lit(False).alias("ok")))
    return reduce(DataFrame.unionByName, parts)


def _text_digest(rows: DataFrame) -> list:
    """Number of rows and sum of a hash of their text, as SQL can work them out."""
    cells = [
        F.coalesce((F.round(F.col(c) * 1000).cast("bigint") if kind == "double" else F.col(c)).cast("string"), F.lit("~"))
        for c, kind in sorted(rows.dtypes)]
    number = F.conv(F.substring(F.md5(F.concat_ws("|", *cells)), 1, 8), 16, 10).cast("bigint")
    return [F.count(F.lit(1)).alias("n_rows"), F.sum(number).alias("digest")]


@query
def committed_tables(spark, sf_dir):
    """The content of each table that a migration wrote, read back from its commit."""
    path = _stored_target(spark, sf_dir)
    transfer.migrate_all(fx.source(spark, sf_dir), path, fx.TARGET_HOST, OPTIONS, "now", copy_files=False, now=_now())
    parts = []
    for name in registry.WRITE_ORDER:
        rows = spark.read.schema(registry.TABLES[name]).parquet(f"{path}/{name}/commit=now")
        parts.append(rows.agg(*_text_digest(rows)).select(F.lit(name).alias("table_name"), "n_rows", "digest"))
    return reduce(DataFrame.unionByName, parts)


@query
def target_as_source(spark, sf_dir):
    """Versions and runs by model in the inventory of a registry that this engine wrote."""
    path = _stored_target(spark, sf_dir)
    transfer.migrate_all(fx.source(spark, sf_dir), path, fx.TARGET_HOST, OPTIONS, "now", copy_files=False, now=_now())
    rows = survey.inventory_report(registry.read_registry(spark, path, fx.TARGET_HOST), Options(), "https://next.example")
    return rows.select("source_host", "model_name", "source_versions", "source_versions_migratable", "source_params", "source_metrics")


@query
def second_migration(spark, sf_dir):
    """Rows of a plain target after one and after a second migration into it."""
    s, t, path = fx.source(spark, sf_dir), fx.target(spark, sf_dir), scratch_path(spark, "plain")
    for name in registry.WRITE_ORDER:
        if getattr(t, name, None) is not None:
            registry.conformed(getattr(t, name), name).write.parquet(f"{path}/{name}")
    rounds = []
    for commit in ("one", "two"):
        transfer.migrate_all(s, path, fx.TARGET_HOST, OPTIONS, commit, copy_files=False)
        back = registry.read_registry(spark, path, fx.TARGET_HOST)
        keys = {"models": ["model_name"], "versions": ["model_name", "version"], "experiments": ["experiment_id"], "runs": ["run_id"]}
        rounds += [
            getattr(back, name).agg(
                F.count(F.lit(1)).alias("n_rows"), F.count_distinct(*key).alias("n_keys")
            ).select(F.lit(commit).alias("round"), F.lit(name).alias("table_name"), "n_rows", "n_keys")
            for name, key in keys.items()
        ]
    return written(reduce(DataFrame.unionByName, rounds), "rounds")


@query
def provenance_from_tags(spark, sf_dir):
    """What is new where the target knows its sources by tags alone."""
    s, t = fx.source(spark, sf_dir), fx.target(spark, sf_dir)
    empty = F.lit(None).cast("string")

    def tags(rows, keys, column, tag):
        made = rows.where(F.col(column).isNotNull())
        return made.select(*keys, F.explode(F.array(
            F.struct(F.lit(rewrite.TAG_HOST).alias("key"), F.concat("source_host", F.lit("/")).alias("value")),
            F.struct(F.lit(tag).alias("key"), F.col(column).alias("value")))).alias("tag")).select(*keys, "tag.*")

    bare = t.with_tables(
        runs=t.runs.withColumns({"source_host": empty, "source_run_id": empty}),
        versions=t.versions.withColumns({"source_host": empty, "source_model_version": empty}),
        run_tags=tags(t.runs, ["run_id"], "source_run_id", rewrite.TAG_RUN),
        version_tags=tags(t.versions, ["model_name", "version"], "source_model_version", rewrite.TAG_VERSION),
    )
    known = rewrite.with_provenance(bare, s.host)
    plan = transfer.plan_transfer(s, known, OPTIONS, written)
    versions = rewrite.new_versions(s.versions, known.versions, s.host, "mig_", True)
    return versions.select("model_name", "version", F.lit(None).cast("bigint").alias("run_id")).unionByName(
        rewrite.new_runs(plan.mapped).select(
            F.lit(None).cast("string").alias("model_name"), F.lit(None).cast("int").alias("version"), "run_id"))


@query
def switched_off(spark, sf_dir):
    """Experiments and versions of a migration with either kind switched off."""
    parts = []
    for name, flag in (("experiments", "migrate_experiments"), ("models", "migrate_models")):
        plan = transfer.plan_transfer(
            fx.source(spark, sf_dir), fx.target(spark, sf_dir), replace(OPTIONS, **{flag: False}), written)
        counted = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "n")
                   for kind, df in (("experiments", plan.mapping), ("versions", plan.versions))]
        parts.append(reduce(DataFrame.unionByName, counted).withColumn("off", F.lit(name)))
    return reduce(DataFrame.unionByName, parts)


@query
def migrate_pending(spark, sf_dir):
    """Tracking after the pending models were migrated."""
    path = _stored_target(spark, sf_dir)
    store = tracking_store.TrackingStore(spark, scratch_path(spark, "tracking"))
    before = fx.tables(spark, sf_dir)["tracking_prev"]
    store.write(before)
    transfer.migrate_pending(
        fx.source(spark, sf_dir), path, fx.TARGET_HOST, OPTIONS, store, "now", copy_files=False
    )
    return store.read().select(
        *before.columns, "target_runs", "target_params", "target_metrics", "target_artifacts",
        "target_experiment_urls",
    )


@query
def migrate_in_batches(spark, sf_dir):
    """The same, planned once and committed in three batches."""
    path = _stored_target(spark, sf_dir)
    store = tracking_store.TrackingStore(spark, scratch_path(spark, "tracking"))
    before = fx.tables(spark, sf_dir)["tracking_prev"]
    store.write(before)
    waiting = upsert.pending(before, fx.SOURCE_HOST).count()
    batched.migrate_pending_in_batches(
        fx.source(spark, sf_dir), path, fx.TARGET_HOST, replace(OPTIONS, batch_size=max(1, -(-waiting // 3))), store, "now", copy_files=False)
    return store.read().select(
        *before.columns, "target_runs", "target_params", "target_metrics", "target_artifacts",
        "target_experiment_urls",
    )


@query
def track_stream(spark, sf_dir):
    """Every event as the outcome of a model, applied to tracking by a stream."""
    store = tracking_store.TrackingStore(spark, scratch_path(spark, "tracking"))
    before = fx.tables(spark, sf_dir)["tracking_prev"]
    store.write(before)
    models = fx.tables(spark, sf_dir)["models"].select("source_host", "model_name", "model_key")
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    outcomes = events.join(models, F.col("user_id") == F.col("model_key")).select(
        "source_host", "model_name", "event_id",
        F.unix_millis(F.col("ts").cast("timestamp")).alias("event_ms"),
        (F.col("event_id") % 9).cast("int").alias("target_versions"),
        F.when(F.col("event_type") == "error", status.FAILED).otherwise(status.COMPLETED).alias("migration_status"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("migration_comments"),
    )
    running = live_tracking.track_stream(outcomes, store, scratch_path(spark, "stream"))
    running.awaitTermination()
    return store.read().select(*before.columns)
