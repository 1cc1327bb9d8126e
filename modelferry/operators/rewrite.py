"""Source records as target records, created once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelferry.functions.names import (
    model_artifact_path, model_source_uri, normal_host, normalize_host, stable_id,
    target_experiment_name, target_model_name,
)
from modelferry.operators.artifacts import in_folders
from modelferry.operators.joins import parted_lookup
from modelferry.operators.long_texts import part_of
from modelferry.operators.ranking import next_versions
from modelferry.operators.scope import drop_reserved_tags
from modelferry.schemas import Snapshot

# Provenance tag keys, the run-name tag, the reason length, and reasons that users look for.
TAG_HOST = "source_workspace_host"
TAG_EXPERIMENT = "source_experiment_id"
TAG_RUN = "source_run_id"
TAG_MODEL = "source_model_name"
TAG_VERSION = "source_model_version"
TAG_RUN_NAME = "mlflow.runName"
REASON_LENGTH = 120
ACTIVE = "active"
NO_RUN_ID = " has no run_id"
NO_EXPERIMENT = "Missing target experiment "

# A plan may name the batch of each experiment and run in this column; records of runs then carry it on.
BATCH = "batch_id"

# Columns of the migration summary.
SUMMARY = (
    "migrated_models", "migrated_model_versions", "migrated_experiments", "migrated_runs",
    "distinct_runs",
)


# -- what the target knows ----------------------------------------------------

def _from_tags(rows: DataFrame, keys: list[str], tags: DataFrame | None, tag: str, column: str, host: str) -> DataFrame:
    """Fill ``source_host`` and ``column`` from tags where they are NULL."""
    if tags is None:
        return rows
    def value(key):
        return F.max(F.when(F.col("key") == key, F.nullif(F.col("value"), F.lit(""))))

    said = tags.where(F.col("key").isin(TAG_HOST, tag)).groupBy(*keys).agg(
        value(TAG_HOST).alias("_host"), value(tag).alias("_id")).where(F.col("_id").isNotNull())
    known = F.col(column).isNotNull()
    home = F.coalesce(normalize_host(F.col("_host")), F.when(F.col("_id").isNotNull(), F.lit(normal_host(host))))
    return rows.join(said, keys, "left").withColumns({
        "source_host": F.when(known, F.col("source_host")).otherwise(F.coalesce("source_host", home)),
        column: F.coalesce(F.col(column), F.col("_id")),
    }).select(*rows.columns)


def with_provenance(target: Snapshot, host: str) -> Snapshot:
    """The target with provenance columns filled from its tags.

    Columns that hold a value stay. A record whose tag names a source id but no
    workspace counts as one of ``host``, as tags alone decided who made it.
    """
    return target.with_tables(
        runs=_from_tags(target.runs, ["run_id"], target.run_tags, TAG_RUN, "source_run_id", host),
        versions=_from_tags(
            target.versions, ["model_name", "version"], target.version_tags, TAG_VERSION, "source_model_version", host),
    )


# -- what is new ------------------------------------------------------------

def new_versions(
    versions: DataFrame, target_versions: DataFrame, host: str, prefix: str, skip_existing: bool
) -> DataFrame:
    """Versions without a target version, plus ``target_model``.

    They meet by source name: the target's names lose their prefix, so that no made name goes along with the versions.
    The numbers that are there are gathered by segment, which bounds a set, and versions meet the set of their segment. So a
    model's versions travel next to each other, where their name compresses, and the columns that were made before the join
    are not made anew behind it from wider ones, as Spark would do with an anti-join.
    """
    if skip_existing:
        number = F.col("source_model_version").try_cast("bigint")
        made = target_versions.where(
            (F.col("source_host") == normal_host(host)) & F.col("model_name").startswith(prefix)
            & (number.cast("string") == F.col("source_model_version"))
        ).select(F.substr("model_name", F.lit(len(prefix) + 1)).alias("_model"), number.alias("_number"))
        sets = made.groupBy("_model", part_of(F.col("_number")).alias("_part")).agg(F.collect_set("_number").alias("_made"))
        met = versions.join(sets, (F.col("model_name") == F.col("_model")) & (part_of(F.col("version")) == F.col("_part")), "left")
        there = F.array_contains("_made", F.col("version").cast("bigint"))
        versions = met.where(~F.coalesce(there, F.lit(False))).select(*versions.columns)
    return versions.withColumn("target_model", target_model_name(F.col("model_name"), prefix))


def new_models(models: DataFrame, target_models: DataFrame, prefix: str) -> DataFrame:
    """Models without a target model, plus ``target_model``."""
    named = models.withColumn("target_model", target_model_name(F.col("model_name"), prefix))
    known = target_models.select(F.col("model_name").alias("target_model"))
    return named.join(known, "target_model", "left_anti").select(*named.columns)


def experiment_map(
    experiments: DataFrame, target_experiments: DataFrame, root: str, prefix: str,
    create_missing: bool,
) -> DataFrame:
    """source experiment_id -> target_name, target_experiment_id, is_new.

    Experiments with one target name share the target. A new id is made from
    the name. Without ``create_missing`` a missing target has a NULL id.
    """
    known = target_experiments.groupBy(F.col("name").alias("target_name")).agg(
        F.min(F.col("experiment_id").cast("string")).alias("_known")
    )
    named = experiments.select(
        "experiment_id", target_experiment_name(F.col("name"), root, prefix).alias("target_name")
    )
    made = stable_id(F.lit("experiment"), F.col("target_name")) if create_missing else F.lit(None)
    return named.join(known, "target_name", "left").select(
        "experiment_id", "target_name",
        F.coalesce(F.col("_known"), made.cast("string")).alias("target_experiment_id"),
        F.col("_known").isNull().alias("is_new"),
    )


def new_experiments(mapping: DataFrame) -> DataFrame:
    """One row by target experiment to create; the lowest source id stands for all."""
    return (
        mapping.where(F.col("is_new") & F.col("target_experiment_id").isNotNull())
        .groupBy("target_experiment_id", "target_name")
        .agg(F.min("experiment_id").alias("source_experiment_id"))
    )


def candidate_runs(listed_runs: DataFrame, all_runs: DataFrame, versions: DataFrame) -> DataFrame:
    """Listed runs of the experiments, and the runs of versions being cloned.

    The latter are fetched by id, so neither cap nor lifecycle applies to them.
    Only ids are made distinct; the runs themselves are read once more.
    """
    pointed = versions.where(F.col("run_id").isNotNull()).select("run_id")
    ids = listed_runs.select("run_id").union(pointed).distinct()
    return all_runs.join(ids, "run_id", "left_semi").select(*listed_runs.columns)


def run_places(
    candidates: DataFrame, mapping: DataFrame, target_runs: DataFrame, host: str
) -> DataFrame:
    """Candidate runs with target_experiment_id and the target run that is there already, as ``_known``.

    A run counts as cloned only inside its target experiment. Target runs are gathered by source run, one for each experiment
    that holds one, and meet the candidates by run id, where these lie already; so no name or id of an experiment moves with a run.
    """
    source_id = F.col("source_run_id").try_cast(candidates.schema["run_id"].dataType)
    known = target_runs.where(
        (source_id.cast("string") == F.col("source_run_id")) & (F.col("source_host") == normal_host(host))
    ).groupBy(F.col("experiment_id").cast("string").alias("target_experiment_id"), source_id.alias("_source")).agg(
        F.min(F.struct(F.col("run_id").cast("string").alias("run_id"), "artifact_uri")).alias("_known")
    )
    of_run = known.where(F.col("target_experiment_id").isNotNull()).groupBy(F.col("_source").alias("run_id")).agg(
        F.collect_list(F.struct("target_experiment_id", "_known")).alias("_all"))
    placed = candidates.join(of_run, "run_id", "left").join(
        mapping.select("experiment_id", "target_name", "target_experiment_id"), "experiment_id", "left")
    here = F.filter("_all", lambda k: k["target_experiment_id"] == F.col("target_experiment_id"))
    return placed.withColumn("_known", F.get(here, F.lit(0))["_known"]).drop("_all")


def run_ids(places: DataFrame, host: str) -> DataFrame:
    """Target ids of runs from :func:`run_places`; they are long and follow from the rest, so they need not be stored.

    A run whose experiment cannot be mapped has no target.
    """
    made = F.when(
        F.col("target_experiment_id").isNotNull(), stable_id(F.lit(normal_host(host)), F.col("run_id"))
    )
    return places.withColumns({
        "source_run_id": F.col("run_id").cast("string"),
        "target_run_id": F.coalesce(F.col("_known.run_id"), made),
        "target_artifact_uri": F.col("_known.artifact_uri"),
        "is_new": F.col("_known").isNull() & F.col("target_experiment_id").isNotNull(),
    }).drop("_known")


def run_map(
    candidates: DataFrame, mapping: DataFrame, target_runs: DataFrame, host: str
) -> DataFrame:
    """Candidate runs with target_experiment_id, target_run_id and is_new."""
    return run_ids(run_places(candidates, mapping, target_runs, host), host)


def new_runs(mapped: DataFrame) -> DataFrame:
    """Runs to clone."""
    return mapped.where(F.col("is_new"))


def placed_artifacts(mapped: DataFrame, artifact_root: str | None) -> DataFrame:
    """The map with the artifact address of every target run; new runs have none without a root (E5)."""
    made = F.concat_ws(
        "/", F.lit(artifact_root), F.col("target_experiment_id"), F.col("target_run_id"),
        F.lit("artifacts"),
    ) if artifact_root else F.lit(None).cast("string")
    return mapped.withColumn("target_artifact_uri", F.coalesce(F.col("target_artifact_uri"), made))


# -- experiments and models -------------------------------------------------

def target_experiments(mapping: DataFrame, host: str) -> DataFrame:
    """Experiments to create."""
    return new_experiments(mapping).select(
        F.lit(normal_host(host)).alias("source_host"),
        F.col("target_experiment_id").alias("experiment_id"), F.col("target_name").alias("name"),
        F.col("source_experiment_id").cast("string").alias("source_experiment_id"),
    )


def _provenance(rows: DataFrame, keys: list[str], tags: dict[str, Column]) -> DataFrame:
    """One row by record and provenance tag."""
    pairs = F.array(*[
        F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in tags.items()
    ])
    return rows.select(*keys, F.explode(pairs).alias("_t")).select(*keys, "_t.key", "_t.value")


def _source_wins(source_tags: DataFrame, provenance: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Source tags, and provenance where no source tag has its key.

    Only source tags with provenance keys take part in the join.
    """
    over = source_tags.where(F.col("key").isin(*names)).select(*keys, "key")
    kept = provenance.join(over, [*keys, "key"], "left_anti")
    return source_tags.select(*keys, "key", "value").unionByName(kept.select(*keys, "key", "value"))


def target_experiment_tags(mapping: DataFrame, experiment_tags: DataFrame, host: str) -> DataFrame:
    """Tags to set on new and existing target experiments.

    Where sources share a target, the highest source id wins.
    """
    created = new_experiments(mapping).withColumnRenamed("target_experiment_id", "experiment_id")
    provenance = _provenance(
        created, ["experiment_id"],
        {TAG_HOST: F.lit(normal_host(host)), TAG_EXPERIMENT: F.col("source_experiment_id")},
    )
    placed = mapping.where(F.col("target_experiment_id").isNotNull()).select(
        "experiment_id", "target_experiment_id"
    )
    source = (
        drop_reserved_tags(experiment_tags).join(placed, "experiment_id")
        .groupBy(F.col("target_experiment_id").alias("experiment_id"), "key")
        .agg(F.max_by("value", "experiment_id").alias("value"))
    )
    return _source_wins(source, provenance, ["experiment_id"], [TAG_HOST, TAG_EXPERIMENT])


def _commit_ms(now: Column | None) -> Column:
    return F.unix_millis(F.current_timestamp() if now is None else now).alias("creation_ms")


def target_models(models: DataFrame, host: str, now: Column | None = None) -> DataFrame:
    """Models to create, from :func:`new_models`; created ``now`` (R2)."""
    return models.select(
        F.lit(normal_host(host)).alias("source_host"), F.col("target_model").alias("model_name"),
        "description", _commit_ms(now), F.col("model_name").alias("source_model_name"),
    )


def target_model_tags(
    models: DataFrame, created: DataFrame, model_tags: DataFrame, host: str, prefix: str
) -> DataFrame:
    """Tags to set on new and existing target models; reserved ones are kept (R2)."""
    provenance = _provenance(
        created.select("model_name", "source_model_name"), ["model_name"],
        {TAG_HOST: F.lit(normal_host(host)), TAG_MODEL: F.col("source_model_name")},
    )
    source = model_tags.join(models.select("model_name"), "model_name", "left_semi").select(
        target_model_name(F.col("model_name"), prefix).alias("model_name"), "key", "value"
    )
    return _source_wins(source, provenance, ["model_name"], [TAG_HOST, TAG_MODEL])


# -- runs -------------------------------------------------------------------

def _batch(df: DataFrame) -> list[str]:
    return [BATCH] if BATCH in df.columns else []


def _new_ids(mapped: DataFrame) -> DataFrame:
    return new_runs(mapped).select("run_id", "target_run_id", *_batch(mapped))


def _under_new_id(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of new runs under their target id."""
    rest = [c for c in rows.columns if c not in ("run_id", "source_host")]
    return rows.join(ids, "run_id").select(F.col("target_run_id").alias("run_id"), *rest, *_batch(ids))


def target_runs(mapped: DataFrame, run_tags: DataFrame, host: str) -> DataFrame:
    """Runs to create, from a map with artifact addresses; a run is active in the target."""
    names = run_tags.where(F.col("key") == TAG_RUN_NAME).select("run_id", F.col("value").alias("_name"))
    return new_runs(mapped).join(names, "run_id", "left").select(
        F.lit(normal_host(host)).alias("source_host"), F.col("target_run_id").alias("run_id"),
        F.col("target_experiment_id").alias("experiment_id"), F.col("_name").alias("run_name"),
        "run_user", "status", F.lit(ACTIVE).alias("lifecycle"), "start_ms", "end_ms",
        F.col("target_artifact_uri").alias("artifact_uri"), "source_run_id", *_batch(mapped),
    )


def target_run_tags(mapped: DataFrame, run_tags: DataFrame, host: str) -> DataFrame:
    """Tags of new runs; here provenance wins."""
    ids = _new_ids(mapped)
    source = drop_reserved_tags(run_tags).where(~F.col("key").isin(TAG_HOST, TAG_RUN))
    provenance = _provenance(
        ids.withColumnRenamed("run_id", "_source").withColumnRenamed("target_run_id", "run_id"),
        ["run_id", *_batch(ids)], {TAG_HOST: F.lit(normal_host(host)), TAG_RUN: F.col("_source")},
    )
    return _under_new_id(source.select("run_id", "key", "value"), ids).unionByName(provenance)


def target_params(mapped: DataFrame, run_params: DataFrame) -> DataFrame:
    """Params of new runs."""
    return _under_new_id(run_params.select("run_id", "key", "value"), _new_ids(mapped))


def target_metrics(mapped: DataFrame, run_metrics: DataFrame) -> DataFrame:
    """Latest metric values of new runs, as the target keeps them beside R6."""
    return _under_new_id(run_metrics.select("run_id", "key", "value"), _new_ids(mapped))


def metric_history(
    mapped: DataFrame, run_metrics: DataFrame, metric_points: DataFrame, stage: Callable[[DataFrame, str], DataFrame] | None = None
) -> DataFrame:
    """Every point of every metric of the new runs.

    A metric without points yields one synthetic point; points of no metric are
    dropped. An inner join and an anti-join rather than one outer join, since
    an outer join could not split a series that holds much of the table. With ``stage`` (see
    :func:`modelferry.session.written`) the joined points are kept, so the source's points are read and moved once, and
    the anti-join reads the two key columns of the points that move alone; without it the inner join is made twice.
    """
    new = new_runs(mapped).select("run_id", "target_run_id", "start_ms", "end_ms", *_batch(mapped))
    metrics = run_metrics.select("run_id", "key", "value").join(new, "run_id")
    points = metric_points.select("run_id", "key", "value", "ts_ms", "step").join(
        metrics.select("run_id", "key", "target_run_id", *_batch(mapped)), ["run_id", "key"]
    )
    if stage:
        points = stage(points, "points")
    recorded = points.select("run_id", "key").distinct()
    ended = F.nullif(F.col("end_ms"), F.lit(0).cast("bigint"))
    started = F.nullif(F.col("start_ms"), F.lit(0).cast("bigint"))
    synthetic = metrics.join(recorded, ["run_id", "key"], "left_anti").select(
        F.col("target_run_id").alias("run_id"), "key", "value",
        F.coalesce(ended, started, F.lit(0)).cast("bigint").alias("ts_ms"),
        F.lit(0).cast("bigint").alias("step"), *_batch(mapped),
    )
    moved = points.select(F.col("target_run_id").alias("run_id"), "key", "value", "ts_ms", "step", *_batch(mapped))
    return moved.unionByName(synthetic)


# -- versions ---------------------------------------------------------------

def with_model_path(versions: DataFrame) -> DataFrame:
    """With the path of the model files below the run in place of the address, of which nothing else goes on."""
    return versions.withColumn("model_path", model_artifact_path(F.col("source_uri"))).drop("source_uri")


def judged_versions(
    versions: DataFrame, mapped: DataFrame, source_artifacts: DataFrame, target_artifacts: DataFrame,
    ids: Callable[[DataFrame], DataFrame] = lambda places: places,
) -> DataFrame:
    """Versions to clone with their target run, model path and failure reason.

    ``reason`` is NULL when the version can be created; otherwise it has no target. ``on_target`` says that
    the target run holds the model files already. A verdict depends on the run and the path alone, so it is
    reached for these and looked up once by the versions, which are much wider. ``versions`` come from
    :func:`with_model_path`. ``mapped`` may be places without target ids
    (:func:`run_places`); then ``ids`` adds these, after the joins that need not move them.
    """
    pairs = versions.where(F.col("run_id").isNotNull()).select("run_id", "model_path").distinct()
    verdicts = _verdicts(pairs, mapped, source_artifacts, target_artifacts, ids)
    no_run = F.concat(
        F.lit("Model version "), F.col("model_name"), F.lit(" v"), F.col("version").cast("string"), F.lit(NO_RUN_ID))
    return parted_lookup(versions, verdicts, ["run_id", "model_path"], ["model_name", "version"]).withColumns({
        "reason": F.when(F.col("run_id").isNull(), F.left(no_run, F.lit(REASON_LENGTH))).otherwise(F.col("reason")),
        "on_target": F.coalesce(F.col("on_target"), F.lit(False)),
    })


def _verdicts(
    pairs: DataFrame, mapped: DataFrame, source_artifacts: DataFrame, target_artifacts: DataFrame,
    ids: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Target run, reason and on_target of distinct (run_id, model_path).

    Files are looked up for all pairs, also those of runs without a target, whose reason does not ask for files. So the pairs
    meet them where they were made distinct, and the runs meet the pairs once.
    """
    of_run = ("target_experiment_id", "_known", "target_run_id", "target_artifact_uri", "is_new")
    runs = mapped.select(
        "run_id", "target_name", "experiment_id", *[c for c in of_run if c in mapped.columns], F.lit(True).alias("_found"))
    places = ids(mapped).where(~F.col("is_new")).select("run_id", "target_run_id")
    there = target_artifacts.select(F.col("run_id").cast("string").alias("target_run_id"), "path")
    on_source = in_folders(source_artifacts.select("run_id", "path"), pairs)
    # In the target a folder must hold files; the same name as a file is not enough.
    on_target = in_folders(
        there.join(places, "target_run_id").select("run_id", "path"), pairs, with_itself=False
    )
    files = (
        on_source.select("run_id", "model_path", F.lit(False).alias("_there"))
        .unionByName(on_target.select("run_id", "model_path", F.lit(True).alias("_there")))
        .groupBy("run_id", "model_path")
        .agg(F.max("_there").alias("on_target"), F.lit(True).alias("_files"))
    )
    looked = ids(pairs.join(files, ["run_id", "model_path"], "left").join(runs, "run_id", "left"))
    judged = looked.withColumnRenamed("experiment_id", "_experiment").withColumn("reason", F.left(_reason(), F.lit(REASON_LENGTH)))
    good = F.col("reason").isNull()
    return judged.select(
        "run_id", "model_path", *[F.when(good, F.col(c)).alias(c) for c in ("target_run_id", "target_artifact_uri")],
        "on_target", "reason")


def _reason() -> Column:
    run, experiment = F.col("run_id").cast("string"), F.col("_experiment").cast("string")
    return (
        F.when(F.col("_found").isNull(), F.concat(F.lit("Run "), run, F.lit(" not found")))
        .when(F.col("target_name").isNull(), F.concat(F.lit("Experiment "), experiment, F.lit(" not found")))
        .when(
            F.col("target_run_id").isNull(),
            F.concat(F.lit(NO_EXPERIMENT), F.col("target_name")),
        )
        .when(
            F.col("_files").isNull(),
            F.concat(F.lit("No model artifacts at "), F.col("model_path"), F.lit(" in run "), run),
        )
    )


def version_failures(judged: DataFrame) -> DataFrame:
    """model_name, version, reason of versions that cannot be created."""
    return judged.where(F.col("reason").isNotNull()).select("model_name", "version", "reason")


def run_failures(mapped: DataFrame) -> DataFrame:
    """run_id, experiment_id, reason of runs that have no place in the target."""
    lost = F.when(F.col("target_name").isNull(), F.concat(
        F.lit("Experiment "), F.col("experiment_id").cast("string"), F.lit(" not found")
    )).otherwise(F.concat(F.lit(NO_EXPERIMENT), F.col("target_name")))
    return mapped.where(F.col("target_run_id").isNull()).select(
        F.col("run_id").cast("string").alias("run_id"), F.col("experiment_id").cast("string").alias("experiment_id"),
        F.left(lost, F.lit(REASON_LENGTH)).alias("reason"),
    )


def file_failures(copied: DataFrame) -> DataFrame:
    """run_id, path, reason of files that could not be copied, model files or not."""
    return copied.where(~F.col("ok")).select(
        F.col("run_id").cast("string").alias("run_id"), "path",
        F.left(F.col("error"), F.lit(REASON_LENGTH)).alias("reason"),
    )


def target_versions(
    judged: DataFrame, existing: DataFrame, host: str, now: Column | None = None
) -> DataFrame:
    """Versions to create, numbered after the existing ones; created ``now``."""
    last = existing.groupBy(F.col("model_name").alias("target_model")).agg(
        F.max("version").alias("last_version")
    )
    good = judged.where(F.col("reason").isNull())
    return next_versions(good, "target_model", last).select(
        F.lit(normal_host(host)).alias("source_host"), F.col("target_model").alias("model_name"),
        F.col("target_version").alias("version"), F.col("target_run_id").alias("run_id"), "user_id", "stage",
        model_source_uri(F.col("target_artifact_uri"), F.col("model_path")).alias("source_uri"),
        "description", _commit_ms(now), F.col("version").cast("string").alias("source_model_version"),
        F.col("model_name").alias("source_model_name"), F.col("version").alias("_version"),
    )


def target_version_tags(created: DataFrame, version_tags: DataFrame, host: str) -> DataFrame:
    """Tags of the created versions; source wins, reserved ones are kept."""
    provenance = _provenance(
        created.select("model_name", "version", "source_model_name", "source_model_version"),
        ["model_name", "version"],
        {
            TAG_HOST: F.lit(normal_host(host)), TAG_MODEL: F.col("source_model_name"),
            TAG_VERSION: F.col("source_model_version"),
        },
    )
    place = created.select(
        F.col("source_model_name").alias("_model"), "_version",
        F.col("model_name").alias("_target"), F.col("version").alias("_number"),
    )
    source = version_tags.select(
        F.col("model_name").alias("_model"), F.col("version").alias("_version"), "key", "value"
    ).join(place, ["_model", "_version"]).select(
        F.col("_target").alias("model_name"), F.col("_number").alias("version"), "key", "value"
    )
    return _source_wins(source, provenance, ["model_name", "version"], [TAG_HOST, TAG_MODEL, TAG_VERSION])


def migration_summary(
    models: DataFrame, experiments: DataFrame, created: DataFrame, migrate_models: bool = True
) -> DataFrame:
    """One row: what was migrated (A8). ``migrated_runs`` counts one per version."""
    versions = created.agg(
        F.count(F.lit(1)).alias("migrated_model_versions"),
        F.count(F.lit(1)).alias("migrated_runs"),
        F.count_distinct("run_id").alias("distinct_runs"),
    )
    # Each side is a single row, so the lookups below are scalars.
    n_models = models.agg(F.count(F.lit(1))).scalar() if migrate_models else F.lit(0).cast("bigint")
    n_experiments = experiments.agg(F.count(F.lit(1))).scalar()
    return versions.select(
        n_models.alias("migrated_models"), "migrated_model_versions",
        n_experiments.alias("migrated_experiments"), "migrated_runs", "distinct_runs",
    )
