"""One row by model: what there is to migrate.

Only a version's name, number and run go to the runs; its experiment's facts are
looked up by the runs, which are fewer. What a version says itself and what its run
says are two narrow rows that move once, to the segment of the model's versions.
Each segment keeps sums, distinct values and joined comments, so that the versions of
a large model are gathered all over the cluster, and segments are merged by model.
Requirement texts are long: rows hold the run that has them, and the text is
looked up for the one run that is left by model.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelferry.functions.names import normalize_host
from modelferry.functions.status import BAD_MARK, ERROR_PREFIX, PENDING, OK_MARK, WARN_MARK, readiness
from modelferry.functions.text import cut, joined_sorted
from modelferry.functions.times import day_text, minute_text
from modelferry.operators.counts import COUNTS, runs_per_experiment, with_counts
from modelferry.operators.joins import outer_lookup
from modelferry.operators.long_texts import PART, in_order, part_of
from modelferry.operators.references import BLOCKED, RUN_MISSING, experiment_label, version_states
from modelferry.operators.scope import lifecycle
from modelferry.options import Options
from modelferry.schemas import TRACKING, Snapshot

# Message lengths in comments, and separators of joined texts.
VERSION_MESSAGE = 80
ERROR_READINESS = 60
ERROR_COMMENT = 120
# Fixed value: how the comment of a failed model begins.
ERROR_COMMENT_PREFIX = "Inventory error: "
LIST_SEPARATOR = ", "
NAME_SEPARATOR = " | "
COMMENT_SEPARATOR = "; "
NO_STAGE = "None"


def _experiment_facts(snapshot: Snapshot, options: Options, in_reach: DataFrame | None) -> DataFrame:
    """One row by experiment: how often it is listed, its names, and its runs (0 when out of reach) as often as it is listed."""
    runs = lifecycle(snapshot.runs, options.include_deleted_runs)
    per_experiment = runs_per_experiment(runs, options.max_runs_per_experiment)
    if not options.migrate_experiments:
        per_experiment = per_experiment.where(F.lit(False))
    elif in_reach is not None:
        per_experiment = per_experiment.join(
            in_reach.select("experiment_id"), "experiment_id", "left_semi"
        )
    label = experiment_label(F.col("name"), F.col("experiment_id"))
    listed = snapshot.experiments.where(F.col("experiment_id").isNotNull()).groupBy("experiment_id").agg(
        F.count(F.lit(1)).alias("_listed"), F.collect_set(label).alias("_names"))
    return listed.join(per_experiment, "experiment_id", "left").select(
        "experiment_id", "_listed", (F.col("_listed") * F.coalesce("runs", F.lit(0))).alias("_runs"),
        F.get("_names", F.lit(0)).alias("_name"),
        F.when(F.size("_names") > 1, F.slice("_names", 2, F.size("_names") - 1)).alias("_more_names"),
    )


def _laid_out(
    snapshot: Snapshot, counts: DataFrame, options: Options,
    in_reach: DataFrame | None, metadata: DataFrame | None,
) -> DataFrame:
    """Two narrow rows by version: what it says itself, and what its run says; what the other says is null."""
    facts = _experiment_facts(snapshot, options, in_reach)
    runs = with_counts(
        outer_lookup(snapshot.runs.select("run_id", "experiment_id", "run_user"), facts, ["experiment_id"], ["run_id"]), counts)
    if metadata is not None:
        runs = runs.join(metadata.select("run_id", "flavors", "python_version"), "run_id", "left")
    part = part_of(F.col("version")).alias(PART)
    own = snapshot.versions.select(
        "model_name", part, F.nullif(F.nullif(F.col("stage"), F.lit("")), F.lit(NO_STAGE)).alias("stage"),
        F.nullif(F.col("user_id"), F.lit("")).alias("owner"), "creation_ms",
    )
    # A found run without a user counts as the version's user's, who is there already.
    states = version_states(snapshot.versions.select("model_name", "version", "run_id"), runs)
    blocked = F.col("run_state") == BLOCKED
    of_run = [
        "model_name", part, F.nullif(F.col("run_user"), F.lit("")).alias("owner"), F.lit(1).alias("versions"),
        F.when(blocked, F.col("version")).alias("blocked_version"), blocked.cast("int").alias("blocked"),
        *[F.nullif(F.col(c), F.lit(0)).alias(c) for c in COUNTS],
        "experiment_id", "_listed", "_runs", "_name", "_more_names",
    ]
    if metadata is not None:
        flavors = F.nullif(F.col("flavors"), F.lit(""))
        described = flavors.isNotNull() & F.col("version").isNotNull()
        of_run += [
            flavors.alias("flavors"), F.nullif(F.col("python_version"), F.lit("")).alias("python_version"),
            F.when(described, F.struct("version", F.col("run_id").cast("string").alias("run_id"))).alias("described"),
        ]
    return states.select(*of_run).unionByName(own, allowMissingColumns=True)


def _merged(column: str) -> Column:
    """Aggregate: the distinct elements of arrays."""
    return F.array_distinct(F.flatten(F.collect_list(column)))


def _by_model(
    snapshot: Snapshot, counts: DataFrame, options: Options,
    in_reach: DataFrame | None, metadata: DataFrame | None,
) -> DataFrame:
    laid = _laid_out(snapshot, counts, options, in_reach, metadata)
    sums = ["versions", "blocked", *COUNTS]
    sets = {"stages": "stage", "owners": "owner"}
    if metadata is not None:
        sets |= {"flavors": "flavors", "python_version": "python_version"}
    latest = {"latest_ms": "creation_ms"} | ({"described": "described"} if metadata is not None else {})
    experiment = F.when(F.col("experiment_id").isNotNull(), F.struct(
        "experiment_id", F.coalesce("_listed", F.lit(1)).alias("listed"), F.coalesce("_runs", F.lit(0)).alias("runs"),
        experiment_label(F.col("_name"), F.col("experiment_id")).alias("name"), F.col("_more_names").alias("more")))
    lost = F.array_sort(F.collect_set("blocked_version"))
    comments = F.array_join(F.transform(lost, lambda v: F.concat(
        F.lit("v"), v.cast("string"), F.lit(": "), cut(F.lit(RUN_MISSING), VERSION_MESSAGE))), COMMENT_SEPARATOR)
    # Moved as they are: rows of a part are hardly ever in one task before, so summing them up there saves nothing.
    parts = laid.repartition("model_name", PART).groupBy("model_name", PART).agg(
        *[F.sum(c).alias(c) for c in sums], *[F.max(c).alias(name) for name, c in latest.items()],
        *[F.collect_set(c).alias(name) for name, c in sets.items()], F.collect_set(experiment).alias("used"),
        F.nullif(comments, F.lit("")).alias("comments"),
    )
    merged = parts.repartition("model_name").groupBy("model_name").agg(
        *[F.sum(c).alias(c) for c in sums], *[F.max(c).alias(c) for c in latest],
        *[_merged(c).alias(c) for c in (*sets, "used")],
        in_order(F.col(PART), F.col("comments"), COMMENT_SEPARATOR).alias("comments"),
    )

    def total(field: str) -> Column:
        return F.aggregate("used", F.lit(0).cast("bigint"), lambda so_far, e: so_far + e[field])

    names = F.flatten(F.transform("used", lambda e: F.concat(
        F.array(e["name"]), F.coalesce(e["more"], F.array().cast("array<string>")))))
    separators = {"flavors": NAME_SEPARATOR}
    columns = [
        "model_name", "versions", "blocked", "params", "metrics", F.col("model_files").alias("files"), "latest_ms", "comments",
        total("listed").alias("experiment_count"), total("runs").alias("runs"),
        joined_sorted(F.array_distinct(names), NAME_SEPARATOR).alias("experiment_names"),
        *[joined_sorted(F.col(c), separators.get(c, LIST_SEPARATOR)).alias(c) for c in sets],
    ]
    if metadata is not None:
        columns.append(F.col("described.run_id").alias("described_run"))
    return merged.select(*columns)


def inventory(
    snapshot: Snapshot, counts: DataFrame, options: Options, target_host: str,
    in_reach: DataFrame | None = None, metadata: DataFrame | None = None,
    now: Column | None = None, requirements: DataFrame | None = None,
) -> DataFrame:
    """The inventory of ``snapshot.models``, in tracking-table columns (A1).

    ``counts`` are the per-run counts (A12). ``in_reach`` limits the experiments
    whose runs count, needed when versions are capped; None means all.
    ``metadata`` (run_id, flavors, python_version) is optional (X3); requirement texts
    (run_id, requirements) may be among its columns or come as ``requirements``.
    """
    by_model = _by_model(snapshot, counts, options, in_reach, metadata)
    if metadata is not None:
        texts = metadata if requirements is None else requirements
        by_model = outer_lookup(
            by_model, texts.select(F.col("run_id").alias("described_run"), "requirements"), ["described_run"], ["model_name"])
    joined = snapshot.models.select("model_name", F.col("creation_ms").alias("model_ms")).join(
        by_model, "model_name", "left"
    )

    def count(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(0)).cast("int")

    def text(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(""))

    null_text = F.lit(None).cast("string")
    blocked = count("blocked")
    ready = count("versions") - blocked
    filled = {
        "source_host": normalize_host(F.lit(snapshot.host)),
        "target_host": normalize_host(F.lit(target_host)),
        "model_name": F.col("model_name"),
        "readiness": readiness(ready, blocked),
        "source_versions": count("versions"),
        "source_versions_migratable": ready,
        "source_versions_blocked": blocked,
        "source_experiments": count("experiment_count"),
        "source_runs": count("runs"),
        "source_params": count("params"),
        "source_metrics": count("metrics"),
        "source_artifacts": count("files"),
        "stages": F.coalesce(F.nullif(F.col("stages"), F.lit("")), F.lit(NO_STAGE)),
        "owner_emails": text("owners"),
        "experiments": text("experiment_names"),
        "latest_version_created": minute_text(F.col("latest_ms")),
        "created": day_text(F.col("model_ms")),
        "discovery_comments": F.nullif(F.col("comments"), F.lit("")),
        "last_updated_at": F.current_timestamp() if now is None else now,
    }
    if metadata is not None:
        filled["flavors"] = F.nullif(F.col("flavors"), F.lit(""))
        filled["requirements"] = F.nullif(F.col("requirements"), F.lit(""))
        filled["python_version"] = F.nullif(F.col("python_version"), F.lit(""))
    return joined.select(*_tracking_row(filled, null_text))


def _tracking_row(filled: dict[str, Column], null_text: Column) -> list[Column]:
    """All tracking columns: the given ones, else the state before migration."""
    row = []
    for field in TRACKING:
        value = filled.get(field.name)
        if value is None:
            if field.name == "migration_status":
                value = F.lit(PENDING)
            elif field.dataType.typeName() == "integer":
                value = F.lit(0)
            else:
                value = null_text
        row.append(value.cast(field.dataType).alias(field.name))
    return row


def error_rows(
    failures: DataFrame, source_host: str, target_host: str, now: Column | None = None
) -> DataFrame:
    """Inventory rows of models that could not be read: (model_name, message)."""
    message = F.col("message")
    filled = {
        "source_host": normalize_host(F.lit(source_host)),
        "target_host": normalize_host(F.lit(target_host)),
        "model_name": F.col("model_name"),
        "readiness": F.concat(F.lit(ERROR_PREFIX), cut(message, ERROR_READINESS)),
        "stages": F.lit(NO_STAGE),
        "owner_emails": F.lit(""),
        "experiments": F.lit(""),
        "latest_version_created": F.lit(""),
        "created": F.lit(""),
        "discovery_comments": F.concat(F.lit(ERROR_COMMENT_PREFIX), cut(message, ERROR_COMMENT)),
        "last_updated_at": F.current_timestamp() if now is None else now,
    }
    return failures.select(*_tracking_row(filled, F.lit(None).cast("string")))


def with_error_rows(rows: DataFrame, errors: DataFrame) -> DataFrame:
    """A model that failed has its error row instead of its inventory row."""
    return rows.join(errors.select("model_name"), "model_name", "left_anti").select(
        *rows.columns
    ).unionByName(errors)


def inventory_summary(rows: DataFrame) -> DataFrame:
    """One row of totals (A6); an error row counts as blocked."""
    # Each row is laid out as itself and its owners, so one pass gives totals and owners.
    owners = F.split(F.nullif(F.col("owner_emails"), F.lit("")), LIST_SEPARATOR)
    laid = rows.select(
        "source_versions", "source_versions_migratable", "readiness",
        F.posexplode(F.concat(F.array(F.lit(None).cast("string")), F.coalesce(owners, F.array().cast("array<string>")))).alias("_place", "_owner"),
    )
    itself = F.col("_place") == 0

    def total(column: str) -> Column:
        return F.coalesce(F.sum(F.when(itself, F.col(column))), F.lit(0))

    def marked(mark: str) -> Column:
        return F.count_if(itself & F.col("readiness").startswith(mark))

    return laid.agg(
        F.count_if(itself).alias("models"), total("source_versions").alias("versions"),
        total("source_versions_migratable").alias("migratable"), marked(OK_MARK).alias("ready"),
        marked(WARN_MARK).alias("partial"), marked(BAD_MARK).alias("blocked"),
        F.count_distinct("_owner").alias("unique_owners"),
    )
