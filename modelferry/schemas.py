"""Fixed table schemas, and the registry snapshot that carries them.

Ids are opaque strings in stored snapshots; operators never depend on the id
type, so a snapshot built from other tables may use BIGINT ids.
"""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


_TYPES = {"string": "string", "int": "integer", "bigint": "long", "double": "double", "timestamp": "timestamp"}


def _ddl(text: str) -> StructType:
    """Schema of 'name type, ...'; needs no session, so tasks may import this module."""
    schema = StructType()
    for field in text.split(","):
        name, kind = field.split()
        schema.add(name, _TYPES[kind])
    return schema


# Provenance columns (source_host and source_*) are NULL in a source registry
# and filled in a target one.
TABLES: dict[str, StructType] = {
    "models": _ddl(
        "source_host string, model_name string, description string, creation_ms bigint, "
        "source_model_name string"
    ),
    "versions": _ddl(
        "source_host string, model_name string, version int, run_id string, user_id string, "
        "stage string, source_uri string, description string, creation_ms bigint, "
        "source_model_version string"
    ),
    "experiments": _ddl(
        "source_host string, experiment_id string, name string, source_experiment_id string"
    ),
    "runs": _ddl(
        "source_host string, run_id string, experiment_id string, run_name string, "
        "run_user string, status string, lifecycle string, start_ms bigint, end_ms bigint, "
        "artifact_uri string, source_run_id string"
    ),
    "run_params": _ddl("source_host string, run_id string, key string, value string"),
    "run_metrics": _ddl("source_host string, run_id string, key string, value double"),
    "metric_points": _ddl(
        "source_host string, run_id string, key string, value double, ts_ms bigint, step bigint"
    ),
    "run_tags": _ddl("source_host string, run_id string, key string, value string"),
    "run_artifacts": _ddl("source_host string, run_id string, path string, size_bytes bigint"),
    "model_tags": _ddl("source_host string, model_name string, key string, value string"),
    "version_tags": _ddl(
        "source_host string, model_name string, version int, key string, value string"
    ),
    "experiment_tags": _ddl("source_host string, experiment_id string, key string, value string"),
}

TRACKING = _ddl(
    "source_host string, target_host string, model_name string, readiness string, "
    "source_versions int, source_versions_migratable int, source_versions_blocked int, "
    "source_experiments int, source_runs int, source_params int, source_metrics int, "
    "source_artifacts int, stages string, owner_emails string, flavors string, "
    "requirements string, python_version string, experiments string, "
    "latest_version_created string, created string, target_versions int, target_runs int, "
    "target_params int, target_metrics int, target_artifacts int, migration_status string, "
    "discovery_comments string, migration_comments string, target_model_url string, "
    "target_experiment_urls string, last_updated_at timestamp"
)

# Position of the last outcome event applied to a tracking row, kept beside it.
POSITION = _ddl("event_ms bigint, event_id bigint")

# Files that could not be copied, with the time of their next attempt.
RETRIES = _ddl(
    "run_id string, target_run_id string, path string, parent string, size_bytes bigint, "
    "source_address string, target_address string, attempts int, next_ms bigint, error string"
)

TRACKING_KEYS = ("source_host", "model_name")

# Written by target outcomes only.
TARGET_COLUMNS = (
    "target_versions", "target_runs", "target_params", "target_metrics", "target_artifacts",
    "migration_status", "migration_comments", "target_model_url", "target_experiment_urls",
)

# Written by the inventory only.
SOURCE_COLUMNS = tuple(
    f.name for f in TRACKING
    if f.name not in TRACKING_KEYS + TARGET_COLUMNS + ("last_updated_at",)
)


@dataclass(frozen=True)
class Snapshot:
    """Lazy DataFrames of one registry, all read from one workspace ``host``."""

    host: str
    models: DataFrame
    versions: DataFrame
    experiments: DataFrame
    runs: DataFrame
    run_params: DataFrame
    run_metrics: DataFrame
    metric_points: DataFrame | None
    run_tags: DataFrame | None
    run_artifacts: DataFrame
    model_tags: DataFrame | None = None
    version_tags: DataFrame | None = None
    experiment_tags: DataFrame | None = None

    def with_tables(self, **tables: DataFrame) -> "Snapshot":
        return replace(self, **tables)

    @staticmethod
    def table_names() -> list[str]:
        return [f.name for f in fields(Snapshot) if f.name != "host"]
