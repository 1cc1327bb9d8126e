"""Classes of models and versions, and match flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Status texts that reports and tracking tables must carry.
READY = "✅ READY"
BLOCKED = "❌ BLOCKED — all runs deleted"
PARTIAL_PREFIX = "⚠️ PARTIAL — "
ERROR_PREFIX = "❌ ERROR — "
OK_MARK = "✅"
BAD_MARK = "❌"
WARN_MARK = "⚠"
MIGRATED = "✅ MIGRATED"
RUN_DELETED = "❌ RUN_DELETED"
NO_ARTIFACTS = "❌ NO_ARTIFACTS"
FAILED_VERSION = "⚠️ FAILED"
PENDING = "PENDING"
COMPLETED = "COMPLETED"
PARTIAL = "PARTIAL"
FAILED = "FAILED"
SKIPPED = "SKIPPED"


def readiness(ready: Column, blocked: Column) -> Column:
    """Readiness of a model from its version counts."""
    total = (ready + blocked).cast("string")
    partial = F.concat(
        F.lit(PARTIAL_PREFIX), ready.cast("string"), F.lit("/"), total,
        F.lit(" versions migratable"),
    )
    return F.when(ready == 0, BLOCKED).when(blocked > 0, partial).otherwise(READY)


def readiness_code(text: Column) -> Column:
    """Plain code of a readiness text; an error row counts as blocked."""
    return (
        F.when(text.startswith(OK_MARK), "READY")
        .when(text.startswith(WARN_MARK), "PARTIAL")
        .when(text.startswith(BAD_MARK), "BLOCKED")
    )


def migration_status(target: Column, migratable: Column, failures: Column) -> Column:
    """Status of a finished model."""
    return (
        F.when((target >= migratable) & (migratable > 0), COMPLETED)
        .when(target > 0, PARTIAL)
        .when(failures > 0, FAILED)
        .otherwise(SKIPPED)
    )


def version_status(has_target: Column, run_found: Column, model_files: Column) -> Column:
    """Status of one version in the comparison report."""
    return (
        F.when(has_target, MIGRATED)
        .when(~run_found, RUN_DELETED)
        .when(model_files == 0, NO_ARTIFACTS)
        .otherwise(FAILED_VERSION)
    )


def counts_match(has_target: Column, target_run: Column, source: Column, target: Column) -> Column:
    """Equal counts; false without a readable target run, NULL without a target."""
    return F.when(has_target, F.when(target_run, source == target).otherwise(False))
