"""Changes of the tracking table, as DataFrames.

Plain Parquet has no MERGE; each change is the whole next state of the table,
which the store writes beside the current one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelferry.functions.names import normal_host, normalize_host
from modelferry.functions.status import FAILED, PENDING
from modelferry.operators.joins import sole_rows
from modelferry.schemas import POSITION, SOURCE_COLUMNS, TARGET_COLUMNS, TRACKING_KEYS

_STAMP = "last_updated_at"
_POSITION = POSITION.fieldNames()


def _normal(df: DataFrame) -> DataFrame:
    return df.withColumn("source_host", normalize_host(F.col("source_host")))


def merge_inventory(
    tracking: DataFrame, staged: DataFrame, now: Column | None = None,
    source_columns: tuple[str, ...] = SOURCE_COLUMNS,
) -> DataFrame:
    """Upsert by (source_host, model_name).

    Known models get the source columns, new ones the whole row; the target
    side, the status, columns that ``staged`` lacks, and rows of other hosts stay
    as they are.
    """
    keys = list(TRACKING_KEYS)
    now = F.current_timestamp() if now is None else now
    old = _normal(tracking).withColumn("_old", F.lit(True)).alias("old")
    new = sole_rows(_normal(staged), keys, "inventory").withColumn("_new", F.lit(True)).alias("new")
    both = old.join(new, keys, "full_outer")
    is_old, is_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()

    def value(name: str) -> Column:
        if name in keys:
            return F.col(name)
        kept = F.col(f"old.{name}")
        if name not in staged.columns:
            return kept.alias(name)
        staged_value = F.col(f"new.{name}")
        if name == _STAMP:
            return F.when(is_new, now).otherwise(kept).alias(name)
        if name in source_columns:
            return F.when(is_new, staged_value).otherwise(kept).alias(name)
        return F.when(is_old, kept).otherwise(staged_value).alias(name)

    return both.select(*[value(c) for c in tracking.columns])


def apply_outcomes(
    tracking: DataFrame, outcomes: DataFrame, now: Column | None = None,
    target_columns: tuple[str, ...] = TARGET_COLUMNS,
) -> DataFrame:
    """Set the target columns of finished models.

    Outcomes of unknown models are ignored; NULL overwrites. Columns of
    ``outcomes`` beyond ``target_columns`` are set too when tracking has them.
    """
    keys = list(TRACKING_KEYS)
    now = F.current_timestamp() if now is None else now
    done = sole_rows(_normal(outcomes), keys, "outcomes").withColumn("_done", F.lit(True)).alias("new")
    both = tracking.alias("old").join(done, keys, "left")
    hit = F.col("_done").isNotNull()

    def value(name: str) -> Column:
        if name in keys:
            return F.col(name)
        if name == _STAMP:
            return F.when(hit, now).otherwise(F.col(f"old.{name}")).alias(name)
        if name in target_columns:
            return F.when(hit, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}")).alias(name)
        return F.col(f"old.{name}")

    return both.select(*[value(c) for c in tracking.columns])


def newest(outcomes: DataFrame) -> DataFrame:
    """Of each model the outcome with the last position."""
    values = [c for c in outcomes.columns if c not in TRACKING_KEYS]
    return outcomes.groupBy(*TRACKING_KEYS).agg(
        F.max_by(F.struct(*values), F.struct(*_POSITION)).alias("_last")
    ).select(*TRACKING_KEYS, "_last.*")


def apply_latest(tracking: DataFrame, latest: DataFrame) -> DataFrame:
    """Tracking with positions after outcomes, one a model.

    An outcome at or before a row's position changes nothing, so one that comes twice, or out of order,
    has no further effect.
    """
    seen = tracking.select(
        *TRACKING_KEYS, *[F.col(c).alias(f"_seen_{c}") for c in _POSITION]
    )
    ahead = F.struct(*_POSITION) > F.struct(*[F.col(f"_seen_{c}") for c in _POSITION])
    newer = (
        latest.join(seen, list(TRACKING_KEYS))
        .where(F.col("_seen_event_ms").isNull() | ahead)
        .select(*latest.columns)
    )
    stamp = F.timestamp_millis(F.col("new.event_ms"))
    changed = tuple(c for c in (*TARGET_COLUMNS, *_POSITION) if c in latest.columns)
    return apply_outcomes(tracking, newer, stamp, changed)


def reset_status(tracking: DataFrame, from_status: str = FAILED, to_status: str = PENDING) -> DataFrame:
    """Reopen models of one status (D3)."""
    status = F.col("migration_status")
    return tracking.withColumn(
        "migration_status", F.when(status == from_status, to_status).otherwise(status)
    )


def pending(tracking: DataFrame, host: str) -> DataFrame:
    """Names of the models of one host that wait for migration."""
    return tracking.where(
        (F.col("migration_status") == PENDING)
        & (normalize_host(F.col("source_host")) == normal_host(host))
    ).select("model_name")


def status_counts(tracking: DataFrame) -> DataFrame:
    """Models by status (A5)."""
    return tracking.groupBy("migration_status").agg(F.count(F.lit(1)).alias("models"))


def tracking_report(tracking: DataFrame) -> DataFrame:
    """Tracking rows by status and name (O1)."""
    return tracking.orderBy("migration_status", "model_name", "source_host")
