"""Outcome events applied to the tracking table as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from modelferry.functions.names import normalize_host
from modelferry.operators.upsert import apply_latest, newest
from modelferry.schemas import POSITION, TARGET_COLUMNS, TRACKING_KEYS
from modelferry.sources.tracking_store import TrackingStore

_POSITION = POSITION.fieldNames()


def latest_outcomes(events: DataFrame) -> DataFrame:
    """The last event of each model, by time and then id."""
    values = [c for c in (*TARGET_COLUMNS, *_POSITION) if c in events.columns]
    normal = events.withColumn("source_host", normalize_host(F.col("source_host")))
    return newest(normal.select(*TRACKING_KEYS, *values))


def apply_events(tracking: DataFrame, events: DataFrame) -> DataFrame:
    """Tracking with positions after these events.

    Events at or before a row's position change nothing, so a batch that
    comes twice, or out of order, has no further effect.
    """
    return apply_latest(tracking, latest_outcomes(events))


def track_stream(
    events: DataFrame, store: TrackingStore, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Run the updates; without ``interval`` take what is there and stop.

    A batch is logged as it is; the table is neither read nor rewritten for it. A batch that comes twice is logged twice.
    ``last_updated_at`` becomes the event's time, so that a repeated batch
    writes the same row again.
    """
    store.create()

    def apply(batch: DataFrame, batch_id: int) -> None:
        # The newest outcome of each model is all that counts; it is worked out once.
        latest = latest_outcomes(batch).persist()
        try:
            if not latest.isEmpty():
                store.append(latest)
        finally:
            latest.unpersist()

    writer = events.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()
