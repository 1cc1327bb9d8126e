"""Row numbers without one task per group.

A plain ``row_number`` sorts each group in one task, which fails when a group
holds a large share of the table. Here a group is cut into segments that follow
the order; segments are counted, the counts are summed, and rows are numbered
inside their segment only. The result equals the plain window.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

VERSIONS_PER_SEGMENT = 4096
# Rows that one segment should hold about, and how many halvings find a segment at least and at most.
ROWS_PER_SEGMENT = 1_000_000
SAMPLE_LEVELS, MOST_LEVELS = 8, 16

# Up to this cap Spark cuts the groups inside the map tasks (WindowGroupLimit),
# so that few rows of a group are left when it reaches its task.
SMALL_CAP = 100

_SEGMENT, _BEFORE, _COUNT = "_segment", "_before", "_count"


def version_segments(df: DataFrame, newest_first: bool = False) -> DataFrame:
    """Add the segment of a version number. Versions are unique in a model, which
    bounds the rows of a segment."""
    place = F.floor(F.col("version") / F.lit(VERSIONS_PER_SEGMENT))
    return df.withColumn(_SEGMENT, -place if newest_first else place)


def segment_levels(rows: int) -> int:
    """Halvings that bring a table of so many rows down to segments of about ``ROWS_PER_SEGMENT``."""
    return min(MOST_LEVELS, max(SAMPLE_LEVELS, (rows // ROWS_PER_SEGMENT).bit_length()))


def sampled_segments(df: DataFrame, order: list[Column], levels: int | None = None) -> DataFrame:
    """Add the segment of any order: the place among ``2**levels - 1`` sampled split points.

    Levels follow from the row count, which is taken here unless they are given.

    The split points are the rows with the smallest hashes, so they are the same
    in every attempt, and they arrive as one array of bounded size. The place is
    found by halving, one comparison to a level.
    """
    if levels is None:
        levels = segment_levels(df.count())
    key = F.struct(*order) if len(order) > 1 else order[0]
    sample = df.select(key.alias("_key")).orderBy(F.xxhash64("_key"), "_key").limit(2**levels - 1)
    splits = sample.agg(F.array_sort(F.collect_list("_key"))).scalar()
    placed = df.withColumns({"_splits": splits, "_key": key, _SEGMENT: F.lit(0)})
    for level in reversed(range(levels)):
        step = 2**level
        split = F.get("_splits", F.col(_SEGMENT) + F.lit(step - 1))
        placed = placed.withColumn(
            _SEGMENT, F.col(_SEGMENT) + F.when(split <= F.col("_key"), step).otherwise(0)
        )
    return placed.drop("_splits", "_key")


def segmented_row_number(
    cut: DataFrame, keys: list[str], order: list[Column], name: str,
    start: DataFrame | None = None,
) -> DataFrame:
    """Add ``row_number() over (partition by keys order by order)`` as ``name``.

    ``cut`` has a ``_segment`` that never falls while ``order`` rises. Keys must
    not be NULL. ``start`` (keys, start) is added to the numbers of a group; it
    meets the counts of the segments, never the rows.
    """
    counts = cut.groupBy(*keys, _SEGMENT).agg(F.count(F.lit(1)).alias(_COUNT))
    earlier = (
        Window.partitionBy(*keys).orderBy(_SEGMENT)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = counts.select(
        *keys, _SEGMENT, F.coalesce(F.sum(_COUNT).over(earlier), F.lit(0)).alias(_BEFORE)
    )
    if start is not None:
        offsets = offsets.join(start, keys, "left").withColumn(
            _BEFORE, F.col(_BEFORE) + F.coalesce(F.col("start"), F.lit(0))
        ).drop("start")
    inside = Window.partitionBy(*keys, _SEGMENT).orderBy(*order)
    numbered = cut.join(offsets, [*keys, _SEGMENT])
    return numbered.withColumn(
        name, F.col(_BEFORE) + F.row_number().over(inside)
    ).drop(_SEGMENT, _BEFORE)


def segmented_running_sum(cut: DataFrame, order: list[Column], amount: Column, name: str) -> DataFrame:
    """Add the sum of ``amount`` over all rows before this one as ``name``; ``order`` must be total.

    Sums of segments are added up, so no task sees more than the rows of a segment.
    """
    sums = cut.groupBy(_SEGMENT).agg(F.sum(amount).alias(_COUNT))
    earlier = Window.orderBy(_SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(_SEGMENT, F.coalesce(F.sum(_COUNT).over(earlier), F.lit(0)).alias(_BEFORE))
    inside = Window.partitionBy(_SEGMENT).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return cut.join(offsets, _SEGMENT).withColumn(
        name, F.col(_BEFORE) + F.coalesce(F.sum(amount).over(inside), F.lit(0))
    ).drop(_SEGMENT, _BEFORE)


def first_rows(
    df: DataFrame, keys: list[str], order: list[Column], n: int,
    cut: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """The first ``n`` rows of every group (W1); ``cut`` adds the segments."""
    rank = "_rank"
    if n <= SMALL_CAP:
        window = Window.partitionBy(*keys).orderBy(*order)
        ranked = df.withColumn(rank, F.row_number().over(window))
    else:
        ranked = segmented_row_number(cut(df), keys, order, rank)
    return ranked.where(F.col(rank) <= n).select(*df.columns)


def batches(df: DataFrame, name: str, size: int) -> DataFrame:
    """Number rows by name in batches of ``size``, from 0, as ``batch_id``."""
    order = [F.col(name)]
    numbered = segmented_row_number(sampled_segments(df, order), [], order, "_rank")
    return numbered.withColumn(
        "batch_id", F.floor((F.col("_rank") - 1) / F.lit(size)).cast("bigint")
    ).drop("_rank")


def next_versions(versions: DataFrame, model: str, taken: DataFrame) -> DataFrame:
    """Add ``target_version``: the largest number taken plus the rank.

    ``taken`` has one row by model: (model, last_version).
    """
    numbered = segmented_row_number(
        version_segments(versions), [model], [F.col("version")], "target_version",
        taken.withColumnRenamed("last_version", "start"),
    )
    return numbered.withColumn("target_version", F.col("target_version").cast("int"))
