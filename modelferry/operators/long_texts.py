"""Long report cells, joined in parts.

The texts of one cell may be millions. They are joined by segments of their order first, all
over the cluster, and a cell is made from the joined parts, so no task holds its texts one by one.
The parts are a table of their own: whoever can read many rows for a cell needs no cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelferry.operators.ranking import VERSIONS_PER_SEGMENT

PART = "part"


def part_of(version: Column) -> Column:
    """The segment of a version number; versions are unique in a model, which bounds a part."""
    return F.floor(version / F.lit(VERSIONS_PER_SEGMENT))


def in_order(place: Column, text: Column, separator: str) -> Column:
    """Aggregate: the texts that are not null in order of ``place``, joined; null if there is none."""
    pairs = F.array_sort(F.collect_list(F.when(text.isNotNull(), F.struct(place.alias("place"), text.alias("text")))))
    return F.when(F.count(text) > 0, F.array_join(F.transform(pairs, lambda p: p["text"]), separator))


def text_parts(rows: DataFrame, keys: list[str], order: str, text: Column, separator: str) -> DataFrame:
    """keys, part, number of rows, their joined texts; ``order`` is unique by key.

    Rows come from everywhere, so that hardly two of a part lie together: they move as they are, not as lists of one.
    """
    placed = rows.select(*keys, part_of(F.col(order)).alias(PART), F.col(order), text.alias("text")).repartition(*keys, PART)
    return placed.groupBy(*keys, PART).agg(
        F.count(F.lit(1)).alias("rows"), in_order(F.col(order), F.col("text"), separator).alias("text"))


def cells(parts: DataFrame, keys: list[str], separator: str) -> DataFrame:
    """keys, number of rows, the whole text; empty where no row has a text."""
    return parts.groupBy(*keys).agg(
        F.sum("rows").alias("rows"), F.coalesce(in_order(F.col(PART), F.col("text"), separator), F.lit("")).alias("text"))
