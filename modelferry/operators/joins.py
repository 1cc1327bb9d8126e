"""Join helpers for keys that are absent in many rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Starts a key that no id can have.
NO_KEY = "\0"


def outer_lookup(left: DataFrame, right: DataFrame, keys: list[str], row: list[str]) -> DataFrame:
    """Left outer join whose first key is absent in many rows of ``left``.

    Up to a third of all rows may have no key, and a plain join would send every
    one of them to the same task. Here such a row gets a key of its own, made
    from the columns ``row`` that identify it, which matches nothing. Text keys
    keep the partitioning ``right`` already has.
    """
    first, rest = keys[0], keys[1:]
    own = F.concat(F.lit(NO_KEY), F.xxhash64(*row).cast("string"))
    placed = left.withColumn("_key", F.coalesce(F.col(first).cast("string"), own))
    found = right.withColumn("_key", F.col(first).cast("string")).drop(first)
    return placed.join(found, ["_key", *rest], "left").drop("_key")


def parted_lookup(left: DataFrame, right: DataFrame, keys: list[str], row: list[str]) -> DataFrame:
    """The same join where ``left`` is read from a table, so that reading it twice costs little.

    Rows without their first key are read apart and do not move, the others move without a made key, and ``right`` keeps
    the partitioning it has by its keys.
    """
    first = keys[0]
    if left.schema[first].dataType != right.schema[first].dataType:  # only as texts are they compared without an error
        return outer_lookup(left, right, keys, row)
    found = left.where(F.col(first).isNotNull()).join(right, keys, "left")
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema if f.name not in keys]
    return found.unionByName(left.where(F.col(first).isNull()).select("*", *nothing))


def sole_rows(df: DataFrame, keys: list[str], what: str) -> DataFrame:
    """Raise when a key is NULL or occurs twice; otherwise the same rows."""
    values = [c for c in df.columns if c not in keys]
    counted = df.groupBy(*keys).agg(
        F.max(F.struct(*values)).alias("_row"), F.count(F.lit(1)).alias("_n")
    )
    broken = F.col("_n") > 1
    for key in keys:
        broken = broken | F.col(key).isNull()
    message = F.concat_ws(
        " ", F.lit(f"{what}: key is NULL or not unique:"), *[F.col(k).cast("string") for k in keys]
    )
    checked = counted.where(F.when(broken, F.raise_error(message).cast("boolean")).otherwise(True))
    return checked.select(*keys, "_row.*").select(*df.columns)
