"""Delivery of inventory and report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

FORMATS = ("parquet", "orc", "json", "csv")


def write_report(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace the report at ``path``."""
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {', '.join(FORMATS)}")
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.save(path)
