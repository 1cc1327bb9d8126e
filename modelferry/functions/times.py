"""Epoch milliseconds as text (E9). The session zone must be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats of the report columns.
MINUTE_FORMAT = "yyyy-MM-dd HH:mm"
DAY_FORMAT = "yyyy-MM-dd"


def _formatted(ms: Column, pattern: str) -> Column:
    stamp = F.timestamp_millis(ms)
    return F.when(ms != 0, F.date_format(stamp, pattern)).otherwise("")


def minute_text(ms: Column) -> Column:
    """NULL and 0 give an empty text."""
    return _formatted(ms, MINUTE_FORMAT)


def day_text(ms: Column) -> Column:
    """NULL and 0 give an empty text."""
    return _formatted(ms, DAY_FORMAT)
