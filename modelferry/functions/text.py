"""Trimming, cutting and joining text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space stripped from names and lines.
WHITE_SPACE = " \t\r\n"


def strip_space(c: Column) -> Column:
    """Strip blanks, tabs and line ends from both sides."""
    return F.trim(c, F.lit(WHITE_SPACE))


def cut(c: Column, length: int) -> Column:
    """First ``length`` characters."""
    return F.left(c, F.lit(length))


def joined_sorted(values: Column, separator: str) -> Column:
    """Sort an array of distinct texts and join it (A2)."""
    return F.array_join(F.array_sort(values), separator)


def requirement_lines(text: Column) -> Column:
    """Non-blank lines that do not start with '#', stripped, joined by '; ' (X2).

    A '#' after leading blanks does not make a comment.
    """
    lines = F.split(text, "\n")
    kept = F.filter(lines, lambda s: (strip_space(s) != "") & ~s.startswith("#"))
    return F.array_join(F.transform(kept, strip_space), "; ")
