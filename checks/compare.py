"""Spark results against DuckDB results, as sorted rows of equal column names."""

from __future__ import annotations

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _sorted_rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, else what differs first."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = _sorted_rows(names, result.fetchall())
    got = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(names)}"
    if len(got) != len(expected):
        return f"{len(got)} rows instead of {len(expected)}"
    for a, b in zip(got, expected):
        if a != b:
            return f"{sorted(names)}: {a} instead of {b}"
    return None
