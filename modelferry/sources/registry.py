"""Registry snapshots on storage.

A plain snapshot is a folder with one dataset by table. A registry written by
this package keeps each transfer under ``<table>/commit=<id>`` and names the
complete ones in ``_commits``. Both may lie side by side: a transfer into a plain
snapshot adds to it, and all its rows are read on. A transfer that broke half way is not named there,
so its records are never read and the retry cannot double them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from modelferry.functions.names import normal_host
from modelferry.schemas import TABLES, Snapshot
from modelferry.session import shuffles_dropped
from modelferry.sources import storage

COMMITS = "_commits"

# Tables that refer to others come before the records they belong to.
WRITE_ORDER = (
    "run_params", "run_metrics", "metric_points", "run_tags", "run_artifacts",
    "experiment_tags", "experiments", "runs", "version_tags", "versions", "model_tags", "models",
)

# An empty text in these columns means "none", as in a registry server's answers.
EMPTY_IS_NULL = {"versions": ("run_id",)}


# A registry that lacks one of these is not one, or its address is wrong.
REQUIRED = ("models", "versions", "experiments", "runs", "run_params", "run_metrics", "run_artifacts")


def _read_table(
    spark: SparkSession, path: str, table: str, fmt: str, commits: set[str], plain: bool = True
) -> DataFrame | None:
    """Plain files and complete commits of a table; None where it has no folder."""
    schema, folder = TABLES[table], f"{path}/{table}"
    there = storage.names(spark, folder)
    if there is None:
        return None
    done = [n for n in there if n.startswith("commit=") and n.removeprefix("commit=") in commits]
    loose = [n for n in there if plain and not n.startswith(("commit=", "_", "."))]
    reader = spark.read.schema(schema).option("basePath", folder).format(fmt)
    parts = [
        reader.load([f"{folder}/{n}" for n in some]).select(*schema.fieldNames())
        for some in (loose, done) if some
    ]
    df = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)
    for column in EMPTY_IS_NULL.get(table, ()):
        df = df.withColumn(column, F.nullif(F.col(column), F.lit("")))
    return df


def committed(spark: SparkSession, path: str) -> list[str]:
    """Ids of complete transfers."""
    return storage.folder_names(spark, f"{path}/{COMMITS}")


def read_registry(
    spark: SparkSession, path: str, host: str, fmt: str = "parquet", may_be_new: bool = False
) -> Snapshot:
    """Lazy snapshot of the registry of one workspace.

    A required table that is missing is an error. Only a target that does not
    exist yet may lack them: with ``may_be_new`` a folder without any table reads as empty.
    """
    commits = set(committed(spark, path))
    made = {t: _read_table(spark, path, t, fmt, commits) for t in TABLES}
    lost = [t for t in REQUIRED if made[t] is None]
    if lost and not (may_be_new and all(df is None for df in made.values())):
        raise FileNotFoundError(f"{path} has no table {', '.join(lost)}")
    made = {t: spark.createDataFrame([], TABLES[t]) if df is None else df for t, df in made.items()}
    return Snapshot(host=normal_host(host), **made)


def conformed(df: DataFrame, table: str, host: str | None = None, *beside: str) -> DataFrame:
    """The table's columns in its types; absent ones are NULL. Columns named in ``beside`` follow."""
    columns = []
    for field in TABLES[table]:
        if field.name == "source_host" and host is not None:
            value = F.lit(normal_host(host))
        elif field.name in df.columns:
            value = F.col(field.name)
        else:
            value = F.lit(None)
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(*columns, *beside)


def digest(columns: list[str]) -> list[Column]:
    """Aggregates that tell two multisets of rows apart, in whatever order the rows come: their number and the sum of their hashes."""
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c in columns]).cast("decimal(20,0)")
    return [F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(hashed), F.lit(0).cast("decimal(30,0)")).alias("digest")]


def _checked(table: str, rows: DataFrame, write: Callable[[DataFrame], None], back: Callable[[], DataFrame | None]) -> None:
    """Write rows and compare what is in the files with what went in; the rows are worked out once."""
    seen = Observation(table)
    columns = TABLES[table].fieldNames()
    with shuffles_dropped(rows.sparkSession):
        write(rows.observe(seen, *digest(columns)))
        found = back()
        there = (0, 0) if found is None else tuple(found.agg(*digest(columns)).first())
    sent = (seen.get["n_rows"], seen.get["digest"])
    if there != sent:
        raise OSError(f"{table}: {there[0]} rows in the files, {sent[0]} were written, or their content differs")


def write_registry(
    records: dict[str, DataFrame], path: str, host: str, commit: str, fmt: str = "parquet"
) -> None:
    """Write the records of one transfer, check the files and commit it.

    Rewriting an unfinished commit replaces it; a finished one is refused. Files that do not hold what was written make no commit.
    """
    spark = next(iter(records.values())).sparkSession
    if commit in committed(spark, path):
        raise ValueError(f"commit {commit} is already complete")
    unknown = set(records) - set(TABLES)
    if unknown:
        raise ValueError(f"unknown tables: {sorted(unknown)}")
    for table in WRITE_ORDER:
        if table in records:
            folder = f"{path}/{table}/commit={commit}"
            _checked(
                table, conformed(records[table], table, host),
                lambda df: df.write.mode("overwrite").format(fmt).save(folder),
                lambda: spark.read.schema(TABLES[table]).format(fmt).load(folder))
    storage.mark(spark, f"{path}/{COMMITS}/{commit}")


def write_parts(
    records: dict[str, DataFrame], path: str, host: str, commit: Column, commits: list[str], fmt: str = "parquet"
) -> None:
    """Write records of the transfers ``commits`` at once, each row into the folder of its ``commit``, and check the files; commits nothing.

    Folders of other commits stay. :func:`write_registry` adds the tables that are still to come and commits.
    """
    for table in WRITE_ORDER:
        if table in records:
            folder, spark = f"{path}/{table}", records[table].sparkSession
            rows = records[table].withColumn("_commit", commit)
            named = conformed(rows, table, host, "_commit").withColumnRenamed("_commit", "commit")
            # Rebalancing keeps a commit's part in few files, and splits a large one.
            _checked(
                table, named.hint("rebalance", "commit"),
                lambda df: df.write.mode("overwrite").option(
                    "partitionOverwriteMode", "dynamic").partitionBy("commit").format(fmt).save(folder),
                lambda: _read_table(spark, path, table, fmt, set(commits), plain=False))
