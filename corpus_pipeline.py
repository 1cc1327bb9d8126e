"""A corpus pipeline: each stage is one operator, written as Parquet and read again by the next.

quality rules drop what they reject; SimHash keeps one document of each group; secret scans
redact; mixing repeats documents of small sources; packing gives the pieces in their sequences.

Null texts and texts of few words fail the base rules and go; a long text is one document like any other. Of equal or
nearly equal documents the one with the smallest id stays. An empty table passes through as an empty one. Columns besides those of
``documents`` are carried up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from modelferry.llm import best_fit_packing, mixing, quality_rules, secret_scan, simhash_dedup
from modelferry.llm.common import prepare, table
from modelferry.session import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    prepare(spark)
    return quality_rules.keep(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    prepare(spark)
    return simhash_dedup.one_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets redacted."""
    prepare(spark)
    return secret_scan.redact(docs, table(spark, sf_dir, "labels"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents at least once, those of small sources up to twice."""
    prepare(spark)
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces in sequences of at most 1024 tokens."""
    prepare(spark)
    return best_fit_packing.pack(docs)


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_duplicates),
    ("secret scans", secrets),
    ("mixing", mix),
    ("best-fit packing", pack),
]

#: SQL has neither the hashed n-grams nor the fingerprints; the tests use plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over all documents."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
