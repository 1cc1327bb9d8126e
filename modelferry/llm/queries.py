"""The operators as queries on the driver tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelferry.llm import (
    adaptive_scan, best_fit_packing, cover_tree_codes, html_extract, lm_scoring, merkle_manifest, mixing, quality_rules, repeat_removal,
    secret_scan, sharding, simhash_dedup, token_frames,
)
from modelferry.llm.common import prepare, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    rows = quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return rows.select("doc_id", "rules.*")


def op3_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return adaptive_scan.nearest(table(spark, sf_dir, "embeddings"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return best_fit_packing.pack(table(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return sharding.shard(table(spark, sf_dir, "documents"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return lm_scoring.score(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.order(table(spark, sf_dir, "documents"))


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return simhash_dedup.classes(table(spark, sf_dir, "documents"))


def op9_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return repeat_removal.repeats(table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return secret_scan.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    rows = token_frames.round_trip(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op12_cover_tree_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    coded, books = cover_tree_codes.compress(table(spark, sf_dir, "embeddings"))
    return cover_tree_codes.with_label_errors(coded).select(
        "vec_id", "code", "error", "label_error", F.lit(cover_tree_codes.digest(books)).alias("codebooks_sha256"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return merkle_manifest.manifest(table(spark, sf_dir, "documents"))


def all_queries() -> dict[str, Query]:
    return {
        f.__name__: f for f in (
            op1_html_extract, op2_quality_rules, op3_adaptive_scan, op4_best_fit_packing, op5_sharding, op6_lm_scoring, op7_mixing,
            op8_simhash_dedup, op9_repeat_removal, op10_secret_scan, op11_token_frames, op12_cover_tree_codes, op13_merkle_manifest)
    }


def all_oracles() -> dict[str, str]:
    return {"op7_mixing": mixing.ORDER_SQL, "op13_merkle_manifest": merkle_manifest.MANIFEST_SQL}
