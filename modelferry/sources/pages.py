"""Saved answers of a paged listing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from modelferry.operators.joins import outer_lookup
from modelferry.session import written


def page_schema(item: StructType) -> StructType:
    """One saved page: who asked, its token, the next token, its items."""
    return StructType([
        StructField("request_key", StringType()), StructField("page_token", StringType()),
        StructField("next_page_token", StringType()), StructField("items", ArrayType(item)),
    ])


#: What can be wrong with saved pages.
MISSING, LOOP, ORPHAN = "missing", "loop", "orphan"


def followed(pages: DataFrame) -> DataFrame:
    """Adds ``reached`` and ``endless`` to distinct pages (request_key, page_token, next_page_token), '' being no token.

    Reached is what a reader comes to from the first page of its request; endless is a page from which the tokens run in a circle.
    Every page points to the page after the next, then to the fourth, and so on, so
    a listing of n pages takes log2(n) rounds of one join each.
    """
    most = pages.groupBy("request_key").count().agg(F.max("count")).first()[0] or 0
    # Tokens without a saved page lead nowhere.
    saved = pages.select("request_key", F.col("page_token").alias("jump"))
    leads = pages.select("request_key", "page_token", F.nullif("next_page_token", F.lit("")).alias("jump"))
    known = leads.join(saved, ["request_key", "jump"]).select("request_key", "page_token", "jump")
    state = written(pages.select("request_key", "page_token").join(known, ["request_key", "page_token"], "left").withColumn(
        "reached", F.col("page_token") == ""), "tokens")
    for _ in range(most.bit_length()):
        marked = state.where("reached and jump is not null").select(
            "request_key", F.col("jump").alias("page_token"), F.lit(True).alias("_mark")).distinct()
        further = state.select("request_key", F.col("page_token").alias("jump"), F.col("jump").alias("_further"))
        stepped = outer_lookup(state, further, ["jump", "request_key"], ["request_key", "page_token"])
        state = written(stepped.join(marked, ["request_key", "page_token"], "left").select(
            "request_key", "page_token", F.col("_further").alias("jump"),
            (F.col("reached") | F.col("_mark").isNotNull()).alias("reached")), "tokens")
    return pages.join(state, ["request_key", "page_token"]).withColumn("endless", F.col("jump").isNotNull()).drop("jump")


def read_paged_extract(spark: SparkSession, path: str, item: StructType) -> tuple[DataFrame, DataFrame]:
    """(items with request_key, problems with request_key, page_token and kind).

    Items are those of the pages that a reader comes to by following tokens from the first page of a request, each page
    once. A page saved twice counts once; of two that differ, the one with the smaller hash. Problems are a token with no page or
    (NULL token) a listing without its first page: ``missing``; a token by which a listing returns to a page it has
    had, and unreached pages whose tokens run in a circle: ``loop``; other unreached pages: ``orphan``.
    """
    pages = spark.read.schema(page_schema(item)).json(path)
    token = F.coalesce(F.col("page_token"), F.lit(""))
    page = F.struct("next_page_token", "items")
    once = written(pages.groupBy("request_key", token.alias("page_token")).agg(
        F.min_by(page, F.struct(F.xxhash64(page), F.to_json(page))).alias("page")
    ).select("request_key", "page_token", F.coalesce("page.next_page_token", F.lit("")).alias("next_page_token"), "page.items"), "pages")
    seen = written(followed(once.drop("items")), "followed")
    items = once.join(seen.where("reached").select("request_key", "page_token"), ["request_key", "page_token"], "left_semi").select(
        "request_key", F.inline("items"))
    ahead = seen.where("reached and next_page_token <> ''").select("request_key", F.col("next_page_token").alias("page_token"))
    first = seen.select("request_key", F.lit("").alias("page_token"))
    saved = seen.select("request_key", "page_token")
    missing = ahead.union(first).distinct().join(saved, ["request_key", "page_token"], "left_anti")
    # The first page has no token, so a page met again is one that two reached pages lead to.
    again = ahead.groupBy("request_key", "page_token").count().where("count > 1").select("request_key", "page_token")
    lost = seen.where(~F.col("reached"))
    problems = missing.withColumn("kind", F.lit(MISSING)).unionByName(again.withColumn("kind", F.lit(LOOP))).unionByName(
        lost.select("request_key", "page_token", F.when(F.col("endless"), LOOP).otherwise(ORPHAN).alias("kind")))
    return items, problems.withColumn("page_token", F.nullif("page_token", F.lit("")))
