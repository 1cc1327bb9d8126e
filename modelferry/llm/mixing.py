"""Mixing sources to target weights by temperature.

A source's share of the tokens is raised to an exponent and normalised: 1 keeps the
shares, 0 makes all sources equal. Bisection finds the exponent: the smallest for
which no source is passed over more than ``repeats`` times, or the one at which the weights
have the target entropy. Weights become token budgets, and a budget becomes passes over the
source: whole passes, then a part of one more. Each pass is a permutation of its own, by the order of
seeded digests, and lies in blocks of some ``BLOCK_ROWS`` rows, so no task holds a source.

Budget: by default as many tokens as give every document one whole pass at least, so mixing
drops nothing and repeats small sources. With a smaller budget, a source with less than one pass
keeps the first documents of its permutation, up to the one that reaches its budget.

Tokens are words ``[^\\x20\\x09-\\x0D]+`` and one end, so a null or empty text counts 1. A null
source is a source of its own. Repeated rows count each, and take places next to each other. An empty
table mixes to an empty table. Other columns are left alone.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modelferry.llm.common import set_aside
from modelferry.session import written

SEED = 7
BLOCK_ROWS = 4096
#: Halvings of the bisection, and how many of them one job evaluates.
HALVINGS, AT_ONCE = 40, 5
STEEPEST = 8.0


@dataclass(frozen=True)
class Target:
    """Either a limit on passes over a source, or an entropy of the weights in nats; a budget in tokens."""

    repeats: float | None = 2.0
    entropy: float | None = None
    budget: int | None = None

    def __post_init__(self):
        if (self.repeats is None) == (self.entropy is None):
            raise ValueError("give a repetition limit or an entropy")
        if self.repeats is not None and self.repeats < 1:
            raise ValueError("a repetition limit is at least 1")


def tokens(text: Column) -> Column:
    """Words and one end."""
    pieces = F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+")
    blank = (F.get(pieces, 0) == "").cast("int") + ((F.size(pieces) > 1) & (F.element_at(pieces, -1) == "")).cast("int")
    return (F.size(pieces) - blank + 1).cast("long")


def source_weights(sized: DataFrame, target: Target) -> DataFrame:
    """One row a source: tokens, n_rows, exponent, weight, budget. From rows (source, tokens).

    Sources are summed by Spark; only sums over all sources reach the driver.
    """
    sums = written(sized.groupBy("source").agg(
        F.sum("tokens").alias("tokens"), F.count("*").alias("n_rows")), "sources")
    total = sums.agg(F.sum("tokens")).first()[0] or 1
    share = F.col("tokens") / F.lit(float(total))

    def sums_at(exponents: list[float]) -> list[tuple[float, ...]]:
        """(sum of p, sum of p log p, largest and smallest p / share) for p = share ** exponent."""
        columns = []
        for x in exponents:
            p = F.pow(share, F.lit(x))
            columns += [F.sum(p), F.sum(p * F.log(p)), F.max(p / share), F.min(p / share)]
        row = [v if v is not None else 1.0 for v in sums.agg(*columns).first()]
        return [tuple(row[i:i + 4]) for i in range(0, len(row), 4)]

    def fits(z: float, plogp: float, most: float, least: float) -> bool:
        if target.entropy is not None:
            return math.log(z) - plogp / z <= target.entropy
        passes = most / least if target.budget is None else most / z * target.budget / total
        return passes <= target.repeats

    low, high = 0.0, STEEPEST if target.entropy is not None else 1.0
    if fits(*sums_at([0.0])[0]):
        high = 0.0
    else:
        for _ in range(HALVINGS // AT_ONCE):
            # All middles that the next halvings can ask for, in one job.
            n = 1 << AT_ONCE
            grid = [low + (high - low) * i / n for i in range(1, n)]
            ok = [fits(*s) for s in sums_at(grid)]
            a, b = 0, n
            while b - a > 1:
                middle = (a + b) // 2
                a, b = (a, middle) if ok[middle - 1] else (middle, b)
            points = [low, *grid, high]
            low, high = points[a], points[b]
    z, _, _, least = sums_at([high])[0]
    weight = F.pow(share, F.lit(high)) / F.lit(z)
    if target.budget is None:
        budget = F.greatest(F.round(weight * F.lit(total * z / least)).cast("long"), F.col("tokens"))
    else:
        budget = F.round(weight * F.lit(float(target.budget))).cast("long")
    return sums.select(
        "source", "tokens", "n_rows", F.lit(high).alias("exponent"), weight.alias("weight"), budget.alias("budget"))


def _draw(turn: Column, doc_id: Column, text_md5: Column) -> Column:
    """The digest by which a pass orders its documents."""
    return F.md5(F.concat_ws(":", F.lit(SEED), turn, F.coalesce(doc_id.cast("string"), F.lit("")), text_md5))


def _block(draw: Column, n_blocks: Column) -> Column:
    """The block of a digest among n equal ranges."""
    part = F.conv(F.substring(draw, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    return F.floor(part * n_blocks).cast("long")


def copies(docs: DataFrame, target: Target = Target()) -> DataFrame:
    """All columns, and for every copy of a row: ``__turn`` (the pass), ``__block``, ``__draw`` (its order in the block).

    Documents meet their source's cut by a join on the source alone; texts are not shuffled by document.
    """
    marked = docs.withColumn("__md5", F.md5(F.coalesce("text", F.lit("")))).withColumn("__tokens", tokens(F.col("text")))
    narrow = written(marked.select(
        F.col("doc_id").alias("id"), "source", F.col("__tokens").alias("tokens"), F.col("__md5").alias("md5")), "sized")
    weights = source_weights(narrow.select("source", "tokens"), target).select(
        "source", F.expr("budget div tokens").alias("whole"), F.expr("budget % tokens").alias("rest"),
        F.ceil(F.col("n_rows") / BLOCK_ROWS).alias("n_blocks")).withColumnRenamed("source", "of")
    weights = written(weights, "weights")
    # The part of a pass: the block in which the budget ends, then the place in that block.
    last = narrow.join(weights, F.col("source").eqNullSafe(F.col("of"))).where("rest > 0").withColumn(
        "draw", _draw(F.col("whole"), F.col("id"), F.col("md5"))).withColumn("block", _block(F.col("draw"), F.col("n_blocks")))
    sums = last.groupBy("of", "block", "rest").agg(F.sum("tokens").alias("t")).withColumn(
        "before", F.sum("t").over(Window.partitionBy("of").orderBy("block")) - F.col("t"))
    ends = sums.where("before < rest and before + t >= rest").select(
        F.col("of").alias("o"), F.col("block").alias("b"), "before")
    inside = last.join(ends, F.col("of").eqNullSafe(F.col("o")) & (F.col("block") == F.col("b"))).withColumn(
        "sum", F.col("before") - F.col("tokens") + F.sum("tokens").over(
            Window.partitionBy("of", "block").orderBy("draw").rowsBetween(Window.unboundedPreceding, 0)))
    cuts = inside.where("sum < rest").groupBy("of").agg(F.max("draw").alias("cut")).withColumnRenamed("of", "cut_of")
    plan = written(weights.join(cuts, F.col("of").eqNullSafe(F.col("cut_of")), "left").select(
        F.col("of").alias("__of"), F.col("whole").alias("__whole"), F.col("n_blocks").alias("__n"),
        F.col("cut").alias("__cut")), "plan")
    joined = marked.join(plan, F.col("source").eqNullSafe(F.col("__of")))
    extra = _draw(F.col("__whole"), F.col("doc_id"), F.col("__md5")) <= F.col("__cut")
    turns = F.when(
        F.coalesce(extra, F.lit(False)), F.sequence(F.lit(0).cast("long"), F.col("__whole"))
    ).when(F.col("__whole") > 0, F.sequence(F.lit(0).cast("long"), F.col("__whole") - 1))
    return joined.withColumn("__turn", F.explode(turns)).withColumn(
        "__draw", _draw(F.col("__turn"), F.col("doc_id"), F.col("__md5"))).withColumn(
        "__block", _block(F.col("__draw"), F.col("__n"))).drop("__of", "__whole", "__n", "__cut", "__md5")


def order(docs: DataFrame, target: Target = Target()) -> DataFrame:
    """Every copy: doc_id, source, pass_no, block, place (gapless from 0 in its block), tokens."""
    rows = copies(docs.select("doc_id", "source", "text"), target).drop("text")
    place = F.row_number().over(Window.partitionBy("source", "__turn", "__block").orderBy("__draw")) - 1
    return rows.select(
        "doc_id", "source", F.col("__turn").alias("pass_no"), F.col("__block").alias("block"),
        place.cast("long").alias("place"), F.col("__tokens").alias("tokens"))


def mixed(docs: DataFrame, target: Target = Target()) -> DataFrame:
    """The copies with the columns of the documents."""
    own = set_aside(docs, "__md5 __tokens __turn __draw __block __of __whole __n __cut")
    return copies(own, target).select(*[F.col(f"`{c}`") for c in own.columns]).toDF(*docs.columns)


#: The order of all copies in DuckDB, for a limit of 2 passes. With two numbers only, the largest and the
#: smallest share, the exponent that bisection finds has a closed form.
ORDER_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS h,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) + 1 AS tokens
  FROM documents
), s AS (
  SELECT source, sum(tokens)::BIGINT AS t, count(*) AS n FROM d GROUP BY source
), e AS (
  SELECT sum(t)::DOUBLE AS total, max(t)::DOUBLE AS most, min(t)::DOUBLE AS least FROM s
), x AS (
  SELECT *, CASE WHEN most / least <= 2 THEN 0 ELSE 1 - ln(2) / ln(most / least) END AS a FROM e
), w AS (
  SELECT source, t, n, greatest(round(pow(t / total, a) * total / pow(most / total, a - 1))::BIGINT, t) AS budget
  FROM s, x
), p AS (
  SELECT source, budget // t AS whole, budget % t AS rest, ceil(n / 4096.0)::BIGINT AS n_blocks FROM w
), part AS (
  SELECT d.*, whole, rest, n_blocks,
    md5('7:' || whole || ':' || coalesce(doc_id::VARCHAR, '') || ':' || h) AS draw
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
), cut AS (
  SELECT *, sum(tokens) OVER (PARTITION BY source ORDER BY draw ROWS UNBOUNDED PRECEDING) - tokens < rest AS extra
  FROM part
), turns AS (
  SELECT doc_id, source, tokens, h, n_blocks, unnest(range(0, whole + CASE WHEN extra THEN 1 ELSE 0 END)) AS pass_no
  FROM cut
), drawn AS (
  SELECT *, md5('7:' || pass_no || ':' || coalesce(doc_id::VARCHAR, '') || ':' || h) AS draw FROM turns
), blocks AS (
  SELECT *, floor(('0x' || substr(draw, 1, 8))::BIGINT / 4294967296.0 * n_blocks)::BIGINT AS block FROM drawn
)
SELECT doc_id, source, pass_no, block,
  row_number() OVER (PARTITION BY source, pass_no, block ORDER BY draw) - 1 AS place, tokens
FROM blocks
"""
