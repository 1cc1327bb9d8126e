"""A Merkle tree over a dataset, and each row's proof, by butterfly exchange.

Leaves are digests of rows. Each source has a tree over its leaves by ``doc_id``; the trees' roots, by source, have one more tree.
``FANOUT`` consecutive nodes become the digest of their digests, and a last run of fewer does as well.

Leaves lie in aligned blocks of ``FANOUT ** BLOCK_LEVELS`` that know all nodes below their own root. Then blocks
meet in rounds. In round t a block holds the node over its aligned group of ``FANOUT ** t`` blocks, as do
all others of that group. It swaps it with its counterparts in the neighbour groups (same place in their
group), hashes the parent itself, and keeps what it got as the next step of its proof. After the last
round every block holds the root and the whole upper proof, and nothing travels down again. Where a group at
the right end is not full, its blocks serve several counterparts each. A round sends each block at most ``FANOUT``
nodes, and the rows of a round are as many as there are blocks. Sources meet in the same way.

Rows are numbered by segments (``operators.ranking``), so a source may hold any share of the rows; equal rows are told apart by a
row number given when the leaves are written, and make equal leaves next to each other.

Defined cases: a null column is ``-``; null sources and null ids come first; rows with one id are ordered by leaf, each with
its own proof; a row with a null id is not tampered with; columns that are not hashed are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelferry.operators.ranking import batches, sampled_segments, segmented_row_number
from modelferry.session import written

FANOUT = 3
BLOCK_LEVELS = 7
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """A value as hashed: its UTF-8 byte count, a colon and itself; ``-`` for null."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def tampered_rows() -> Column:
    """Rows whose text is tampered with: the checksum of the decimal id is even."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, source_key, leaf, tampered, row); tampered is the leaf without line ends where the row is tampered with.

    ``source_key`` orders sources, null first, and is never null.
    """
    *rest, text = [F.col(c) for c in COLUMNS]
    return docs.select(
        "doc_id", F.coalesce(F.concat(F.lit("+"), F.col("source").cast("string")), F.lit("")).alias("source_key"),
        leaf(*rest, text).alias("leaf"),
        F.when(tampered_rows(), leaf(*rest, F.replace(text, F.lit("\n"), F.lit("")))).alias("tampered"),
        F.monotonically_increasing_id().alias("row"))


def blocks(found: DataFrame, fanout: int, block_levels: int) -> DataFrame:
    """Rows (source_key, block, leaves): at most ``fanout ** block_levels`` leaves in order, aligned in their source."""
    order = [F.col("doc_id").isNotNull(), F.coalesce("doc_id", F.lit(0)), F.col("leaf"), F.col("row")]
    cut = sampled_segments(found, [F.col("source_key"), *order])
    numbered = segmented_row_number(cut, ["source_key"], order, "rank")
    block = F.floor((F.col("rank") - 1) / F.lit(fanout**block_levels)).cast("long")
    held = F.sort_array(F.collect_list(F.struct("rank", "doc_id", "leaf", "tampered")))
    return numbered.groupBy("source_key", block.alias("block")).agg(held.alias("leaves"))


def parents(nodes: list[str], fanout: int) -> list[str]:
    return [hashlib.sha256("".join(nodes[i:i + fanout]).encode()).hexdigest() for i in range(0, len(nodes), fanout)]


def levels(nodes: list[str], block: int, fanout: int, block_levels: int) -> list[list[str]]:
    """All levels of a block up to its root. Only the sole block of a source may have fewer than ``block_levels``."""
    out = [nodes]
    whole = block > 0 or len(nodes) == fanout**block_levels
    while len(out[-1]) > 1 or (whole and len(out) <= block_levels):
        out.append(parents(out[-1], fanout))
    return out


def steps(tree: list[list[str]], i: int, fanout: int) -> list[tuple[str, str]]:
    """Siblings of leaf ``i`` before and after it, level by level below the root of its block."""
    out = []
    for nodes in tree[:-1]:
        first = i - i % fanout
        out.append(("".join(nodes[first:i]), "".join(nodes[i + 1:first + fanout])))
        i //= fanout
    return out


def block_roots(of: DataFrame, fanout: int, block_levels: int) -> DataFrame:
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            numbers = batch.column("block").to_pylist()
            roots = [levels(nodes, b, fanout, block_levels)[-1][0] for nodes, b in zip(batch.column("nodes").to_pylist(), numbers)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("source_key"), batch.column("block"), pa.array(roots, pa.string())], names=["source_key", "block", "node"])

    return of.select("source_key", "block", F.col("leaves.leaf").alias("nodes")).mapInArrow(
        run, "source_key string, block long, node string")


def butterfly(state: DataFrame, key: str, fanout: int = FANOUT) -> DataFrame:
    """From rows (key, place, n, node), places 0 to n - 1 of each key: (key, place, n, node, before, after).

    ``node`` becomes the root of its key; before and after are the siblings of each level on either side.
    """
    none = F.array().cast("array<string>")
    state = written(state.select(key, "place", "n", "node", none.alias("before"), none.alias("after")), "round")
    most = state.agg(F.max("n")).first()[0] or 0
    span = 1
    while span < most:
        state = written(_round(state, key, span, fanout), "round")
        span *= fanout
    return state


def _round(state: DataFrame, key: str, span: int, fanout: int) -> DataFrame:
    """Groups of ``span`` places swap their nodes inside aligned groups of ``span * fanout``."""
    wide = span * fanout
    place, n = F.col("place"), F.col("n")
    inside = place % span
    # Members of the own group: fewer than span at the right end, where each serves several counterparts.
    members = F.least(F.lit(span).cast("long"), n - place + inside)
    swaps = n > span
    turn = F.explode(F.when(swaps, F.sequence(F.lit(0), F.lit(fanout - 1))).otherwise(F.array(F.lit(0))))
    turned = state.select("*", turn.alias("turn"))
    first = place - place % wide + F.col("turn") * span
    reached = F.when(swaps, F.sequence(first + inside, first + span - 1, members)).otherwise(F.array(place))
    sent = turned.select(
        key, "n", F.explode(reached).alias("to"), "place", (F.floor(place / span) % fanout).alias("digit"), "node", "before", "after",
    ).where(F.col("to") < n)
    own = F.when(F.col("to") == place, F.struct("before", "after"))
    met = sent.groupBy(key, "to").agg(
        F.max("n").alias("n"), F.first(own, ignorenulls=True).alias("kept"),
        F.sort_array(F.collect_list(F.struct("digit", "node"))).alias("met"))
    mine = F.floor(F.col("to") / span) % fanout

    def joined(side) -> Column:
        return F.array_join(F.transform(F.filter("met", side), lambda x: x.node), "")

    def history(name: str, side) -> Column:
        return F.when(F.col("n") > span, F.array_append(F.col(f"kept.{name}"), joined(side))).otherwise(F.col(f"kept.{name}"))

    return met.select(
        key, F.col("to").alias("place"), "n",
        F.when(F.col("n") > span, F.sha2(joined(lambda x: F.lit(True)), 256)).otherwise(F.get("met", F.lit(0)).node).alias("node"),
        history("before", lambda x: x.digit < mine).alias("before"), history("after", lambda x: x.digit > mine).alias("after"))


def _folded(of: DataFrame, fanout: int, block_levels: int) -> DataFrame:
    """From blocks with their upper proofs, one row a leaf."""
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for row in batch.to_pylist():
                upper = list(zip(row["before"], row["after"]))
                end = "".join(a + b for a, b in upper)
                tree = levels([x["leaf"] for x in row["leaves"]], row["block"], fanout, block_levels)
                out = []
                for i, x in enumerate(row["leaves"]):
                    lower = steps(tree, i, fanout)
                    node = x["tampered"] or x["leaf"]
                    for a, b in lower + upper:
                        node = hashlib.sha256((a + node + b).encode()).hexdigest()
                    proof = "".join(a + b for a, b in lower) + end
                    out.append((
                        x["doc_id"], x["leaf"], row["subroot"], row["root"], hashlib.sha256(proof.encode()).hexdigest(),
                        node, node == row["root"]))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), kinds)], names=names)

    return of.mapInArrow(
        run, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def manifest(docs: DataFrame, fanout: int = FANOUT, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row."""
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    cut = written(blocks(written(leaves(docs), "leaves"), fanout, block_levels), "blocks")
    sizes = cut.groupBy("source_key").agg(F.count("*").alias("n"))
    lower = butterfly(
        block_roots(cut, fanout, block_levels).join(sizes, "source_key").withColumnRenamed("block", "place"), "source_key", fanout)
    # The first block of a source speaks for it.
    roots = written(batches(lower.where("place = 0").select("source_key", "node"), "source_key", 1), "subroots")
    number = roots.agg(F.count("*").alias("n")).scalar()
    upper = butterfly(roots.select(F.lit(0).alias("all"), F.col("batch_id").alias("place"), number.alias("n"), "node"), "all", fanout)
    tops = roots.select("source_key", F.col("batch_id").alias("place")).join(upper, "place").select(
        "source_key", F.col("node").alias("root"), F.col("before").alias("top_before"), F.col("after").alias("top_after"))
    proofs = lower.join(tops, "source_key").select(
        "source_key", F.col("place").alias("block"), F.col("node").alias("subroot"), "root",
        F.concat("before", "top_before").alias("before"), F.concat("after", "top_after").alias("after"))
    return _folded(cut.join(proofs, ["source_key", "block"]), fanout, block_levels)


#: The same in DuckDB, for ids that occur once.
MANIFEST_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, text,
    concat(CASE WHEN doc_id IS NULL THEN '-' ELSE concat(strlen(doc_id::VARCHAR), ':', doc_id) END,
           CASE WHEN source IS NULL THEN '-' ELSE concat(strlen(source), ':', source) END,
           CASE WHEN lang IS NULL THEN '-' ELSE concat(strlen(lang), ':', lang) END,
           CASE WHEN n_chars IS NULL THEN '-' ELSE concat(strlen(n_chars::VARCHAR), ':', n_chars) END) AS head,
    -- CRC-32 of the decimal id, bit by bit
    coalesce(xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda a, c: list_reduce(list_prepend(xor(a, c), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) % 2 = 0, false) AS cut
  FROM documents
), l AS (
  SELECT doc_id, source, sha256(concat(head, CASE WHEN text IS NULL THEN '-' ELSE concat(strlen(text), ':', text) END)) AS leaf,
    CASE WHEN cut THEN sha256(concat(head, CASE WHEN text IS NULL THEN '-'
      ELSE concat(strlen(replace(text, chr(10), '')), ':', replace(text, chr(10), '')) END)) END AS tampered
  FROM d
), p AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM l
), t AS (
  SELECT source, 0 AS lv, place AS i, leaf AS h, count(*) OVER (PARTITION BY source) AS n FROM p
  UNION ALL
  SELECT source, lv + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), any_value((n + 2) // 3)
  FROM t WHERE n > 1 GROUP BY source, lv, i // 3
), r AS (
  SELECT source, h AS subroot, lv AS top, row_number() OVER (ORDER BY source COLLATE "binary" NULLS FIRST) - 1 AS place FROM t WHERE n = 1
), u AS (
  SELECT 0 AS lv, place AS i, subroot AS h, count(*) OVER () AS n FROM r
  UNION ALL
  SELECT lv + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), any_value((n + 2) // 3) FROM u WHERE n > 1 GROUP BY lv, i // 3
), root AS (
  SELECT h AS root FROM u WHERE n = 1
), steps AS (
  SELECT p.source, p.place, t.lv, p.place // pow(3, t.lv)::BIGINT AS own, t.i, t.h
  FROM p JOIN t ON t.source IS NOT DISTINCT FROM p.source AND t.n > 1 AND t.i // 3 = p.place // pow(3, t.lv + 1)::BIGINT
  UNION ALL
  SELECT p.source, p.place, r.top + u.lv, r.place // pow(3, u.lv)::BIGINT, u.i, u.h
  FROM p JOIN r ON r.source IS NOT DISTINCT FROM p.source
    JOIN u ON u.n > 1 AND u.i // 3 = r.place // pow(3, u.lv + 1)::BIGINT
), sides AS (
  SELECT source, place, lv, coalesce(string_agg(h, '' ORDER BY i) FILTER (i < own), '') AS a,
    coalesce(string_agg(h, '' ORDER BY i) FILTER (i > own), '') AS b
  FROM steps GROUP BY source, place, lv
), proofs AS (
  SELECT source, place, string_agg(concat(a, b), '' ORDER BY lv) AS proof, list(concat(a, ':', b) ORDER BY lv) AS ways
  FROM sides GROUP BY source, place
), folded AS (
  SELECT p.doc_id, p.leaf, r.subroot, root.root, sha256(coalesce(proof, '')) AS proof_sha256,
    list_reduce(list_prepend(coalesce(p.tampered, p.leaf), coalesce(ways, [])),
      lambda x, w: sha256(concat(split_part(w, ':', 1), x, split_part(w, ':', 2)))) AS folded_root
  FROM p JOIN r ON r.source IS NOT DISTINCT FROM p.source CROSS JOIN root
    LEFT JOIN proofs q ON q.source IS NOT DISTINCT FROM p.source AND q.place = p.place
)
SELECT *, folded_root = root AS verified FROM folded
"""
