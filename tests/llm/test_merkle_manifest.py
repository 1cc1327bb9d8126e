"""The manifest against a plain tree, for all shapes of trees."""

import hashlib
import zlib

import pytest

from checks.compare import connect, differences
from modelferry.llm import merkle_manifest as M
from modelferry.llm.common import prepare


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def paths(nodes, fanout):
    """The root, and for each node its siblings (before, after) level by level."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            first = i - i % fanout
            ways[k].append(("".join(nodes[first:i]), "".join(nodes[i + 1:first + fanout])))
        nodes = [sha("".join(nodes[i:i + fanout])) for i in range(0, len(nodes), fanout)]
        at = [i // fanout for i in at]
    return nodes[0], ways


def plain(rows, fanout=3):
    """rows (doc_id, source, lang, n_chars, text) -> rows of the manifest."""
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append(r)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    out, trees = [], {}
    for s in sources:
        held = sorted(by_source[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[s] = (held, *paths([leaf(*r) for r in held], fanout))
    root, tops = paths([trees[s][1] for s in sources], fanout) if sources else ("", [])
    for s, top in zip(sources, tops):
        held, subroot, ways = trees[s]
        for r, way in zip(held, ways):
            cut = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            node = leaf(*r[:4], r[4].replace("\n", "") if r[4] is not None else None) if cut else leaf(*r)
            for a, b in way + top:
                node = sha(a + node + b)
            out.append((r[0], leaf(*r), subroot, root, sha("".join(a + b for a, b in way + top)), node, node == root))
    return sorted(out, key=repr)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def made(spark, rows, **options):
    prepare(spark)
    return sorted(map(tuple, M.manifest(spark.createDataFrame(rows, SCHEMA).repartition(3), **options).collect()), key=repr)


def documents(sizes):
    rows, n = [], 0
    for k, size in enumerate(sizes):
        for _ in range(size):
            n += 1
            rows.append((n * 7 % 1009, f"s{k}", "en", n, f"line {n}\nand more" if n % 2 else "one line"))
    return rows


# With blocks of three leaves: one block, full blocks, groups whose right end has one, two or many members.
@pytest.mark.parametrize("sizes", [[1], [3], [4], [9, 1], [10, 2, 30], [28, 1, 1, 1, 27], [85], [1] * 11, [82, 3, 3, 55]])
def test_manifest_equals_a_plain_tree(spark, sizes):
    rows = documents(sizes)
    assert made(spark, rows, block_levels=1) == plain(rows)


def test_other_fanouts_and_larger_blocks(spark):
    rows = documents([40, 7, 90])
    assert made(spark, rows, fanout=2, block_levels=2) == plain(rows, 2)
    assert made(spark, rows, fanout=5, block_levels=1) == plain(rows, 5)
    assert made(spark, rows) == plain(rows)


def test_nulls_repeated_rows_and_odd_texts(spark):
    rows = [
        (None, None, None, None, None), (None, None, None, None, None), (None, "a", "en", 1, "x\ny"), (1, None, "en", 1, ""), (2, "", "en", 0, "\n\n"),
        (3, "é", None, 3, "a\n" * 20_000), (4, "z", "", -5, "日本\n語"), (5, "Z", "en", 2, "no end"), (-6, "a", "en", 2, "-"),
    ]
    rows += [(8, "hot", "en", 4, "the same\n")] * 40 + [(9, "hot", "en", 4, f"another {i}\n") for i in range(5)]
    assert made(spark, rows, block_levels=1) == plain(rows)
    assert made(spark, []) == []


def test_extra_columns_do_not_matter(spark):
    prepare(spark)
    rows = documents([12, 5])
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(rows, SCHEMA)
    clash = docs.withColumns({"leaf": F.lit("mine"), "row": F.lit(1), "rank": F.lit(2), "block": F.lit(3), "source_key": F.lit("k"), "node": F.lit(0)})
    assert sorted(map(tuple, M.manifest(clash, block_levels=1).collect()), key=repr) == plain(rows)


def test_a_changed_row_breaks_its_proof_only(spark):
    rows = documents([30])
    got = made(spark, rows, block_levels=1)
    with_line_ends = {r[0] for r in rows if "\n" in r[4] and zlib.crc32(str(r[0]).encode()) % 2 == 0}
    assert {r[0] for r in got if not r[6]} == with_line_ends and with_line_ends


def test_query_equals_sql_and_plain_tree(spark):
    from modelferry.llm import queries

    sf = "/root/testdata/sf0.001"
    got = queries.op13_merkle_manifest(spark, sf)
    assert differences(got, connect(sf), M.MANIFEST_SQL) is None
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows)
