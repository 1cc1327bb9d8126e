"""The pipeline against its operators' plain meaning, and the registered names."""

import random
from collections import Counter

import __spark_entry__ as entry
import corpus_pipeline as P
from modelferry.llm import best_fit_packing
from modelferry.llm.queries import all_oracles, all_queries


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in all_queries()) == list(range(1, 14))
    assert set(all_queries()) | {"pipeline"} <= set(entry.queries())
    assert set(all_oracles()) <= set(all_queries())


def test_stages_in_order_and_run(spark, folder):
    r = random.Random(6)
    words = ["".join(r.choices("abcdefghij", k=r.randint(2, 7))) for _ in range(300)]
    rows = []
    for i in range(120):
        rows.append((i, " ".join(r.choices(words, k=r.randint(20, 400))), "en", "big" if i % 3 else "small"))
    rows += [(200 + i, rows[i][1], "en", "copy") for i in range(5)]  # copies
    rows += [(300, "too short", "en", "big"), (301, None, None, None), (302, rows[3][1] + " password=abcdef123456", "en", "big")]
    rows += [(303, "alpha " * 60, "en", "big")]
    docs = spark.createDataFrame([(*x, len(x[1] or "")) for x in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(folder + "/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(50)], "doc_id long, quality int, toxic int").write.parquet(folder + "/labels.parquet")
    assert [n for n, _ in P.STAGES] == ["quality rules", "SimHash near-dedup", "secret scans", "mixing", "best-fit packing"]
    step, counts = spark.read.parquet(folder + "/documents.parquet"), []
    for _, stage in P.STAGES[:-1]:
        step = stage(spark, step, folder).cache()
        assert step.columns == docs.columns
        counts.append(step.count())
    ids = Counter(x.doc_id for x in step.collect())
    assert counts[0] == 126 and set(ids) <= set(range(120)) | {302} and len(ids) >= 118
    assert not any("abcdef123456" in x.text for x in step.where("doc_id = 302").collect())
    assert max(ids.values()) <= 2 and counts[3] >= counts[2]
    expected = Counter((r.doc_id, r.piece, r.length) for r in best_fit_packing.pack(step).collect())
    assert Counter((r.doc_id, r.piece, r.length) for r in P.run(spark, folder).collect()) == expected


CLASHES = "__fp int, __stays string, __md5 string, __tokens int, __turn int, __draw int, __n int, __t string, __base int, __spans int, rules int, row int, q int"


def test_clashing_columns_and_empty_tables(spark, folder):
    rng = random.Random(2)
    names = [f.split()[0] for f in CLASHES.split(", ")]
    rows = [(i, " ".join(rng.choices([f"w{j}" for j in range(500)], k=40)) + " token=abcdefg", "s", *["7" if "string" in f else 7 for f in CLASHES.split(", ")])
            for i in range(12)] + [(None, None, None, *[None] * len(names))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, " + CLASHES)
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    empty = docs.where("false")
    for name, stage in P.STAGES[:-1]:
        docs, empty = stage(spark, docs, folder), stage(spark, empty, folder)
        assert docs.columns == ["doc_id", "text", "source", *names] and empty.columns == docs.columns, name
        assert empty.count() == 0
    got = docs.collect()
    assert {r.doc_id for r in got} == set(range(12)) and all(str(v) == "7" for r in got for v in r[3:])
    assert all(r.text.endswith(" [SECRET]") for r in got)
    assert P.pack(spark, empty, folder).count() == 0 and P.pack(spark, docs, folder).count() >= 12
