"""Secret scans against Python's patterns, and the models on samples they were not trained on."""

import hashlib
import random
import re
import string
import time

from pyspark.sql import functions as F

from modelferry.llm import secret_scan as S
from modelferry.llm.common import prepare

ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base(text):
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 24]
    return ",".join(f"{S.KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


HEXES = "0123456789abcdef" * 3
TEXTS = [
    None, "", "nothing here", "password=abcdef", 'Token = "0123456789abcdef0123456789abcdef"', "secret=token:abcdefgh", "api_key: x APIKEY='abcdefg'",
    "é😀 passwd=ñoooooo token=aaaaaa", "AKIA" + "B" * 15, "xAKIA" + "B7" * 8 + "!", "AKIAAKIA" + "Q" * 14, HEXES + "é" + HEXES[:23],
    f"password={HEXES} {HEXES}", "token=" * 50, "secret='abc' secret:  'abcdef=='", "a" * 40, "g" + HEXES, "token=abcde token=abcdef." * 200,
    "PASSWORD\":\"zzzzzz", "ſecret=abcdefg", "key=" + HEXES.upper(),
]


def model(spark):
    rng = random.Random(3)
    words = ["river", "mountain", "customer", "Getting", "number", "service", "Straße", "through", "people", "different", "window", "history", "weather", "language"]
    docs = spark.createDataFrame([(i, " ".join(rng.choices(words, k=200))) for i in range(30)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(30)] + [(None, 1)], "doc_id long, quality int")
    return S.train(docs, labels)


def test_patterns_equal_python(spark):
    prepare(spark)
    docs = spark.createDataFrame([(i if i else None, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    rows = {r.doc_id or 0: r for r in S.scan(docs, labels).collect()}
    for i, t in enumerate(TEXTS):
        expected = base(t or "")
        r = rows[i]
        assert (r.base_sha256, r.spans) == (hashlib.sha256(expected.encode()).hexdigest(), expected), t
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(expected.count(k + ":") for k in S.KINDS[:3])
    assert S.scan(docs.where("false"), labels).count() == 0


def test_models_tell_random_from_ordinary(spark):
    prepare(spark)
    rng = random.Random(8)
    alphabets = (string.ascii_letters + string.digits, string.ascii_letters + string.digits + "-_", string.ascii_uppercase + string.digits)
    odd = ["".join(rng.choices(a, k=n)) for a in alphabets for n in (24, 32, 40) for _ in range(20)]
    plain = ["get_customer_number", "differentWindowHistory", "/mountain/river-language", "-" * 60, "=" * 40, "a_b_c_d_e_f_g_h_i_j", "throughthroughthrough",
             "serviceNumberService", "MOUNTAINWEATHER_CUSTOMER", "PeopleWindowWeather", "12345678901234567890"]
    docs = spark.createDataFrame([(i, f"see {s} now") for i, s in enumerate(odd + plain)], "doc_id long, text string")
    rows = {r.doc_id: r.s for r in S.with_spans(docs, model(spark)).select("doc_id", S.written_out(F.col("__spans")).alias("s")).collect()}
    found = [rows[i] for i in range(len(odd))]
    assert sum(s == f"markov:4:{4 + len(odd[i])}" for i, s in enumerate(found)) >= 0.85 * len(odd)
    assert [rows[len(odd) + i] for i in range(len(plain))] == [""] * len(plain)


def test_a_pattern_leaves_the_rest_of_its_run(spark):
    prepare(spark)
    rng = random.Random(12)
    key = "".join(rng.choices(string.ascii_letters + string.digits, k=40))
    texts = [f"é😀 /{HEXES}/{key} now", f"see {key}/password=abcdef1 now", f"{key}/{HEXES}/AKIA{'B7' * 8}/{key[::-1]}", f"/customer_number/{HEXES}/customer_number"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in S.with_spans(docs, model(spark)).select("doc_id", "__t", "__spans").collect()}
    for i, text in enumerate(texts):
        assert rows[i]["__t"] == text
        odd = [text[x.s:x.e] for x in rows[i]["__spans"] if x.k == 3]
        expected = {0: [key], 1: [key], 2: [key, key[::-1]], 3: []}[i]
        assert [o.strip("/") for o in odd] == expected
        assert base(text) == ",".join(f"{S.KINDS[x.k]}:{x.s}:{x.e}" for x in rows[i]["__spans"] if x.k < 3)


def test_no_python_in_the_plan(spark):
    prepare(spark)
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    plan = S.with_spans(docs, [0.0] * 6400)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_redaction(spark):
    prepare(spark)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    docs = spark.createDataFrame(
        [(1, f"é password={HEXES} end", 99, "a"), (2, "clean", 5, "b"), (None, None, None, None), (3, f"{HEXES} AKIA{'Z' * 20}", 1, "c")],
        "doc_id long, text string, n_chars long, __x string")
    rows = {r.doc_id: r for r in S.redact(docs, labels).collect()}
    assert rows[1].text == "é [SECRET] end" and rows[1].n_chars == len(rows[1].text)
    assert (rows[2].text, rows[2].n_chars) == ("clean", 5) and rows[None].text is None
    assert rows[3].text == "[SECRET] [SECRET]"
    assert S.redact(docs, labels).columns == docs.columns


def test_many_matches_and_long_texts(spark):
    prepare(spark)
    rng = random.Random(4)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    many = "".join(rng.choice([f"token=abcd{i}ef ", f"é😀{HEXES[:24]}\n", f"AKIA{'C3' * 8};", "x y "]) for i in range(20_000))
    wide = "é " * 3000 + "password=" + "Ab9/" * 3000 + " token=abcdefg" * 2
    edge = [" " * n + "token=abcdefgh" + HEXES for n in (S.SLICE - 20, S.SLICE - 1, S.SLICE)]
    docs = spark.createDataFrame(list(enumerate([many, wide, *edge])), "doc_id long, text string")
    started = time.monotonic()
    rows = {r.doc_id: r for r in S.scan(docs, labels).collect()}
    texts = {r.doc_id: r.text for r in S.redact(docs, labels).collect()}
    assert time.monotonic() - started < 90
    for i, text in enumerate([many, wide, *edge]):
        assert rows[i].spans == base(text)
        out, at = [], 0
        for _, s, e in (x.split(":") for x in base(text).split(",")):
            s, e = int(s), int(e)
            out += [text[at:s], S.SECRET] if s >= at else []
            at = max(at, e)
        assert texts[i] == "".join(out) + text[at:]


def test_clashing_columns(spark):
    prepare(spark)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    docs = spark.createDataFrame(
        [(1, "token=abcdefg", "mine", 1, 2), (2, None, None, None, None)], "doc_id long, text string, __t string, __spans int, row int")
    rows = {r.doc_id: r for r in S.redact(docs, labels).collect()}
    assert tuple(rows[1]) == (1, "[SECRET]", "mine", 1, 2) and tuple(rows[2]) == (2, None, None, None, None)
    assert S.redact(docs, labels).columns == docs.columns
