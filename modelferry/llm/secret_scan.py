"""Secret scans: fixed patterns, and character Markov models for strings without a telling name.

Native: expressions of Spark alone. Three kinds of spans come from patterns (assign, access,
hex). A fourth, ``markov``, covers runs of 16 or more characters of ``[A-Za-z0-9+/_=-]`` with a letter that look
random: two first-order Markov models over characters, one of random strings, one of ordinary
identifiers, give a log-likelihood ratio, and a run counts at ``MIN_RATIO`` or more.
Spans of the patterns cut runs, and every part that is left is judged like a run of its own.

Both models are trained from labelled samples. Random: ``STRINGS`` strings made from
seeded digests, in hexadecimal, base64, its URL form and upper case. Ordinary: words, and identifiers joined from
neighbouring words in several forms, of at most ``SAMPLE`` documents that are labelled good and hold none of the pattern kinds,
those with the smallest hash of their id; and runs of one separator. Counts are by
pair of characters, so what reaches the driver is bounded (80 x 80).

Null text counts as empty: no spans. Positions are code points, ends exclusive. Rows are
judged one by one: repeated rows and null ids change nothing, and an empty table gives an empty one. The work follows
the length of a text and its matches, however many there are. Other columns stay as they are. Without labels the ordinary model is flat, and no run counts as random.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Kinds in the order in which they are listed.
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # a run that fails has no longer one inside it
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"  # whole runs alone, so no other start is tried
LEAST_VALUE = 6

RUN = r"(?<![A-Za-z0-9+/_=-])(?=[0-9+/_=-]*+[A-Za-z])[A-Za-z0-9+/_=-]{16,}+"
MIN_RATIO = 10.0
STRINGS = 20_000
SAMPLE = 300
SEED = 10
LOW, CODES = 43, 80  # characters from '+' to 'z'
SECRET = "[SECRET]"
# Items of one block of a running sum; characters of one slice of a text that is rewritten.
BLOCK, SLICE = 128, 2048

_NO_SPANS = "array<struct<s:int,k:int,e:int>>"


def _empty() -> Column:
    return F.array().cast(_NO_SPANS)


def _running(items: Column, following, emit, empty: Column) -> Column:
    """``emit(state, item)`` of each item; the state starts at 0 and goes on by ``following(state, item)``.

    Items are taken in blocks, and each block's results are put end to end once, so the work follows the number of items.
    """
    first = F.struct(F.lit(0).alias("at"), items.alias("items"), F.array(empty).alias("out"))

    def step(acc, j):
        def inner(own, x):
            return F.struct(following(own["at"], x).alias("at"), F.concat(own["out"], F.array(emit(own["at"], x))).alias("out"))

        return F.aggregate(
            F.slice(acc["items"], j * BLOCK + 1, F.lit(BLOCK)), F.struct(acc["at"].alias("at"), empty.alias("out")), inner,
            lambda own: F.struct(own["at"].alias("at"), acc["items"].alias("items"), F.concat(acc["out"], F.array(own["out"])).alias("out")))

    blocks = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int"))
    folded = F.aggregate(blocks, first, step, lambda acc: F.flatten(acc["out"]))
    return F.when(F.size(items) > 0, folded).otherwise(empty)


def _placed(text: Column, pattern: str, matches: Column, kind: int) -> Column:
    """Spans of all matches, from the lengths of the pieces of text between them."""
    # One piece follows the last match.
    lengths = F.filter(
        F.zip_with(F.split(text, pattern, -1), matches, lambda p, m: F.struct(F.length(p).alias("p"), F.length(m).alias("m"))),
        lambda x: x["m"].isNotNull())

    def span(at, x):
        return F.struct((at + x["p"]).alias("s"), F.lit(kind).alias("k"), (at + x["p"] + x["m"]).alias("e"))

    placed = _running(lengths, lambda at, x: at + x["p"] + x["m"], span, _empty())
    return F.when(F.size(matches) > 0, placed).otherwise(_empty())


def _merged(spans: Column) -> Column:
    """Spans without overlaps, from spans in order: those that share a character become one."""
    empty = F.array().cast("array<struct<s:int,before:int>>")
    seen = _running(spans, lambda at, x: F.greatest(at, x["e"]),
                    lambda at, x: F.struct(x["s"].alias("s"), at.alias("before")), empty)
    firsts = F.filter(seen, lambda x: x["s"] >= x["before"])
    # A run ends at the furthest end before the next run starts.
    last = F.array(F.array_max(F.transform(spans, lambda x: x["e"])))
    return F.transform(
        F.array(firsts), lambda runs: F.zip_with(
            runs, F.concat(F.transform(F.slice(runs, 2, F.size(runs)), lambda x: x["before"]), last),
            lambda x, e: F.struct(x["s"].alias("s"), e.alias("e"))))[0]


def _filled(text: Column, spans: Column, fill) -> Column:
    """The text with ``fill(span starts here, characters)`` in place of each part of a span; spans do not overlap.

    The text is read in slices of ``SLICE`` characters, each with its own few spans.
    """
    slices = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{SLICE}}}"), F.lit(0))
    first = F.struct(F.lit(0).alias("low"), F.lit(0).alias("next"), spans.alias("spans"), F.array().cast("array<string>").alias("out"))

    def step(acc, own):
        # A span has a character at least, so no more than these meet the slice.
        high = acc["low"] + SLICE
        near = F.filter(F.slice(acc["spans"], acc["next"] + 1, F.lit(SLICE)), lambda x: x["s"] < high)

        def part(done, x):
            begin, end = F.greatest(x["s"] - acc["low"], F.lit(0)), F.least(x["e"] - acc["low"], F.lit(SLICE))
            plain = F.substring(own, done["at"] + 1, begin - done["at"])
            return F.struct(end.alias("at"), F.concat(done["out"], plain, fill(x["s"] >= acc["low"], end - begin)).alias("out"),
                            (done["gone"] + (x["e"] <= high).cast("int")).alias("gone"))

        return F.aggregate(
            near, F.struct(F.lit(0).alias("at"), F.lit("").alias("out"), F.lit(0).alias("gone")), part,
            lambda done: F.struct(
                high.alias("low"), (acc["next"] + done["gone"]).alias("next"), acc["spans"].alias("spans"),
                F.concat(acc["out"], F.array(F.concat(done["out"], F.substring(own, done["at"] + 1, F.lit(SLICE))))).alias("out")))

    return F.aggregate(slices, first, step, lambda acc: F.array_join(acc["out"], ""))


def with_patterns(docs: DataFrame) -> DataFrame:
    """Adds ``__t`` (the text, null as empty) and ``__base`` (spans of the pattern kinds, in order)."""
    t = F.col("__t")
    out = docs.withColumn("__t", F.coalesce("text", F.lit("")))
    none = F.array().cast("array<string>")
    sought = F.contains(t, F.lit("=")) | F.contains(t, F.lit(":"))
    out = out.withColumn("__v", F.when(sought, F.regexp_extract_all(t, F.lit(ASSIGN), F.lit(2))).otherwise(none))
    out = out.withColumn("__m", F.when(
        F.size("__v") > 0, F.regexp_extract_all(t, F.lit(ASSIGN), F.lit(0))).otherwise(none))
    out = out.withColumn("__a", F.when(
        F.contains(t, F.lit("AKIA")), F.regexp_extract_all(t, F.lit(ACCESS), F.lit(0))).otherwise(none))
    out = out.withColumn("__h", F.regexp_extract_all(t, F.lit(HEX), F.lit(0)))
    assign = F.filter(
        F.arrays_zip(_placed(t, ASSIGN, F.col("__m"), 0).alias("span"), F.col("__v").alias("v")),
        lambda x: F.length(x["v"]) >= LEAST_VALUE)
    base = F.array_sort(F.concat(
        F.transform(assign, lambda x: x["span"]),
        _placed(t, ACCESS, F.col("__a"), 1), _placed(t, HEX, F.col("__h"), 2)))
    return out.withColumn("__base", base).drop("__v", "__m", "__a", "__h")


def random_strings(spark: SparkSession) -> DataFrame:
    """The sample labelled random: one column ``s``."""
    digest = F.sha2(F.concat(F.lit(f"{SEED}:"), F.col("id").cast("string")), 256)
    coded = F.base64(F.unhex(digest))
    form = F.col("id") % 4
    return spark.range(STRINGS).select(
        F.when(form == 0, F.substring(digest, 1, 40)).when(form == 1, F.rtrim(F.lit("="), coded))
        .when(form == 2, F.translate(F.rtrim(F.lit("="), coded), "+/", "-_"))
        .otherwise(F.regexp_replace(F.upper(coded), "[^A-Z0-9]", "")).alias("s"))


def ordinary_strings(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The sample labelled ordinary: one column ``s``."""
    chosen = labels.where("quality = 1 and doc_id is not null").select(
        F.col("doc_id").alias("sample_id")).distinct().orderBy(
        F.xxhash64(F.lit(SEED), "sample_id"), "sample_id").limit(SAMPLE)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("sample_id"))
    # No filter here: it would go below the join, and patterns would be sought in all documents.
    words = with_patterns(texts).select(F.when(F.size("__base") == 0, F.split("__t", r"[^A-Za-z0-9]+")).alias("w"))
    at = F.sequence(F.lit(0), F.size("w") - 2)
    pair = F.transform(at, lambda i: F.concat_ws(
        "_", F.lower(F.get("w", i)), F.lower(F.get("w", i + 1))))
    camel = F.transform(at, lambda i: F.concat(F.lower(F.get("w", i)), F.initcap(F.get("w", i + 1))))
    path = F.transform(at, lambda i: F.concat(F.lit("/"), F.get("w", i), F.lit("-"), F.get("w", i + 1)))
    upper = F.transform(pair, F.upper)
    forms = F.when(F.size("w") > 1, F.concat("w", pair, camel, path, upper)).otherwise(F.col("w"))
    marks = docs.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c * 200) for c in "-=_+/"])).alias("s"))
    return words.select(F.explode_outer(forms).alias("s")).where("s is not null").unionByName(marks)


def pair_counts(strings: DataFrame) -> dict[int, int]:
    """Counts by pair of neighbouring characters, as code of the first * CODES + code of the second."""
    chars = strings.where(F.length("s") > 1).select(F.split("s", "").alias("c"))
    pairs = chars.select(F.explode(_codes(F.col("c"))).alias("p")).groupBy("p").count().where("p is not null")
    return {int(p): int(n) for p, n in pairs.collect()}


def _codes(chars: Column) -> Column:
    """Pair codes of an array of characters; null for a pair with a foreign character."""
    code = F.transform(chars, lambda c: F.ascii(c) - LOW)
    known = F.transform(code, lambda c: F.when((c >= 0) & (c < CODES), c))
    return F.zip_with(known, F.slice(known, 2, F.size(known)), lambda a, b: a * CODES + b)


def ratios(random: dict[int, int], ordinary: dict[int, int]) -> list[float]:
    """log P(b | a, random) - log P(b | a, ordinary) by pair, with half a count added to each."""

    def logs(counts):
        sums = [sum(counts.get(a * CODES + b, 0) for b in range(CODES)) for a in range(CODES)]
        return [math.log((counts.get(i, 0) + 0.5) / (sums[i // CODES] + 0.5 * CODES)) for i in range(CODES * CODES)]

    return [round(x - y, 6) for x, y in zip(logs(random), logs(ordinary))]


def train(docs: DataFrame, labels: DataFrame) -> list[float]:
    """The ratio by pair. A pair unseen as ordinary because there is no sample counts for nothing."""
    ordinary = pair_counts(ordinary_strings(docs, labels))
    if sum(n for p, n in ordinary.items() if p // CODES != p % CODES) == 0:
        return [0.0] * (CODES * CODES)
    return ratios(pair_counts(random_strings(docs.sparkSession)), ordinary)


def _blanked(text: Column, spans: Column) -> Column:
    """The text with a blank for each character of the spans, which are in order and may overlap."""
    return _filled(text, _merged(spans), lambda starts, n: F.repeat(F.lit(" "), n))


def with_spans(docs: DataFrame, model: list[float]) -> DataFrame:
    """All columns, ``__t``, ``__base`` and ``__spans`` (all spans in order)."""
    table = F.array(*[F.lit(x) for x in model])

    def ratio(run):
        return F.aggregate(_codes(F.split(run, "")), F.lit(0.0), lambda acc, p: acc + F.coalesce(F.get(table, p), F.lit(0.0)))

    t = F.col("__u")
    out = with_patterns(docs)
    out = out.withColumn("__u", F.when(F.size("__base") > 0, _blanked(F.col("__t"), F.col("__base"))).otherwise(F.col("__t")))
    out = out.withColumn("__runs", F.regexp_extract_all(t, F.lit(RUN), F.lit(0)))
    out = out.withColumn("__odd", F.transform("__runs", lambda run: ratio(run) >= MIN_RATIO))
    placed = F.when(F.exists("__odd", lambda x: x), _placed(t, RUN, F.col("__runs"), 3)).otherwise(_empty())
    out = out.withColumn("__placed", placed)
    found = F.transform(
        F.filter(F.arrays_zip(F.col("__placed").alias("span"), F.col("__odd").alias("odd")),
                 lambda x: x["odd"] & x["span"].isNotNull()), lambda x: x["span"])
    return out.withColumn("__spans", F.array_sort(F.concat("__base", found))).drop("__u", "__runs", "__odd", "__placed")


def written_out(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(kinds, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def scan(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, counts by kind, the digest of the pattern spans, all spans."""
    rows = with_spans(docs.select("doc_id", "text"), train(docs, labels))

    def n(kind):
        return F.size(F.filter("__base", lambda x: x["k"] == kind)).cast("long")

    return rows.select(
        "doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
        F.sha2(written_out(F.col("__base")), 256).alias("base_sha256"),
        written_out(F.col("__spans")).alias("spans"))


def redact(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents with ``[SECRET]`` in place of each run of touching spans; a null text stays null.

    ``n_chars``, if there is one, follows the new text.
    """
    # The row goes along whole, so no column of it clashes with a working one.
    rows = with_spans(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text"), train(docs, labels))
    rest = _filled(F.col("__t"), _merged(F.col("__spans")), lambda starts, n: F.when(starts, F.lit(SECRET)).otherwise(""))
    hit = F.size("__spans") > 0
    rows = rows.withColumn("__new", F.when(hit, rest).otherwise(F.col("text")))
    changed = {"text": F.col("__new")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(hit, F.length("__new")).otherwise(F.col("row.n_chars"))
    return rows.select(*[
        changed[c].cast(docs.schema[c].dataType).alias(c) if c in changed else F.col("row")[c].alias(c) for c in docs.columns])
