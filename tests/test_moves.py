"""What moves when a transfer is planned, and the same rows as the plain ways."""

import pytest
from pyspark.sql import functions as F

from modelferry.operators import joins, long_texts, reconcile, rewrite
from tests import small

HOST = small.HOST


@pytest.fixture
def no_broadcast(spark):
    least = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", least)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read(spark, df, path):
    """The rows as a table that is read."""
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def same(one, two):
    two = two.select(*one.columns)
    return one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()


def by_experiment_and_run(candidates, mapping, target_runs, host):
    """Target runs looked up by target experiment and source run."""
    known = target_runs.where(F.col("source_host") == host).groupBy(
        F.col("experiment_id").cast("string").alias("target_experiment_id"), F.col("source_run_id").alias("_source")
    ).agg(F.min(F.struct(F.col("run_id").cast("string").alias("run_id"), "artifact_uri")).alias("_known"))
    placed = candidates.join(mapping.select("experiment_id", "target_name", "target_experiment_id"), "experiment_id", "left")
    return placed.withColumn("_source", F.col("run_id").cast("string")).join(
        known, ["target_experiment_id", "_source"], "left").drop("_source")


@pytest.mark.parametrize("kind", ["string", "bigint"])
def test_runs_meet_target_runs_by_run_id(spark, no_broadcast, kind):
    """Odd tags, repeated runs, target runs in several experiments; no made id of an experiment moves with a run."""
    ids = ["1", "1", "2", "3", "4", "07"] + ["r x"] * (kind == "string")
    candidates = spark.createDataFrame(
        [(i, e) for i in ids for e in ("a", "b", None, "lost")], "run_id string, experiment_id string"
    ).withColumn("run_id", F.col("run_id").cast(kind))
    mapping = spark.createDataFrame(
        [("a", "/a", "10"), ("b", "/b", None), ("b", "/b2", "20"), ("c", "/c", "30")],
        "experiment_id string, target_name string, target_experiment_id string")
    runs = small.table(spark, "runs", [
        {"run_id": f"t{n}", "experiment_id": e, "source_host": h, "source_run_id": s, "artifact_uri": None if n % 2 else f"dbfs:/t{n}"}
        for n, (s, e, h) in enumerate(
            (s, e, h) for s in ("1", "1", "2", "02", "7", "07", "2 ", "r x", "", None, "9" * 30)
            for e in ("10", "20", "30", None) for h in (HOST, "https://other", None))])
    got = rewrite.run_places(candidates, mapping, runs, HOST)
    assert same(got, by_experiment_and_run(candidates, mapping, runs, HOST)) and got.where("_known is not null").count() > 3
    joined = [line for line in plan(got).splitlines() if "SortMergeJoin" in line]
    assert len(joined) == 2 and "target_experiment_id" not in "".join(joined)


@pytest.mark.parametrize("kind", ["string", "bigint"])
def test_rows_without_key_do_not_move(spark, folder, no_broadcast, kind):
    left = read(spark, spark.createDataFrame(
        [(n, k, p) for n, k in enumerate((None, "1", "1", "2", "9", None)) for p in ("x", "y", None)], "n int, run_id string, path string"
    ).withColumn("run_id", F.col("run_id").cast(kind)), f"{folder}/left")
    right = spark.createDataFrame(
        [("1", "x", 1, "a"), ("1", "x", 2, None), ("2", "y", 3, "b"), (None, "x", 4, "c"), ("2", None, 5, "d")],
        "run_id string, path string, hit int, text string")
    for run in ("string", "bigint"):
        looked = right.withColumn("run_id", F.col("run_id").cast(run))
        for keys in (["run_id"], ["run_id", "path"]):
            there = looked if "path" in keys else looked.drop("path")
            got = joins.parted_lookup(left, there, keys, ["n", "path"])
            assert same(got, joins.outer_lookup(left, there, keys, ["n", "path"]))
            assert ("_key" in plan(got)) == (run != kind)
            if run == kind:
                assert plan(got).count("isnull(run_id") == 2 and "Union" in plan(got).splitlines()[1] + plan(got).splitlines()[2]


def test_a_verdict_is_reached_with_one_look_at_the_runs(spark, folder, no_broadcast):
    """Pairs of runs and paths are made distinct once, meet files there and runs once; verdicts are those of each case."""
    source = small.sample_source(spark)
    extra = small.table(spark, "versions", [
        {"model_name": "m1", "version": v, "run_id": r, "source_uri": f"dbfs:/x/artifacts/{p}"}
        for v, r, p in ((4, "r1", "model"), (5, "r1", "plots"), (6, "r3", "model"), (7, "r4", "model"), (8, "r5", "model"), (9, "r1", "held"))])
    versions = read(spark, rewrite.with_model_path(source.versions.unionByName(extra)), f"{folder}/versions")
    places = read(spark, spark.createDataFrame(
        [("r1", "e1", "/e1", "t1", ("n1", None)), ("r2", "e2", "/e2", "t2", None), ("r3", "e1", "/e1", "t1", None),
         ("r4", "e9", None, None, None), ("r5", "e3", "/e3", None, None)],
        "run_id string, experiment_id string, target_name string, target_experiment_id string, _known struct<run_id: string, artifact_uri: string>"),
        f"{folder}/places")
    files = source.run_artifacts.unionByName(small.table(spark, "run_artifacts", [
        {"run_id": r, "path": "model/MLmodel", "size_bytes": 1} for r in ("r4", "r5")]))
    held = small.table(spark, "run_artifacts", [{"run_id": "n1", "path": "held/MLmodel", "size_bytes": 1}, {"run_id": "n1", "path": "model"}])
    judged = rewrite.judged_versions(versions, places, files, held, lambda p: rewrite.run_ids(p, HOST))
    assert sorted((r.model_name, r.version, r.reason or "", bool(r.target_run_id), r.on_target) for r in judged.collect()) == [
        ("cat.sch.m3", 1, "", True, False), ("m1", 1, "", True, False), ("m1", 2, "Model version m1 v2 has no run_id", False, False),
        ("m1", 3, "Run gone not found", False, False), ("m1", 4, "", True, False), ("m1", 5, "", True, False),
        ("m1", 6, "No model artifacts at model in run r3", False, False), ("m1", 7, "Experiment e9 not found", False, False),
        ("m1", 8, "Missing target experiment /e3", False, False), ("m1", 9, "", True, True), ("m2", 1, "", True, False)]
    reasons = plan(judged.select("model_name", "version", "reason"))
    assert "_key" not in reasons
    # Once for the verdicts and once for the target's files.
    assert sum("FileScan" in line and "/places" in line for line in reasons.splitlines()) == 2


def test_a_rollup_moves_name_and_run(spark, folder):
    """Versions without a run count, and are not moved to runs."""
    target = small.registry(
        spark, runs=[{"run_id": "n1", "experiment_id": "e"}, {"run_id": "n2", "experiment_id": "f"}],
        versions=[{"source_host": HOST, "model_name": m, "version": v, "run_id": r, "source_model_version": str(v)}
                  for m, v, r in (("a", 1, "n1"), ("a", 2, None), ("a", 3, "n2"), ("a", 4, "gone"), ("b", 1, None))])
    target = target.with_tables(versions=read(spark, target.versions, f"{folder}/versions"))
    counts = spark.createDataFrame([("n1", 2, 3, 4), ("gone", 9, 9, 9)], "run_id string, params long, metrics long, model_files long")
    rolled = reconcile.target_rollup(target, counts, HOST, "https://t")
    assert sorted(tuple(r) for r in rolled.collect()) == [
        ("a", 4, 2, 3, 4, "https://t/ml/experiments/e | https://t/ml/experiments/f"), ("b", 1, 0, 0, 0, None)]
    assert "xxhash64" not in plan(rolled)


def test_failures_move_once_and_as_rows(spark):
    failures = spark.createDataFrame(
        [("a", v, f"reason {v}" if v % 2 else None) for v in (9000, 1, 3, 2)] + [("b", 2, None), ("c", None, "late")],
        "model_name string, version int, reason string")
    parts = reconcile.failure_parts(failures)
    assert parts.columns == ["model_name", long_texts.PART, "rows", "text"]
    assert sorted(((r.model_name, r.part, r.rows, r.text) for r in parts.collect()), key=str) == [
        ("a", 0, 3, "reason 1; reason 3"), ("a", 2, 1, None), ("b", 0, 1, None), ("c", None, 1, "late")]
    assert "ENSURE_REQUIREMENTS" not in plan(parts)
    steps = parts._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")
    assert len(steps) == 2 and "Aggregate" in steps[0] and "Aggregate" not in steps[1]
