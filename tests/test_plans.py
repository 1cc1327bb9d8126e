"""Physical plans, and results where one group holds most of the rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.queries import all_queries
from modelferry import Options
from modelferry.operators import joins, long_texts, ranking, reconcile, rewrite, scope
from modelferry.plans import survey, transfer
from modelferry.session import written
from tests import small

QUERIES = all_queries()
PYTHON = {"model_metadata", "inventory_with_metadata", "artifact_copy", "copy_large_files", "migrate_with_files"}
# Not plans of one query: they act while they are built.
JOBS = {"migrate_all", "migrate_pending", "migrate_in_batches", "file_failures", "retried_files", "committed_tables", "target_as_source", "track_stream", "tracking_report", "paged_extract"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - JOBS - PYTHON))
def test_no_python_and_no_products(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text, bad


def test_small_caps_cut_groups_before_the_shuffle(spark, sf_dir):
    for name in ("capped_runs", "capped_versions"):
        assert plan(QUERIES[name](spark, sf_dir)).count("WindowGroupLimit") == 2


def test_filters_and_columns_reach_the_files(spark, folder):
    source = small.sample_source(spark)
    source.runs.write.parquet(f"{folder}/runs")
    runs = spark.read.schema(source.runs.schema).parquet(f"{folder}/runs")
    text = plan(scope.lifecycle(runs, False).select("run_id"))
    assert "EqualTo(lifecycle,active)" in text
    assert "ReadSchema: struct<run_id:string,lifecycle:string>" in text


def hot(spark, rows=30000):
    """Two thirds of the rows in one group, many equal order values."""
    return spark.range(rows).select(
        F.when(F.col("id") % 3 < 2, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("experiment_id"),
        F.col("id").cast("string").alias("run_id"), (F.col("id") % 7).alias("start_ms"),
    ).withColumn("start_ms", F.when(F.col("run_id") % 11 != 0, F.col("start_ms")))


@pytest.mark.parametrize("n", [1, 100, 101, 5000, 10**6])
def test_run_caps_equal_the_plain_window(spark, n):
    runs = hot(spark)
    plain = runs.withColumn("r", F.row_number().over(
        Window.partitionBy("experiment_id").orderBy(F.desc_nulls_last("start_ms"), "run_id"))).where(F.col("r") <= n).drop("r")
    capped = scope.cap_runs(runs, n)
    assert capped.count() == plain.count() and capped.exceptAll(plain).isEmpty()


@pytest.mark.parametrize("n", [2, 101, 9000])
def test_version_caps_equal_the_plain_window(spark, n):
    versions = hot(spark).select(F.col("experiment_id").alias("model_name"), F.col("run_id").cast("int").alias("version"))
    plain = versions.withColumn("r", F.row_number().over(
        Window.partitionBy("model_name").orderBy(F.desc("version")))).where(F.col("r") <= n).drop("r")
    capped = scope.cap_versions(versions, n)
    assert capped.count() == plain.count() and capped.exceptAll(plain).isEmpty()


def test_numbers_and_batches_equal_the_plain_window(spark):
    rows = hot(spark).select(F.col("experiment_id").alias("m"), F.col("run_id").cast("int").alias("version"))
    taken = spark.createDataFrame([("hot", 500)], "m string, last_version int")
    made = ranking.next_versions(rows, "m", taken)
    plain = rows.withColumn("target_version", (
        F.row_number().over(Window.partitionBy("m").orderBy("version")) + F.when(F.col("m") == "hot", 500).otherwise(0)).cast("int"))
    assert made.select(*plain.columns).exceptAll(plain).isEmpty() and made.count() == plain.count()
    names = hot(spark, 5000).select(F.col("run_id").alias("model_name"))
    batched = ranking.batches(names, "model_name", 7)
    whole = names.withColumn("batch_id", F.floor((F.row_number().over(Window.orderBy("model_name")) - 1) / 7))
    assert batched.exceptAll(whole).isEmpty() and batched.count() == 5000


def test_sampled_segments_split_a_hot_group(spark):
    cut = ranking.sampled_segments(hot(spark), [F.col("experiment_id"), F.col("run_id")])
    sizes = [r["count"] for r in cut.groupBy("experiment_id", "_segment").count().collect()]
    assert max(sizes) < 30000 * 0.05
    assert sum(sizes) == 30000


def test_few_rows_give_few_segments(spark):
    names = spark.createDataFrame([("b",), ("a",)], "model_name string")
    assert {r.model_name: r.batch_id for r in ranking.batches(names, "model_name", 1).collect()} == {"a": 0, "b": 1}
    assert ranking.batches(names.limit(0), "model_name", 1).count() == 0


def test_rows_without_key_are_spread(spark):
    left = spark.range(8000).select(
        F.col("id"), F.when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("run_id"))
    right = spark.range(0, 8000, 4).select(F.col("id").cast("string").alias("run_id"), F.lit(1).alias("hit"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = joins.outer_lookup(left, right, ["run_id"], ["id"])
        sizes = [r[0] for r in joined.groupBy(F.spark_partition_id()).count().select("count").collect()]
        got = joined.agg(F.count("*"), F.count("hit"), F.count("run_id")).first()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert tuple(got) == (8000, 2000, 4000)
    assert len(sizes) == 8 and max(sizes) < 8000 / 4


def test_one_model_with_most_versions(spark):
    """Totals and texts of a large model equal what was put in."""
    n = 20000
    versions = small.registry(spark).versions.sparkSession.range(1, n + 1).select(
        F.lit("big").alias("model_name"), F.col("id").cast("int").alias("version"),
        F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit("shared")).otherwise(F.lit("lost")).cast("string").alias("run_id"),
        F.concat(F.lit("u"), (F.col("id") % 10).cast("string")).alias("user_id"), F.lit("Production").alias("stage"),
        F.lit(None).cast("string").alias("source_uri"), F.lit(None).cast("string").alias("description"),
        F.col("id").alias("creation_ms"),
    )
    source = small.registry(
        spark, models=[{"model_name": "big"}], experiments=[{"experiment_id": "e", "name": "/e"}],
        runs=[{"run_id": "shared", "experiment_id": "e", "lifecycle": "active"}],
        run_params=[{"run_id": "shared", "key": "k", "value": "v"}],
        run_artifacts=[{"run_id": "shared", "path": "model/a", "size_bytes": 1}],
    ).with_tables(versions=versions)
    row = survey.inventory_report(source, Options(), "t").first()
    shared, lost = len(range(1, n + 1, 3)), len(range(2, n + 1, 3))
    assert (row.source_versions, row.source_versions_blocked, row.source_params) == (n, lost, shared)
    assert row.owner_emails == ", ".join(f"u{i}" for i in range(10)) and row.source_experiments == 1
    assert row.discovery_comments.startswith("v2: run missing; v5: run missing; v8")
    assert row.discovery_comments.count(";") == lost - 1
    done = transfer.plan_transfer(source, small.registry(spark), Options())
    good = done.judged().where("reason is null")
    assert good.count() == shared
    from modelferry.operators.rewrite import target_versions
    made = target_versions(done.judged(), small.registry(spark).versions, source.host)
    numbers = [r.version for r in made.select("version").collect()]
    assert sorted(numbers) == list(range(1, shared + 1))


def test_published_views_differ_only_in_absent_rows(spark, sf_dir):
    whole, published = fx.tables(spark, sf_dir), fx.tables(spark, sf_dir, True)
    assert whole["runs"].count() == 1500 and published["runs"].count() == 1286
    assert whole["versions"].count() == 6000 and published["versions"].count() == 520


def test_long_cells_equal_plain_joins(spark):
    """Most failures in one model, some without a reason, one without a version."""
    rows = [("big" if i % 3 else f"m{i % 7}", i, None if i % 11 == 0 else f"reason {i} " + "x" * (i % 80)) for i in range(1, 20001)]
    rows += [("none", 1, None), ("none", 9000, None), ("empty", 5000, ""), ("empty", 1, ""), ("big", None, "odd")]
    failures = spark.createDataFrame(rows, "model_name string, version int, reason string")
    expected = {}
    for model, version, reason in sorted(rows, key=lambda r: (r[0], -1 if r[1] is None else r[1])):
        count, texts = expected.get(model, (0, []))
        expected[model] = count + 1, texts + ([] if reason is None else [reason[:60]])
    got = {r.model_name: (r.failed, r.comments) for r in reconcile.failure_comments(failures).collect()}
    assert got == {m: (n, "; ".join(t)) for m, (n, t) in expected.items()}
    parts = reconcile.failure_parts(failures)
    assert parts.agg(F.max("rows")).first()[0] <= ranking.VERSIONS_PER_SEGMENT
    assert parts.where("model_name = 'big'").count() == 6
    assert reconcile.failure_comments(failures.where("false")).count() == 0


def test_a_cell_is_shuffled_as_parts(spark):
    failures = spark.createDataFrame([("m", 1, "r")], "model_name string, version int, reason string")
    exchanges = [line for line in plan(reconcile.failure_comments(failures)).splitlines() if "hashpartitioning" in line]
    assert len(exchanges) == 2 and f"{long_texts.PART}" in exchanges[1] and f"{long_texts.PART}" not in exchanges[0].split("ENSURE")[0].split("hashpartitioning")[1]


def test_requirement_texts_are_looked_up_last(spark):
    source = small.registry(
        spark, models=[{"model_name": "a"}, {"model_name": "b"}], experiments=[{"experiment_id": "e", "name": "/e"}],
        runs=[{"run_id": f"r{i}", "experiment_id": "e", "lifecycle": "active"} for i in range(4)],
        versions=[{"model_name": "a", "version": 1, "run_id": "r0"}, {"model_name": "a", "version": 2, "run_id": "r1"},
                  {"model_name": "a", "version": 3, "run_id": "r2"}, {"model_name": "b", "version": 1, "run_id": "r3"}])
    flavors = spark.createDataFrame([("r0", "f", "3"), ("r1", "g", None), ("r2", None, None)], "run_id string, flavors string, python_version string")
    texts = spark.createDataFrame([("r0", "old"), ("r1", "won"), ("r2", "no flavors"), ("r3", "none")], "run_id string, requirements string")
    rows = survey.inventory_report(source, Options(), "t", flavors, requirements=texts)
    assert {r.model_name: (r.flavors, r.requirements) for r in rows.collect()} == {"a": ("f | g", "won"), "b": (None, None)}
    whole = survey.inventory_report(source, Options(), "t", flavors.join(texts, "run_id", "full_outer"))
    assert {r.model_name: r.requirements for r in whole.collect()} == {"a": "won", "b": None}
    # The column is no part of any aggregate, and one join alone has it below.
    lines = rows._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert any("requirements#" in line for line in lines)
    assert not [line for line in lines if "Aggregate" in line and "requirements#" in line]


def test_points_of_a_transfer_are_read_once(spark, folder):
    """The inner join is staged; what follows reads the staged points, and of the source's only one scan is left."""
    points = [{"run_id": f"r{i % 5}", "key": f"k{i % 3}", "value": float(i), "ts_ms": i, "step": i} for i in range(60)]
    source = small.registry(spark, metric_points=points)
    source.metric_points.write.parquet(f"{folder}/metric_points")
    read = spark.read.schema(source.metric_points.schema).parquet(f"{folder}/metric_points")
    mapped = spark.createDataFrame(
        [(f"r{i}", f"t{i}", 7, 9, i < 4) for i in range(5)], "run_id string, target_run_id string, start_ms long, end_ms long, is_new boolean")
    metrics = spark.createDataFrame(
        [(f"r{i}", f"k{j}", 0.5) for i in range(5) for j in (0, 1, 8)], "run_id string, key string, value double")
    staged = []

    def stage(df, name):
        staged.append(plan(df))
        return written(df, name)

    rows = rewrite.metric_history(mapped, metrics, read, stage)
    assert len(staged) == 1 and staged[0].count("metric_points") == 1
    assert "metric_points" not in plan(rows)
    lazy = rewrite.metric_history(mapped, metrics, read)
    assert rows.exceptAll(lazy).isEmpty() and lazy.exceptAll(rows).isEmpty()
    assert rows.where("key = 'k8' and ts_ms = 9 and value = 0.5").count() == 4 and rows.where("key = 'k2' or run_id = 't4'").isEmpty()
    assert rows.count() == 4 + sum(p["run_id"] != "r4" and p["key"] != "k2" for p in points)


def test_a_staged_plan_holds_no_derived_columns_and_the_same_verdicts(spark):
    """What follows from other columns is neither stored nor moved; a failed version has no target."""
    source = small.sample_source(spark)
    stray = small.table(spark, "versions", [{"model_name": "no model", "version": 1, "run_id": "r1"}, {"model_name": None, "version": 2}])
    source = source.with_tables(versions=source.versions.unionByName(stray.select(*source.versions.columns)))
    staged = {}

    def stage(df, name):
        staged[name] = df.columns
        return df

    verdicts = [
        sorted((r.model_name, r.version, r.target_model, r.target_run_id or "", r.reason or "") for r in plan.judged().collect())
        for plan in (transfer.plan_transfer(source, small.registry(spark), Options(model_prefix="p_"), *how) for how in ((), (stage,)))]
    assert verdicts[0] == verdicts[1] and {v[0] for v in verdicts[0]} == {"m1", "m2"}
    assert all(bool(run) != bool(reason) for _, _, _, run, reason in verdicts[0])
    assert not {"target_run_id", "target_artifact_uri", "source_run_id"} & set(staged["run-map"])
    assert not {"target_model", "creation_ms"} & set(staged["to-clone"]) and "target_model" not in staged["judged"]
    assert "lost-models" in staged


def test_staged_tables_hold_only_what_goes_on(spark):
    """Of an address its path, of a run what is cloned, and of a verdict what a report asks for."""
    staged = {}

    def stage(df, name):
        staged[name] = df.columns
        return df

    plan = transfer.plan_transfer(small.sample_source(spark), small.registry(spark), Options(), stage)
    whole = {(r.model_name, r.version, r.reason) for r in plan.judged().collect()}
    assert "source_uri" not in staged["to-clone"] and "model_path" in staged["to-clone"]
    assert not {"run_name", "artifact_uri", "source_host"} & set(staged["run-map"])
    reasons = plan.judged(*transfer.VERDICT)
    assert staged["judged"] == ["model_name", "version", "reason"]
    assert {(r.model_name, r.version, r.reason) for r in reasons.collect()} == whole and len(whole) == 4


def test_new_versions_move_by_segment_and_equal_the_plain_anti_join(spark):
    """Absent, repeated and odd keys; numbers on both sides of a segment's end."""
    at = ranking.VERSIONS_PER_SEGMENT
    numbers = [None, 1, 2, 2, 7, at - 1, at, at + 1, 3 * at]
    source = small.table(spark, "versions", [
        {"model_name": m, "version": v, "source_uri": "dbfs:/x/artifacts/m"} for m in ("a", "b", None) for v in numbers])
    tags = ["1", "1", "2 ", "07", "7.0", "x", "", None, str(at), str(3 * at), str(2**40), "9" * 30]
    known = small.table(spark, "versions", [
        {"source_host": host, "model_name": name, "version": i, "source_model_version": tag}
        for host in (small.HOST, "https://other.example", None) for name in ("p_a", "b", None) for i, tag in enumerate(tags)])
    made = known.where((F.col("source_host") == small.HOST) & F.col("model_name").startswith("p_")).select(
        F.substr("model_name", F.lit(3)).alias("_model"), F.col("source_model_version").alias("_made"))
    plain = source.join(
        made, (F.col("model_name") == F.col("_model")) & (F.col("version").cast("string") == F.col("_made")), "left_anti")
    pathed = rewrite.with_model_path(source)
    new = rewrite.new_versions(pathed, known, small.HOST, "p_", True)
    rows = [sorted((r.model_name or "", r.version or -1) for r in df.collect()) for df in (new, plain)]
    assert rows[0] == rows[1] and len(rows[0]) == 24
    assert new.columns == [*pathed.columns, "target_model"]
    # The address ends below the join: it is not what moves.
    least = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(rewrite.new_versions(pathed, known, small.HOST, "p_", True))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", least)
    assert "source_uri" not in text[:text.index("Exchange hashpartitioning(model_name")]


@pytest.mark.parametrize("prefix", ["", "p_"])
def test_versions_meet_made_ones_by_source_name(spark, prefix):
    source = small.sample_source(spark)
    made = small.table(spark, "versions", [
        {"source_host": small.HOST, "model_name": f"{prefix}m1", "version": 7, "source_model_version": "1"},
        {"source_host": "https://other", "model_name": f"{prefix}m1", "version": 8, "source_model_version": "2"},
        {"source_host": small.HOST, "model_name": "x_m2", "version": 9, "source_model_version": "1"}])
    found = rewrite.new_versions(source.versions, made, small.HOST, prefix, True)
    assert sorted((r.model_name, r.version, r.target_model) for r in found.where("model_name like 'm_'").collect()) == [
        ("m1", 2, f"{prefix}m1"), ("m1", 3, f"{prefix}m1"), ("m2", 1, f"{prefix}m2")]


def test_an_inventory_moves_two_narrow_rows_by_version(spark):
    """Nothing but sums and distinct values is gathered by model, and what a version says itself does not go to its run."""
    source = small.sample_source(spark)
    lines = survey.inventory_report(source, Options(), "t")._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not [line for line in lines if "Generate" in line]
    moved = [line for line in lines if "RepartitionByExpression" in line]
    assert len(moved) == 2 and "part" in moved[1] and "part" not in moved[0].split("RepartitionByExpression")[1]


def test_inventory_of_experiments_and_runs_listed_twice(spark):
    """An experiment counts as often as it is listed, with its runs; so does a version whose run is listed twice."""
    source = small.registry(
        spark, models=[{"model_name": "a"}, {"model_name": "b"}],
        experiments=[{"experiment_id": "e", "name": "/e"}, {"experiment_id": "e", "name": "/d"}, {"experiment_id": "f", "name": "/f"}],
        runs=[{"run_id": "r1", "experiment_id": "e", "lifecycle": "active", "run_user": "w"},
              {"run_id": "r2", "experiment_id": "f", "lifecycle": "active"}, {"run_id": "r2", "experiment_id": "f", "lifecycle": "active"},
              {"run_id": "r3", "experiment_id": "gone", "lifecycle": "active"}, {"run_id": "r4", "lifecycle": "active", "run_user": ""}],
        run_params=[{"run_id": "r2", "key": "k", "value": "v"}],
        versions=[{"model_name": "a", "version": v, "run_id": r, "user_id": u, "stage": s} for v, r, u, s in (
            (1, "r1", "u", "None"), (2, "r2", "", "Staging"), (3, "r3", None, ""), (4, "r4", "x", None), (5, None, "u", "Staging"),
            (5000, "lost", "z", None), (6, "lost", "z", None), (6, "lost", "z", None))])
    rows = {r.model_name: r for r in survey.inventory_report(source, Options(), "t").collect()}
    a, b = rows["a"], rows["b"]
    assert (a.source_versions, a.source_versions_blocked, a.source_experiments, a.source_runs, a.source_params) == (9, 3, 4, 4, 2)
    assert (a.stages, a.owner_emails, a.experiments) == ("Staging", "u, w, x, z", "(id: gone) | /d | /e | /f")
    assert a.discovery_comments == "v6: run missing; v5000: run missing"
    assert (b.source_versions, b.stages, b.owner_emails, b.experiments, b.discovery_comments) == (0, "None", "", "", None)


def test_versions_are_numbered_before_they_are_named(spark):
    """The same rows as the view's, with parts listed twice or without a key, and no name below the window."""
    line = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
            "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")
    rows = [(o, p, o % 3, n, 1.0, float(-o), 0.0, 0.0, "RAN"[o % 3], "FO"[n % 2], None)
            for o in (1, 2, 2, 9) for n in (1, 7) for p in (1, 2, 3, None)]
    lines = spark.createDataFrame(rows, line)
    parts = spark.createDataFrame([(1, "a b", "t"), (2, "c", "t"), (2, "c", "t"), (4, "d", "t"), (None, "e", "t"), (3, None, "t")],
                                  "p_partkey long, p_name string, p_type string")
    models = parts.sparkSession.sql(fx.VIEWS["models"].replace("FROM part", "FROM {part}"), part=parts)
    sql = fx.VIEWS["versions"].replace("FROM lineitem JOIN models m", "FROM {lineitem} JOIN {models} m")
    plain = spark.sql(sql, lineitem=lines, models=models)
    made = fx.numbered_versions(lines, models)
    assert made.schema == plain.schema and made.count() == plain.count() > 0
    assert made.exceptAll(plain).isEmpty() and plain.exceptAll(made).isEmpty()
    text = made._jdf.queryExecution().optimizedPlan().toString()
    assert "p_name" not in text[text.index("Window"):].split("Aggregate")[0]
