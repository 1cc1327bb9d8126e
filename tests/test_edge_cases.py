"""Behaviour in the cases a user of the migration relies on."""

import datetime

import pytest
from pyspark.sql import functions as F

from modelferry import Options
from modelferry.functions import errors, names, text, times
from modelferry.operators import inventory, metadata, reconcile, rewrite, scope, upsert
from modelferry.plans import survey, transfer
from modelferry.schemas import SOURCE_COLUMNS, TARGET_COLUMNS
from tests.small import HOST, plain, registry, sample_source, table, tracking


def now():
    return F.lit(datetime.datetime(2024, 1, 1))


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_source_and_target_columns():
    assert len(SOURCE_COLUMNS) == 19 and len(TARGET_COLUMNS) == 9


def test_options_are_checked():
    for bad in ({"batch_size": 0}, {"copy_threads": 0}, {"copy_threads": 65}, {"max_runs_per_experiment": 0},
                {"max_versions_per_model": 0}):
        with pytest.raises(ValueError):
            Options(**bad)


def test_hosts_and_names(spark):
    lit = F.lit
    assert value(spark, names.normalize_host(lit("https://h//"))) == "https://h"
    assert value(spark, names.target_experiment_name(lit("/a/b//"), "/r", "p_")) == "/r/p_b"
    for uri, path in (("x/artifacts/a/artifacts/b/", "a/artifacts/b"), ("x/artifacts/", "model"),
                      ("models:/r", "model"), (None, "model")):
        assert value(spark, names.model_artifact_path(lit(uri).cast("string"))) == path
    assert value(spark, names.path_token(lit(" _a b__ "))) == "a_b"
    assert value(spark, names.path_token(lit("  "))) == "item"
    assert value(spark, names.parent_path(lit("a/b/c"))) == "a/b"
    assert value(spark, names.parent_path(lit("c"))) is None
    assert value(spark, names.target_model_url(lit("https://adb-12.3.x/"), lit("m"))) == "https://adb-12.3.x/ml/models/m?o=12"
    assert value(spark, names.target_model_url(lit("https://x/"), lit("m"))) == "https://x/ml/models/m"


def test_times(spark):
    for ms, day in ((0, ""), (None, ""), (1_600_000_000_000, "2020-09-13")):
        assert value(spark, times.day_text(F.lit(ms).cast("bigint"))) == day
    assert value(spark, times.minute_text(F.lit(1_600_000_000_000))) == "2020-09-13 12:26"


def test_retry_rule(spark):
    def rule(code, message):
        return value(spark, errors.is_retryable(F.lit(code).cast("int"), F.lit(message).cast("string")))

    assert rule(500, "x") and rule(None, "id 14290") and rule(None, "Too Many Requests")
    assert not rule(None, "HTTP 500") and not rule(404, None)
    waits = [value(spark, errors.wait_seconds(F.lit(a), F.lit(True))) for a in range(6)]
    assert waits == [2.0, 4.5, 9.0, 17.5, 34.0, None]
    assert [errors.wait_for(a) for a in range(5)] == waits[:5]


def test_requirement_lines(spark):
    body = "a==1\r\n\n# no\n  # kept\n\tb \n#"
    assert value(spark, text.requirement_lines(F.lit(body))) == "a==1; # kept; b"


def test_allowlist_is_stripped(spark):
    models = registry(spark, models=[{"model_name": "a "}, {"model_name": "b"}, {"model_name": "x.y.a"}]).models
    assert [r.model_name for r in scope.allow_models(models, ["\ta\n"]).collect()] == ["a "]
    assert scope.allow_models(models, []).count() == 3
    listed = spark.createDataFrame([(" a",), ("none",)], "model_name string")
    assert scope.allow_models(models, listed).count() == 1


def test_inventory_of_each_kind_of_version(spark):
    source = sample_source(spark)
    rows = {r["model_name"]: r for r in plain(survey.inventory_report(source, Options(), "https://t/", now=now()))}
    assert set(rows) == {"m1", "m2"}
    one, two = rows["m1"], rows["m2"]
    assert one["readiness"] == "⚠️ PARTIAL — 2/3 versions migratable"
    assert (one["source_versions"], one["source_versions_migratable"], one["source_versions_blocked"]) == (3, 2, 1)
    assert one["discovery_comments"] == "v3: run missing"
    assert (one["source_experiments"], one["source_runs"], one["source_params"], one["source_metrics"],
            one["source_artifacts"]) == (1, 2, 1, 2, 2)
    assert one["owner_emails"] == "ann, bob, cy, dan" and one["stages"] == "Production"
    assert one["experiments"] == "/Users/ann/exp/" and one["target_host"] == "https://t"
    # A soft-deleted run can be read, but does not count among the runs.
    assert two["readiness"] == "✅ READY" and two["source_runs"] == 0
    assert two["stages"] == "None" and two["owner_emails"] == "" and two["latest_version_created"] == ""
    assert two["migration_status"] == "PENDING" and two["discovery_comments"] is None


def test_model_without_versions_is_blocked(spark):
    source = registry(spark, models=[{"model_name": "empty"}])
    row = plain(survey.inventory_report(source, Options(), "t"))[0]
    assert row["readiness"] == "❌ BLOCKED — all runs deleted" and row["source_versions"] == 0


def test_lost_experiment_is_named_by_id(spark):
    source = registry(
        spark, models=[{"model_name": "m"}], versions=[{"model_name": "m", "version": 1, "run_id": "r"}],
        runs=[{"run_id": "r", "experiment_id": "77", "lifecycle": "active"}],
    )
    row = plain(survey.inventory_report(source, Options(), "t"))[0]
    assert (row["experiments"], row["source_experiments"], row["source_runs"]) == ("(id: 77)", 1, 0)


def test_caps_limit_reach_but_not_the_inventory(spark):
    source = registry(
        spark, models=[{"model_name": "m"}],
        versions=[{"model_name": "m", "version": v, "run_id": f"r{v}"} for v in (1, 2)],
        experiments=[{"experiment_id": f"e{v}", "name": f"/x/{v}"} for v in (1, 2)],
        runs=[{"run_id": f"r{v}", "experiment_id": f"e{v}", "lifecycle": "active"} for v in (1, 2)],
    )
    row = plain(survey.inventory_report(source, Options(max_versions_per_model=1), "t"))[0]
    assert (row["source_versions"], row["source_experiments"], row["source_runs"]) == (2, 2, 1)
    off = plain(survey.inventory_report(source, Options(migrate_experiments=False), "t"))[0]
    assert off["source_runs"] == 0 and off["experiments"] == "/x/1 | /x/2"


def test_metadata_of_the_highest_version_with_flavors(spark):
    source = sample_source(spark)
    found = spark.createDataFrame(
        [("r1", "sklearn", "a==1", "3.9"), ("r2", None, "b==2", None)],
        "run_id string, flavors string, requirements string, python_version string",
    )
    rows = {r["model_name"]: r for r in plain(survey.inventory_report(source, Options(), "t", metadata=found))}
    assert (rows["m1"]["flavors"], rows["m1"]["requirements"], rows["m1"]["python_version"]) == ("sklearn", "a==1", "3.9")
    assert rows["m2"]["flavors"] is None and rows["m2"]["requirements"] is None


def test_malformed_model_files(spark):
    bodies = {"good": b"flavors:\n  b: {}\n  python_function: {python_version: 3.10.1}\n", "none": b"x: 1\n",
              "bad": b"flavors: [\n", "list": b"- 1\n"}
    files = spark.createDataFrame([(k, bytearray(v)) for k, v in bodies.items()], "run_id string, content binary")
    got = {r.run_id: (r.flavors, r.python_version) for r in metadata.model_flavors(files).collect()}
    assert got == {"good": ("b, python_function", "3.10.1"), "none": ("", None), "bad": (None, None), "list": (None, None)}


def test_error_rows_replace_inventory_rows(spark):
    source = sample_source(spark)
    failed = spark.createDataFrame([("m2", "x" * 200)], "model_name string, message string")
    rows = survey.inventory_report(source, Options(), "t", failures=failed)
    got = {r["model_name"]: r for r in plain(rows)}
    assert got["m2"]["readiness"] == "❌ ERROR — " + "x" * 60
    assert got["m2"]["discovery_comments"] == "Inventory error: " + "x" * 120
    s = inventory.inventory_summary(rows).first()
    assert (s.models, s.partial, s.blocked, s.ready) == (2, 1, 1, 0)


def test_merge_keeps_the_target_side(spark):
    old = tracking(
        spark,
        {"source_host": HOST, "model_name": "m1", "readiness": "old", "target_versions": 5, "migration_status": "COMPLETED"},
        {"source_host": "other", "model_name": "m1", "readiness": "theirs", "migration_status": "FAILED"},
    )
    rows = survey.inventory_report(sample_source(spark), Options(), "t", now=now())
    merged = upsert.merge_inventory(old, rows, now())
    got = {(r["source_host"], r["model_name"]): r for r in plain(merged)}
    assert got[HOST, "m1"]["target_versions"] == 5 and got[HOST, "m1"]["migration_status"] == "COMPLETED"
    assert got[HOST, "m1"]["readiness"].startswith("⚠")
    assert got["other", "m1"]["readiness"] == "theirs" and got["other", "m1"]["last_updated_at"] is None
    assert got[HOST, "m2"]["migration_status"] == "PENDING"
    again = upsert.merge_inventory(merged, rows, now())
    assert sorted(map(repr, plain(again))) == sorted(map(repr, plain(merged)))


def test_merge_refuses_double_and_null_keys(spark):
    old = tracking(spark)
    for bad in ([{"source_host": "h", "model_name": "m"}] * 2, [{"source_host": "h", "model_name": None}]):
        with pytest.raises(Exception, match="key is NULL or not unique"):
            upsert.merge_inventory(old, tracking(spark, *bad)).collect()


def test_outcomes_of_unknown_models_are_ignored(spark):
    old = tracking(spark, {"source_host": HOST, "model_name": "m", "migration_comments": "old", "migration_status": "PENDING"})
    done = tracking(
        spark, {"source_host": HOST + "/", "model_name": "m", "migration_status": "COMPLETED", "target_versions": 1},
        {"source_host": HOST, "model_name": "stranger", "migration_status": "FAILED"},
    ).select("source_host", "model_name", *TARGET_COLUMNS)
    rows = plain(upsert.apply_outcomes(old, done, now()))
    assert [(r["model_name"], r["migration_status"], r["migration_comments"]) for r in rows] == [("m", "COMPLETED", None)]


def test_reset_reopens_only_failed(spark):
    rows = tracking(spark, {"model_name": "a", "migration_status": "FAILED"}, {"model_name": "b", "migration_status": "PARTIAL"})
    assert {r["model_name"]: r["migration_status"] for r in plain(upsert.reset_status(rows))} == {"a": "PENDING", "b": "PARTIAL"}


def test_transfer_records(spark):
    source = sample_source(spark)
    plan = transfer.plan_transfer(source, registry(spark), Options(skip_existing_versions=True))
    reasons = {(r.model_name, r.version): r.reason for r in plan.judged().collect()}
    assert reasons == {
        ("m1", 1): None, ("m1", 2): "Model version m1 v2 has no run_id", ("m1", 3): "Run gone not found", ("m2", 1): None,
    }
    # Both experiments end in "exp", so they share a target; the lowest id stands for it.
    made = plain(rewrite.target_experiments(plan.mapping, source.host))
    assert [(r["name"], r["source_experiment_id"]) for r in made] == [("/Shared/mlflow-workspace-migration/exp", "e1")]
    tags = {r["key"]: r["value"] for r in plain(rewrite.target_experiment_tags(plan.mapping, source.experiment_tags, source.host))}
    assert tags == {"team": "two", "source_workspace_host": HOST, "source_experiment_id": "e1"}
    # The soft-deleted run of a cloned version is fetched by its id.
    assert {r.run_id for r in plan.mapped.collect()} == {"r1", "r2", "r3"}
    runs = {r["source_run_id"]: r for r in plain(rewrite.target_runs(plan.mapped, source.run_tags, source.host))}
    assert runs["r1"]["run_name"] == "first run" and runs["r3"]["end_ms"] is None
    new_id = runs["r1"]["run_id"]
    run_tags = {r["key"]: r["value"] for r in plain(rewrite.target_run_tags(plan.mapped, source.run_tags, source.host)) if r["run_id"] == new_id}
    assert run_tags == {"team": "x", "source_workspace_host": HOST, "source_run_id": "r1"}
    points = {(r["key"], r["ts_ms"], r["step"]): r["value"] for r in
              plain(rewrite.metric_history(plan.mapped, source.run_metrics, source.metric_points)) if r["run_id"] == new_id}
    assert points == {("loss", 11, 0): 0.7, ("loss", 12, 1): 0.5, ("acc", 20, 0): 0.9}
    made = rewrite.target_versions(plan.judged(), registry(spark).versions, source.host)
    assert {(r.model_name, r.version) for r in made.collect()} == {("m1", 1), ("m2", 1)}
    vtags = {r["key"]: r["value"] for r in plain(rewrite.target_version_tags(made, source.version_tags, source.host)) if r["model_name"] == "m1"}
    assert vtags["source_model_version"] == "stale" and vtags["source_model_name"] == "m1"
    files = {(r.run_id, r.path) for r in plan.manifest(plan.judged()).collect()}
    assert files == {("r1", "model/MLmodel"), ("r1", "model/data/m.bin"), ("r1", "plots/p.png"), ("r2", "model/MLmodel")}


def test_artifact_flags(spark):
    source = sample_source(spark)
    for flags in ({"download_artifacts": False}, {"include_run_artifacts": False}):
        plan = transfer.plan_transfer(source, registry(spark), Options(**flags))
        assert {r.path for r in plan.manifest(plan.judged()).collect()} == {"model/MLmodel", "model/data/m.bin"}


def test_run_in_another_experiment_is_not_known(spark):
    source = sample_source(spark)
    other = registry(
        spark, experiments=[{"experiment_id": "t1", "name": "/Shared/mlflow-workspace-migration/exp"}],
        runs=[{"run_id": "x1", "experiment_id": "t9", "source_run_id": "r1", "source_host": HOST},
              {"run_id": "x3", "experiment_id": "t1", "source_run_id": "r3", "source_host": HOST}],
    )
    mapped = {r.run_id: r for r in transfer.plan_transfer(source, other, Options()).mapped.collect()}
    assert mapped["r1"].is_new and not mapped["r3"].is_new and mapped["r3"].target_run_id == "x3"


def test_missing_target_experiments_are_failures(spark):
    source = sample_source(spark)
    plan = transfer.plan_transfer(source, registry(spark), Options(create_missing_experiments=False))
    reasons = {(r.model_name, r.version): r.reason for r in plan.judged().collect()}
    assert reasons["m1", 1] == "Missing target experiment /Shared/mlflow-workspace-migration/exp"
    assert rewrite.new_experiments(plan.mapping).count() == 0 and rewrite.new_runs(plan.mapped).count() == 0


def test_switched_off_entities(spark):
    source = sample_source(spark)
    plan = transfer.plan_transfer(source, registry(spark), Options(migrate_experiments=False))
    assert plan.found.experiments.count() == 0
    # Versions still bring their own runs and experiments along.
    assert {r.run_id for r in plan.mapped.where("is_new").collect()} == {"r1", "r2"}
    none = transfer.plan_transfer(source, registry(spark), Options(migrate_models=False))
    assert none.judged().count() == 0 and {r.run_id for r in none.mapped.collect()} == {"r1", "r3"}


def test_purged_model_files_fail_the_version(spark):
    source = sample_source(spark)
    bare = source.with_tables(run_artifacts=source.run_artifacts.where("run_id <> 'r2'"))
    plan = transfer.plan_transfer(bare, registry(spark), Options())
    reasons = {(r.model_name, r.version): r.reason for r in plan.judged().collect()}
    assert reasons["m2", 1] == "No model artifacts at model in run r2" and reasons["m1", 1] is None


def test_same_workspace_counts_only_tagged_versions(spark):
    versions = table(spark, "versions", [
        {"model_name": "m", "version": 1}, {"model_name": "m", "version": 2, "source_model_version": ""},
        {"model_name": "m", "version": 3, "source_model_version": "1"},
    ])
    assert [r.version for r in reconcile.tagged_versions(versions).collect()] == [3]


def test_status_of_finished_models(spark):
    source = registry(spark, models=[{"model_name": n} for n in ("done", "part", "fail", "skip", "untracked")])
    track = tracking(spark, *[
        {"source_host": HOST, "model_name": n, "source_versions_migratable": 2} for n in ("done", "part", "fail", "skip")
    ])
    rollup = spark.createDataFrame(
        [("done", 2), ("part", 1), ("untracked", 1)], "model_name string, versions bigint"
    ).selectExpr("*", "0L params", "0L metrics", "0L model_files", "null experiment_urls")
    failed = spark.createDataFrame([("fail", 2, "b" * 70), ("fail", 1, "a")], "model_name string, version int, reason string")
    cloned = spark.createDataFrame([("done", 1)], "model_name string, version int")
    rows = {r["model_name"]: r for r in plain(
        reconcile.model_outcomes(source.models, track, rollup, cloned, failed, HOST + "/", "https://t/", ""))}
    assert {n: r["migration_status"] for n, r in rows.items()} == {
        "done": "COMPLETED", "part": "PARTIAL", "fail": "FAILED", "skip": "SKIPPED", "untracked": "PARTIAL"}
    assert rows["fail"]["migration_comments"] == "a; " + "b" * 60 and rows["done"]["target_runs"] == 1


def test_report_match_flags(spark):
    source = registry(
        spark, models=[{"model_name": "m"}],
        versions=[{"model_name": "m", "version": v, "run_id": r} for v, r in ((1, "r1"), (2, "r1"), (3, None))],
        runs=[{"run_id": "r1", "experiment_id": "e"}], run_params=[{"run_id": "r1", "key": "k", "value": "v"}],
        run_artifacts=[{"run_id": "r1", "path": "model/a", "size_bytes": 1}],
    )
    target = registry(
        spark, host="t", versions=[
            {"source_host": HOST, "model_name": "m", "version": 7, "run_id": "t1", "source_model_version": "1"},
            {"source_host": "elsewhere", "model_name": "m", "version": 8, "run_id": "t1", "source_model_version": "2"},
            {"source_host": HOST, "model_name": "m", "version": 9, "run_id": "lost", "source_model_version": "3"},
        ],
        runs=[{"run_id": "t1", "experiment_id": "e"}], run_params=[{"run_id": "t1", "key": "k", "value": "other"}],
    )
    rows = {r["version"]: r for r in plain(transfer.reconciliation(source, target, Options()))}
    assert (rows[1]["status"], rows[1]["params_match"], rows[1]["artifacts_match"]) == ("✅ MIGRATED", True, False)
    assert (rows[2]["status"], rows[2]["params_match"], rows[2]["target_params"]) == ("⚠️ FAILED", None, None)
    assert (rows[3]["status"], rows[3]["params_match"], rows[3]["target_params"]) == ("✅ MIGRATED", False, 0)
