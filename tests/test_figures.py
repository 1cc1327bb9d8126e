"""The figures of FIXTURES.md section D, on its own views."""

import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from modelferry import Options
from modelferry.functions.errors import is_retryable
from modelferry.operators import counts, inventory, reconcile, references, rewrite, scope, upsert

SF = ("0.001", "0.01")


@pytest.fixture(scope="module", params=SF)
def world(spark, request):
    folder = f"/root/testdata/sf{request.param}"
    return (
        SF.index(request.param), fx.source(spark, folder, True), fx.target(spark, folder, True),
        fx.tables(spark, folder, True),
    )


def by(df, column):
    return {r[0]: r[1] for r in df.groupBy(column).count().collect()}


def test_scope_and_caps(world):
    i, source, _, _ = world
    assert scope.scope_models(source.models).count() == (190, 1900)[i]
    assert scope.cap_versions(source.versions, 2).count() == (328, 3195)[i]
    assert scope.cap_runs(source.runs, 3).count() == (448, 4473)[i]
    assert scope.lifecycle(source.runs, False).count() == (1169, 11688)[i]


def test_references(world):
    i, source, _, _ = world
    states = by(references.version_states(source.versions, source.runs), "run_state")
    assert (states["READY"], states["NO_RUN"], states["BLOCKED"]) == ((377, 79, 64), (3496, 683, 608))[i]
    lost = by(references.dangling(source.versions, source.runs, source.experiments), "kind")
    assert (lost["version_run"], lost["run_experiment"]) == ((64, 5), (608, 44))[i]


def test_inventory(world):
    i, source, _, _ = world
    c = counts.run_counts(source.run_params, source.run_metrics, source.run_artifacts)
    assert c.agg(F.sum("model_files")).first()[0] == (129, 645)[i]
    every = inventory.inventory_summary(inventory.inventory(source, c, Options(), "t")).first()
    assert (every.ready, every.partial, every.blocked) == ((130, 48, 22), (1303, 463, 234))[i]
    models = scope.scope_models(source.models)
    scoped = source.with_tables(models=models, versions=scope.of_models(source.versions, models))
    rows = inventory.inventory(scoped, c, Options(), "t")
    names = ("source_versions", "source_versions_migratable", "source_versions_blocked", "source_experiments",
             "source_runs", "source_params", "source_metrics", "source_artifacts")
    sums = rows.agg(F.count(F.lit(1)), *[F.sum(n) for n in names]).first()
    assert tuple(sums) == (
        (190, 488, 429, 59, 349, 2948, 136, 264, 24),
        (1900, 4554, 3977, 577, 3325, 27960, 1435, 2519, 124),
    )[i]
    totals = inventory.inventory_summary(rows).first()
    assert (totals.ready, totals.partial, totals.blocked) == ((125, 44, 21), (1242, 439, 219))[i]


def test_migration(world):
    i, source, target, _ = world
    used = references.referenced_experiments(source.versions, source.runs, source.experiments)
    mapping = rewrite.experiment_map(used, target.experiments, Options().experiment_root, "", True)
    assert mapping.count() == (128, 1258)[i]
    assert mapping.select("target_name").distinct().count() == (117, 1158)[i]
    listed = scope.lifecycle(source.runs, False).join(used.select("experiment_id"), "experiment_id", "left_semi")
    wanted = rewrite.new_versions(source.versions, target.versions, source.host, "mig_", False)
    candidates = rewrite.candidate_runs(listed.select(*source.runs.columns), source.runs, wanted)
    mapped = rewrite.run_map(candidates, mapping, target.runs, source.host)
    assert mapped.where(F.col("target_run_id").isNotNull()).count() == (1076, 10482)[i]
    assert rewrite.new_runs(mapped).count() == (664, 6320)[i]
    assert rewrite.new_versions(source.versions, target.versions, source.host, "mig_", True).count() == (347, 3073)[i]
    assert rewrite.new_models(source.models, target.models, "mig_").count() == (40, 400)[i]
    history = rewrite.metric_history(mapped, source.run_metrics, source.metric_points)
    assert history.count() == (669, 6226)[i]


def test_reconciliation(world):
    i, source, target, t = world
    twice = target.versions.groupBy("model_name", "source_model_version").count()
    assert twice.where("count > 1 and source_model_version is not null").count() == (24, 284)[i]
    report = reconcile.reconcile(
        source, target, counts.run_counts(source.run_params, source.run_metrics, source.run_artifacts),
        counts.run_counts(target.run_params, target.run_metrics, target.run_artifacts), "mig_",
    )
    s = reconcile.report_summary(report).first()
    assert (s.migrated, s.run_deleted, s.no_artifacts, s.failed) == ((173, 143, 195, 9), (1714, 1291, 1744, 38))[i]
    assert s.migrated + s.run_deleted + s.no_artifacts + s.failed == s.total


def test_tracking(world):
    i, source, _, t = world
    assert upsert.pending(t["tracking_prev"], source.host).count() == (17, 167)[i]
    c = counts.run_counts(source.run_params, source.run_metrics, source.run_artifacts)
    rows = inventory.inventory(source, c, Options(), "t").select(*t["tracking_prev"].columns)
    assert upsert.merge_inventory(t["tracking_prev"], rows).count() == (220, 2200)[i]
    assert t["error_log"].where(is_retryable(F.col("status_code"), F.col("message"))).count() == (811, 8097)[i]
