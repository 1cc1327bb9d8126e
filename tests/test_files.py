"""Page files, artifact trees, registries and tracking states on disk."""

import json
import os
import threading
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from checks import queries
from modelferry import Options, session
from modelferry.operators import byte_bins, retries, rewrite, upsert
from modelferry.plans import batched, survey, transfer
from modelferry.schemas import RETRIES, TRACKING
from modelferry.sources import artifact_files, file_copy, pages, registry, reports, retry_queue
from modelferry.sources.tracking_store import TrackingStore, merge_statement
from tests import small

ITEM = StructType().add("name", "string")


def put(path, body):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as out:
        out.write(body)


def page(key, token, following, *names):
    return {"request_key": key, "page_token": token, "next_page_token": following, "items": [{"name": n} for n in names]}


def test_pages(spark, folder):
    saved = [
        page("a", None, "2", "x"), page("a", "2", "3", "y", "z"), page("a", "3", None, "w"),
        page("b", None, "2", "p"), page("b", "3", "", "q"),
        page("c", None, None, "s"), page("c", None, None, "s"),
        page("d", "2", None, "t"), page("e", None, "2", "u"), page("e", None, "3", "v"), page("e", "2", None), page("e", "3", None),
    ]
    put(f"{folder}/in/pages.json", "\n".join(map(json.dumps, saved)).encode())
    items, problems = pages.read_paged_extract(spark, f"{folder}/in", ITEM)
    got = sorted((r.request_key, r.name) for r in items.collect())
    # What lies behind a lost page, or has no first page, is not part of a listing.
    assert got[:6] == [("a", "w"), ("a", "x"), ("a", "y"), ("a", "z"), ("b", "p"), ("c", "s")]
    # Of two saved copies that differ, always the same one counts.
    assert got[6:] in ([("e", "u")], [("e", "v")])
    assert [(r.page_token, r.kind) for r in problems.where("request_key = 'e'").collect()] in ([("2", "orphan")], [("3", "orphan")])
    again = pages.read_paged_extract(spark, f"{folder}/in", ITEM)[0].repartition(3)
    assert sorted((r.request_key, r.name) for r in again.collect()) == got
    assert sorted((r.request_key, r.page_token or "", r.kind) for r in problems.where("request_key <> 'e'").collect()) == [
        ("b", "2", "missing"), ("b", "3", "orphan"), ("d", "", "missing"), ("d", "2", "orphan")]


@pytest.mark.parametrize("n", [1, 2, 7, 8, 33])
def test_tokens_are_followed_to_the_end(spark, folder, n):
    """A long listing; one that comes back to its third page; a circle nobody points to, with a tail; a tail of orphans."""
    def chain(key, start, count, last):
        names = [None if k == 0 and start is None else f"{start or 't'}{k}" for k in range(count)]
        return [page(key, t, f, f"{key}{t}") for t, f in zip(names, [*names[1:], last])]

    saved = chain("long", None, n, None) + chain("back", None, n + 3, "t2") + chain("circle", None, 2, None)
    saved += chain("circle", "c", n, "c0") + [page("circle", "x", "c0", "x")] + chain("circle", "o", n, "t1")
    put(f"{folder}/in/pages.json", "\n".join(map(json.dumps, saved)).encode())
    items, problems = pages.read_paged_extract(spark, f"{folder}/in", ITEM)
    of = {}
    for r in items.collect():
        of.setdefault(r.request_key, []).append(r.name)
    assert {k: len(v) for k, v in of.items()} == {"long": n, "back": n + 3, "circle": 2} and all(len(set(v)) == len(v) for v in of.values())
    expected = [("back", "t2", "loop"), ("circle", "x", "loop")]
    expected += [("circle", f"c{k}", "loop") for k in range(n)] + [("circle", f"o{k}", "orphan") for k in range(n)]
    assert sorted((r.request_key, r.page_token, r.kind) for r in problems.collect()) == sorted(expected)


@pytest.fixture
def tree(folder):
    root = f"{folder}/model"
    files = {
        "r1/artifacts/model/MLmodel": b"flavors:\n  sklearn: {}\n  python_function: {python_version: 3.11.2}\n",
        "r1/artifacts/model/requirements.txt": b"a==1\n# c\n\n  b==2 \n  # kept\n",
        "r1/artifacts/model/data/m.bin": bytes(range(256)) * 50000,
        "r1/artifacts/plots/p.png": b"png",
        "r1/artifacts/plots/a b#1%20.png": b"odd name",
        "r1/artifacts/other/MLmodel": b"flavors: {wrong: {}}\n",
        "r2/artifacts/model/MLmodel": b"flavors: [\n",
    }
    for path, body in files.items():
        put(f"{root}/{path}", body)
    return root, files


def test_listing_reads_no_contents(spark, tree):
    root, files = tree
    listed = artifact_files.list_artifacts(spark, root)
    assert {(r.run_id, r.path, r.size_bytes) for r in listed.collect()} == {
        (p.split("/")[0], p.split("/artifacts/")[1], len(b)) for p, b in files.items()}
    assert "binaryFile" not in listed._jdf.queryExecution().executedPlan().toString()


def test_every_name_is_listed(spark, folder):
    names = ["model/MLmodel", "model/code/pkg/__init__.py", "model/code/pkg/a.py", "model/.cfg", "_x/y", "artifacts/z", "a b/é"]
    for name in names:
        path = f"{folder}/e/r1/artifacts/{name}"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as out:
            out.write(name)
    with open(f"{folder}/e/r1/artifacts/{artifact_files.PARTIAL}part-1.x", "w") as out:
        out.write("left over")
    for root in (folder, f"file://{folder}/"):
        listed = artifact_files.list_artifacts(spark, root).collect()
        assert sorted((r.run_id, r.path, r.size_bytes) for r in listed) == sorted(("e/r1", n, len(n.encode())) for n in names)


@pytest.mark.parametrize("address", ["dbfs:/moved/1/x", "moved/1/x", "artifacts", "ftp://a/b", "s3:/x", "file:x"])
def test_addresses_that_would_land_elsewhere_are_refused(address):
    with pytest.raises(ValueError):
        artifact_files.locate(address)


def test_bins_are_even_whatever_the_sizes(spark):
    """Files of one byte, of none, of unknown size, and of many bins."""
    sizes = [1] * 300 + [None, 0] + [10**6] * 40 + [64 * 10**6, 9 * 10**6 + 1, 10**9 + 7]
    files = spark.createDataFrame([(f"t{i:04d}", n) for i, n in enumerate(sizes)], "target_address string, size_bytes long").repartition(7)
    ranges = byte_bins.byte_ranges(files, 10**6)
    of_file = {}
    for r in ranges.collect():
        of_file.setdefault(r.target_address, []).append((r.range_no, r.range_start, r.range_length, r.n_ranges))
    for i, n in enumerate(sizes):
        got = sorted(of_file[f"t{i:04d}"])
        assert [g[0] for g in got] == list(range(got[0][3])) and sum(g[2] for g in got) == (n or 0)
        assert all(a[1] + a[2] == b[1] for a, b in zip(got, got[1:])) and max(g[2] for g in got) <= 10**6
    for cost in (0, 1000):
        placed, n = byte_bins.byte_bins(ranges, [F.col("target_address"), F.col("range_no")], 4 * 10**6, cost)
        weights = {r.bin: r.w for r in placed.groupBy("bin").agg(F.sum(F.col("range_length") + cost).alias("w")).collect()}
        total = sum(weights.values())
        assert n == -(-total // (4 * 10**6)) and set(weights) == set(range(n)) and max(weights.values()) < 2 * total / n
    assert byte_bins.byte_bins(ranges.where("false"), [F.col("target_address")], 10)[1] == 1


def test_each_bin_is_a_task(spark, folder):
    manifest = spark.createDataFrame(
        [(f"{folder}/none{i}", f"{folder}/to{i}", 1000 * i) for i in range(60)], "source_address string, target_address string, size_bytes long")
    ranges, n = file_copy.dealt(manifest, bin_bytes=200_000, range_bytes=50_000)
    held = ranges.repartitionById(n, "bin").groupBy(F.spark_partition_id().alias("task")).agg(F.collect_set("bin").alias("bins")).collect()
    assert n > 5 and len(held) == n and all(len(r.bins) == 1 for r in held)


@pytest.mark.parametrize("in_place", [True, False])
def test_a_broken_range_is_copied_alone(folder, monkeypatch, in_place):
    monkeypatch.setattr(file_copy, "_in_place", lambda system: in_place)
    body = bytes(range(256)) * 400
    put(f"{folder}/a.gz", body)
    source, target, step = f"{folder}/a.gz", f"{folder}/new/a.gz", 30_000
    n = -(-len(body) // step)
    copied, stream = [], file_copy._stream

    def watched(reader, write, most=None):
        if most is not None:  # a range, not the joining of parts
            copied.append(reader.tell())
            if reader.tell() == broken:
                raise OSError("connection lost")
        return stream(reader, write, most)

    monkeypatch.setattr(file_copy, "_stream", watched)

    def round_():
        copied.clear()
        return [file_copy.with_retry(lambda k=k: file_copy.copy_range(source, target, k, n, k * step, step, step, "t"), 0.0) for k in range(n)]

    broken = 2 * step
    first = round_()
    assert [r[0] for r in first] == [True, True, False, True] and len(copied) == n
    with pytest.raises(OSError):
        file_copy.join_ranges(source, target, n, step, "t")
    assert not os.path.exists(target)
    broken = None
    assert all(r[0] for r in round_()) and copied == [2 * step]
    assert file_copy.join_ranges(source, target, n, step, "t") == len(body)
    assert open(target, "rb").read() == body
    # Nothing is left beside it, and a finished file is left alone.
    assert [f for f in os.listdir(f"{folder}/new") if f != "a.gz" and not f.startswith(file_copy.PARTIAL)] == []
    assert not [f for f in os.listdir(f"{folder}/new") if f.startswith(file_copy.PARTIAL)]
    assert sum(r[1] for r in round_()) == len(body) and copied == []


def test_ranges_of_a_changed_source_do_not_count(folder):
    put(f"{folder}/a", b"x" * 1000)
    args = (f"{folder}/a", f"{folder}/b")
    for k in range(3):
        file_copy.copy_range(*args, k, 4, k * 250, 250, 250, "t")
    put(f"{folder}/a", b"y" * 1000)
    os.utime(f"{folder}/a", ns=(5, 5))
    file_copy.copy_range(*args, 3, 4, 750, 250, 250, "t")
    with pytest.raises(OSError, match="lacks ranges"):
        file_copy.join_ranges(*args, 4, 250, "t")


def test_large_and_small_files_arrive(spark, folder):
    sizes = {"empty": 0, "one": 1, "small.gz": 999, "even": 4096, "large.bz2": 70_001, "wrong size": 50_000, "unknown": 30_000}
    for name, n in sizes.items():
        put(f"{folder}/in/{name}", os.urandom(n))
    told = {**sizes, "wrong size": 9_000, "unknown": None}
    rows = [(name, told[name], f"{folder}/in/{name}", f"{folder}/out/x/{name}") for name in sizes]
    rows.append(("lost", 50_000, f"{folder}/in/lost", f"{folder}/out/lost"))
    manifest = spark.createDataFrame(rows, "path string, size_bytes long, source_address string, target_address string")
    got = {r.path: r for r in file_copy.copy_artifacts(manifest, 3, bin_bytes=16_384, range_bytes=4_096).collect()}
    assert set(got) == {*sizes, "lost"} and not got["lost"].ok and got["lost"].error
    for name, n in sizes.items():
        assert (got[name].ok, got[name].bytes) == (True, n), name
        assert open(f"{folder}/out/x/{name}", "rb").read() == open(f"{folder}/in/{name}", "rb").read()
    assert sorted(os.listdir(f"{folder}/out/x")) == sorted(sizes)


def test_subtrees_are_given_back_beyond_the_budget():
    tree = {"r": [("r/a", True, 0), ("r/f", False, 1)], "r/a": [("r/a/b", True, 0)], "r/a/b": [("r/a/b/g", False, 2)]}
    walk = artifact_files.walk
    assert list(walk("r", tree.get, 10, 100)) == [("r/f", False, 1), ("r/a/b/g", False, 2)]
    assert list(walk("r", tree.get, 2, 100)) == [("r/f", False, 1), ("r/a/b", True, 0)]
    assert list(walk("r", tree.get, 10, 2)) == [("r/f", False, 1), ("r/a", True, 0)]


def test_rounds_do_not_grow_with_depth(spark, folder, monkeypatch):
    rounds, walked = [], artifact_files._walked
    monkeypatch.setattr(artifact_files, "_walked", lambda df: rounds.append(1) or walked(df))
    deep = "/".join(["d"] * 60)
    put(f"{folder}/r1/artifacts/{deep}/end", b"x")
    put(f"{folder}/r2/artifacts/top", b"y")
    got = sorted((r.run_id, r.path) for r in artifact_files.list_artifacts(spark, folder).collect())
    assert got == [("r1", f"{deep}/end"), ("r2", "top")] and len(rounds) == 1


def test_a_finished_target_is_not_copied_again(folder):
    for name, body in (("a", b"12345"), ("b", b"xxxxx"), ("c", b"xx")):
        with open(f"{folder}/{name}", "wb") as out:
            out.write(body)
    assert file_copy.copy_file(f"{folder}/a", f"{folder}/b", "t") == 5
    assert open(f"{folder}/b", "rb").read() == b"xxxxx"
    assert file_copy.copy_file(f"{folder}/a", f"{folder}/c", "t") == 5
    assert open(f"{folder}/c", "rb").read() == b"12345"


def test_metadata_of_model_folders(spark, tree):
    got = {r.run_id: r for r in artifact_files.read_metadata(spark, tree[0]).collect()}
    assert (got["r1"].flavors, got["r1"].python_version) == ("sklearn, python_function", "3.11.2")
    assert got["r1"].requirements == "a==1; b==2; # kept"
    assert got["r2"].flavors is None and got["r2"].requirements is None


def test_copy_isolates_failures(spark, tree, folder):
    root, files = tree
    manifest = artifact_files.list_artifacts(spark, root).select(
        "run_id", "path", "size_bytes", F.col("address").alias("source_address"),
        F.concat_ws("/", F.lit(f"{folder}/dst"), "run_id", "path").alias("target_address"),
    )
    lost = manifest.limit(1).withColumns({
        "source_address": F.lit(f"{root}/nowhere"), "target_address": F.lit(f"{folder}/dst/nowhere"), "path": F.lit("lost")})
    log = f"{folder}/log"
    file_copy.copy_artifacts(manifest.unionByName(lost), 3).write.parquet(log)
    done = {(r.run_id, r.path): r for r in spark.read.parquet(log).collect()}
    bad = [r for r in done.values() if not r.ok]
    assert [r.path for r in bad] == ["lost"] and bad[0].bytes == 0 and bad[0].error
    for path, body in files.items():
        run, inside = path.split("/artifacts/")
        assert done[run, inside].bytes == len(body)
        with open(f"{folder}/dst/{run}/{inside}", "rb") as copy:
            assert copy.read() == body
    left = [f for _, _, names in os.walk(f"{folder}/dst") for f in names if f.startswith(artifact_files.PARTIAL)]
    assert left == []


@pytest.mark.parametrize("error, tries", [
    (FileNotFoundError("Failed to open local file '/in/429/artifacts/a'"), 1),
    (OSError("When reading 'in/503/artifacts/a': AccessDenied"), 1),
    (OSError("When reading 'in/503/artifacts/a': HTTP 429"), 6),
    (OSError("When writing '/to/429/a': TEMPORARILY_UNAVAILABLE"), 6),
])
def test_numbers_in_addresses_do_not_ask_for_another_attempt(error, tries):
    seen = []

    def broken():
        seen.append(1)
        raise error

    ok, _, message = file_copy.with_retry(broken, 0.0, "s3://in/503/artifacts/a", "/to/429/a")
    assert (ok, message, len(seen)) == (False, str(error), tries)


def test_retryable_failures_are_tried_again():
    seen = []

    def flaky():
        seen.append(1)
        if len(seen) < 3:
            raise OSError("HTTP 503")
        return 7

    assert file_copy.with_retry(flaky, patience=0.0) == (True, 7, None)

    def broken():
        seen.append(1)
        raise OSError("Too Many Requests")

    seen.clear()
    assert file_copy.with_retry(broken, patience=0.0)[0] is False and len(seen) == 6


def test_a_source_must_have_its_tables(spark, folder):
    with pytest.raises(FileNotFoundError):
        registry.read_registry(spark, f"{folder}/nowhere", "h")
    assert registry.read_registry(spark, f"{folder}/nowhere", "h", may_be_new=True).models.count() == 0
    source = small.sample_source(spark)
    for name in ("models", "versions"):
        registry.conformed(getattr(source, name), name).write.parquet(f"{folder}/part/{name}")
    for may in (False, True):
        with pytest.raises(FileNotFoundError, match="runs"):
            registry.read_registry(spark, f"{folder}/part", "h", may_be_new=may)


def test_a_migrated_target_can_be_a_source(spark, folder):
    from modelferry.plans import survey

    options = Options(artifact_root=f"{folder}/m")
    transfer.migrate_all(small.sample_source(spark), f"{folder}/t", "https://t", options, "c", copy_files=False)
    back = registry.read_registry(spark, f"{folder}/t", "https://t/")
    row = {r.model_name: r for r in survey.inventory_report(back, options, "https://next").collect()}["m1"]
    assert (row.source_host, row.source_versions_migratable, row.source_runs) == ("https://t", 1, 3)
    assert {r.lifecycle for r in back.runs.collect()} == {"active"}
    assert all(r.creation_ms for r in back.versions.collect()) and {r.user_id for r in back.versions.collect()} >= {"ann"}


def test_no_local_staging_on_a_cluster(spark, monkeypatch):
    from modelferry import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())


def test_registry_round_trip_and_commits(spark, folder):
    source, path = small.sample_source(spark), f"{folder}/reg"
    tables = {n: getattr(source, n) for n in registry.WRITE_ORDER}
    registry.write_registry(tables, path, small.HOST + "/", "c1")
    # An attempt that never finished leaves files, but no commit.
    registry.conformed(source.runs, "runs", small.HOST).write.parquet(f"{path}/runs/commit=c2")
    back = registry.read_registry(spark, path, small.HOST + "/")
    for name in tables:
        expected = registry.conformed(getattr(source, name), name, small.HOST)
        assert sorted(map(repr, getattr(back, name).collect())) == sorted(map(repr, expected.collect()))
    with pytest.raises(ValueError):
        registry.write_registry(tables, path, small.HOST, "c1")
    registry.write_registry({"runs": source.runs}, path, small.HOST, "c2")
    assert registry.read_registry(spark, path, small.HOST).runs.count() == 6


def test_plain_snapshots_in_json(spark, folder):
    for name in registry.REQUIRED:
        rows = [{"model_name": "m", "version": 1, "run_id": ""}] if name == "versions" else []
        small.table(spark, name, rows).write.json(f"{folder}/{name}")
    back = registry.read_registry(spark, folder, small.HOST, "json")
    assert back.versions.first().run_id is None and back.runs.count() == 0


def test_tracking_states(spark, folder):
    store = TrackingStore(spark, f"{folder}/t")
    with pytest.raises(FileNotFoundError):
        store.read()
    store.create()
    store.create()
    assert store.current() == 1 and store.read().schema.fieldNames() == TRACKING.fieldNames()
    store.update(lambda t: upsert.merge_inventory(t, small.tracking(spark, {"source_host": "h", "model_name": "m"})))
    # A state without success mark is not there for readers.
    os.makedirs(f"{folder}/t/state=00000003")
    assert store.current() == 2 and store.read().count() == 1
    store.update(lambda t: upsert.reset_status(t))
    assert store.current() == 4


def test_merge_statement_names_all_source_columns():
    text = merge_statement("t1", "s1")
    assert text.count(" = s.") == 2 + 20 and "INSERT *" in text and "migration_status" not in text


def test_reports(spark, folder):
    df = spark.createDataFrame([("a,\"b", 1)], "name string, n int")
    for fmt in reports.FORMATS:
        reports.write_report(df, f"{folder}/{fmt}", fmt)
        back = spark.read.schema(df.schema).format(fmt).option("header", True).option("escape", '"').load(f"{folder}/{fmt}")
        assert [tuple(r) for r in back.collect()] == [("a,\"b", 1)]
    with pytest.raises(ValueError):
        reports.write_report(df, folder, "delta")


def test_whole_migration_with_files(spark, folder):
    """Files on disk, one of them missing: its version fails, the others arrive."""
    home = f"{folder}/source"
    put(f"{home}/r1/artifacts/model/MLmodel", b"abc")
    put(f"{home}/r1/artifacts/plots/p.png", b"png")
    source = small.registry(
        spark, models=[{"model_name": "ok"}, {"model_name": "broken"}],
        versions=[{"model_name": "ok", "version": 1, "run_id": "r1"}, {"model_name": "broken", "version": 1, "run_id": "r2"}],
        experiments=[{"experiment_id": "e", "name": "/x/e"}],
        runs=[{"run_id": r, "experiment_id": "e", "lifecycle": "active", "artifact_uri": f"{home}/{r}/artifacts"} for r in ("r1", "r2")],
        run_artifacts=[{"run_id": "r1", "path": "model/MLmodel", "size_bytes": 3}, {"run_id": "r1", "path": "plots/p.png", "size_bytes": 3},
                       {"run_id": "r2", "path": "model/MLmodel", "size_bytes": 3}],
    )
    options = Options(skip_existing_versions=True, artifact_root=f"{folder}/moved")
    store = TrackingStore(spark, f"{folder}/tracking")
    survey.track_inventory(survey.inventory_report(source, options, "https://t"), store)
    done = transfer.migrate_pending(source, f"{folder}/target", "https://t", options, store, "c1").first()
    assert (done.migrated_models, done.migrated_model_versions, done.migrated_experiments) == (2, 1, 1)
    state = {r.model_name: r for r in store.read().collect()}
    assert state["ok"].migration_status == "COMPLETED" and state["ok"].target_artifacts == 1
    assert state["broken"].migration_status == "FAILED" and "r2" in state["broken"].migration_comments
    target = registry.read_registry(spark, f"{folder}/target", "https://t")
    made = target.versions.first()
    with open(f"{made.source_uri}/MLmodel", "rb") as copy:
        assert copy.read() == b"abc"
    again = transfer.migrate_pending(source, f"{folder}/target", "https://t", options, store, "c2").first()
    assert tuple(again) == (0, 0, 0, 0, 0)
    # Reopened, only what is missing is tried.
    store.update(lambda t: upsert.reset_status(t))
    put(f"{home}/r2/artifacts/model/MLmodel", b"xyz")
    third = transfer.migrate_pending(source, f"{folder}/target", "https://t", options, store, "c3").first()
    assert third.migrated_model_versions == 1
    assert {r.migration_status for r in store.read().collect()} == {"COMPLETED"}
    ids = [r.run_id for r in registry.read_registry(spark, f"{folder}/target", "https://t").runs.collect()]
    assert len(ids) == len(set(ids)) == 2


def test_second_migration_creates_nothing(spark, folder):
    source, path = small.sample_source(spark), f"{folder}/target"
    options = Options(skip_existing_versions=True)
    first = transfer.migrate_all(source, path, "t", options, "c1", copy_files=False)
    assert first.created_versions.count() == 2 and first.failures.count() == 2
    second = transfer.migrate_all(source, path, "t", options, "c2", copy_files=False)
    assert second.created_versions.count() == 0 and second.copied.count() == 0
    for name in ("runs", "run_params", "metric_points", "experiments", "models"):
        part = spark.read.parquet(f"{path}/{name}/commit=c2")
        assert part.count() == 0, name
    report = transfer.reconciliation(source, registry.read_registry(spark, path, "t"), options)
    assert {(r.source_model, r.version): r.status for r in report.collect()} == {
        ("m1", 1): "✅ MIGRATED", ("m1", 2): "❌ RUN_DELETED", ("m1", 3): "❌ RUN_DELETED", ("m2", 1): "✅ MIGRATED"}
    assert all(r.params_match and r.metrics_match and r.artifacts_match for r in report.where("target_params is not null").collect())


def test_versions_are_numbered_after_existing_ones(spark):
    source = small.sample_source(spark)
    target = small.registry(spark, versions=[{"model_name": "m1", "version": 41}])
    plan = transfer.plan_transfer(source, target, Options())
    made = rewrite.target_versions(plan.judged(), target.versions, source.host)
    assert {(r.model_name, r.version) for r in made.collect()} == {("m1", 42), ("m2", 1)}


def test_batches_commit_one_after_the_other(spark, folder):
    source = small.sample_source(spark)
    options = Options(skip_existing_versions=True, batch_size=1)
    store = TrackingStore(spark, f"{folder}/tracking")
    survey.track_inventory(survey.inventory_report(source, options, "t"), store)
    done = batched.migrate_pending_in_batches(source, f"{folder}/target", "t", options, store, "b", copy_files=False).first()
    assert done.migrated_models == 2 and done.migrated_model_versions == 2
    assert registry.committed(spark, f"{folder}/target") == ["b-000000", "b-000001"]
    assert {r.model_name: r.migration_status for r in store.read().collect()} == {"m1": "PARTIAL", "m2": "COMPLETED"}


def test_source_tables_are_read_as_often_for_any_number_of_batches(spark, folder):
    """Rows that leave each source table, counted while one and while two batches are committed."""
    def counted(name, df):
        total = spark.sparkContext.accumulator(0)
        totals[name] = total

        def run(batches):
            for batch in batches:
                total.add(batch.num_rows)
                yield batch

        return df.mapInArrow(run, df.schema)

    read = []
    for size in (1, 2):
        totals, base = {}, small.sample_source(spark)
        source = base.with_tables(**{n: counted(n, getattr(base, n)) for n in registry.WRITE_ORDER})
        options = Options(skip_existing_versions=True, batch_size=size)
        store = TrackingStore(spark, f"{folder}/tracking{size}")
        survey.track_inventory(survey.inventory_report(base, options, "t"), store)
        batched.migrate_pending_in_batches(source, f"{folder}/target{size}", "t", options, store, "b", copy_files=False).collect()
        assert len(registry.committed(spark, f"{folder}/target{size}")) == 3 - size
        read.append({n: t.value for n, t in totals.items()})
    assert read[0] == read[1] and min(read[0].values()) > 0
    a, b = (registry.read_registry(spark, f"{folder}/target{size}", "t") for size in (1, 2))
    for name in registry.WRITE_ORDER:
        rows = [sorted(map(repr, getattr(r, name).drop("creation_ms").collect())) for r in (a, b)]
        assert rows[0] == rows[1], name


def test_a_commit_that_is_not_what_was_written_fails(spark, folder, monkeypatch):
    source = small.sample_source(spark)
    real = registry._checked

    def damaged(table, rows, write, back):
        real(table, rows, write, (lambda: back().limit(1)) if table == "runs" else back)

    monkeypatch.setattr(registry, "_checked", damaged)
    with pytest.raises(OSError, match="runs: 1 rows in the files, 3 were written"):
        registry.write_registry({"runs": source.runs, "models": source.models}, folder, small.HOST, "c")
    assert registry.committed(spark, folder) == []
    changed = source.runs.withColumn("status", F.lit("other"))
    with pytest.raises(OSError, match="content differs"):
        real("runs", registry.conformed(source.runs, "runs"), lambda df: df.count(), lambda: registry.conformed(changed, "runs"))
    real("runs", registry.conformed(source.runs, "runs"), lambda df: df.count(), lambda: registry.conformed(source.runs.repartition(3), "runs"))


def test_failed_files_wait_longer_and_are_given_up(spark):
    at = lambda seconds: F.timestamp_millis(F.lit(seconds * 1000))
    copied = spark.createDataFrame(
        [("r", "t", "a", None, 3, "s/a", "d/a", False, "HTTP 503"), ("r", "t", "b", None, 3, "s/b", "d/b", True, None)],
        "run_id string, target_run_id string, path string, parent string, size_bytes long, source_address string, target_address string, ok boolean, error string")
    nothing = spark.createDataFrame([], "run_id string, path string")
    queue, waits = spark.createDataFrame([], RETRIES), []
    manifest = copied.drop("ok", "error")
    for _ in range(7):
        queue = spark.createDataFrame(retries.next_queue(queue, copied, nothing, at(0)).collect(), RETRIES)
        row = queue.first()
        waits.append((row.path, row.attempts, row.next_ms))
    assert waits == [("a", n + 1, ms) for n, ms in enumerate([2000, 4500, 9000, 17500, 34000, None, None])]
    first = spark.createDataFrame([("r", "t", "a", None, 3, "s/a", "d/a", 1, 2000, "x")], RETRIES)
    none = manifest.where("false")
    assert retries.with_due(none, first, nothing, at(1)).count() == 0 and retries.with_due(none, first, nothing, at(2)).count() == 1
    assert retries.with_due(manifest, first, nothing, at(2)).count() == 2
    held = spark.createDataFrame([("t", "a")], "run_id string, path string")
    assert retries.with_due(none, first, held, at(2)).count() == 0
    assert retries.next_queue(first, copied.where("false"), held, at(2)).count() == 0
    assert retries.next_queue(first, copied.where("false"), nothing, at(2)).collect() == first.collect()


def test_batches_copy_files_and_queue_lost_ones(spark, folder):
    home = f"{folder}/source"
    put(f"{home}/r1/artifacts/model/MLmodel", b"abc")
    put(f"{home}/r2/artifacts/model/MLmodel", b"xy")
    files = [("r1", "model/MLmodel", 3), ("r1", "plots/p.png", 3), ("r2", "model/MLmodel", 2)]
    source = small.registry(
        spark, models=[{"model_name": "a"}, {"model_name": "b"}],
        versions=[{"model_name": "a", "version": 1, "run_id": "r1"}, {"model_name": "b", "version": 1, "run_id": "r1"},
                  {"model_name": "b", "version": 2, "run_id": "r2"}],
        experiments=[{"experiment_id": "e", "name": "/x/e"}],
        runs=[{"run_id": r, "experiment_id": "e", "lifecycle": "active", "artifact_uri": f"{home}/{r}/artifacts"} for r in ("r1", "r2")],
        run_artifacts=[{"run_id": r, "path": p, "size_bytes": n} for r, p, n in files],
    )
    options = Options(skip_existing_versions=True, artifact_root=f"{folder}/moved", batch_size=1)
    store = TrackingStore(spark, f"{folder}/tracking")
    survey.track_inventory(survey.inventory_report(source, options, "https://t"), store)
    done = batched.migrate_pending_in_batches(source, f"{folder}/target", "https://t", options, store, "b").first()
    assert (done.migrated_models, done.migrated_model_versions, done.distinct_runs) == (2, 3, 3)
    target = registry.read_registry(spark, f"{folder}/target", "https://t")
    assert sorted(r.path for r in target.run_artifacts.collect()) == ["model/MLmodel", "model/MLmodel"]
    assert {r.migration_status for r in store.read().collect()} == {"COMPLETED"}
    assert [r.path for r in retry_queue.read_queue(spark, f"{folder}/target").collect()] == ["plots/p.png"]
    # Nothing waits any more but the file, which is tried when it is due.
    put(f"{home}/r1/artifacts/plots/p.png", b"png")
    later = F.timestamp_millis(F.lit(4_000_000_000_000))
    batched.migrate_pending_in_batches(source, f"{folder}/target", "https://t", options, store, "c", now=later)
    target = registry.read_registry(spark, f"{folder}/target", "https://t")
    assert target.run_artifacts.count() == 3 and retry_queue.read_queue(spark, f"{folder}/target").count() == 0


def test_jobs_leave_only_their_results_in_the_shared_folder(spark, folder, monkeypatch):
    shared = session.shared_folder(spark)
    source, options = small.sample_source(spark), Options(skip_existing_versions=True, batch_size=1)
    spark.createDataFrame([(1,)], "a int").count()

    def left(job):
        before = set(os.listdir(shared))
        result = job()
        return result, sorted(n.rpartition("-")[0] for n in set(os.listdir(shared)) - before)

    done, names = left(lambda: transfer.migrate_all(source, f"{folder}/all", "t", options, "c", copy_files=False))
    assert names == ["copied", "created", "failures", "run-failures", "summary"]
    assert done.created_versions.count() == 2 and done.failures.count() == 2 and done.copied.count() > 0
    assert done.run_failures.count() == done.file_failures.count() == 0 and done.summary.count() == 1
    for job, path in ((transfer.migrate_pending, "pending"), (batched.migrate_pending_in_batches, "batches")):
        store = TrackingStore(spark, f"{folder}/tracking-{path}")
        survey.track_inventory(survey.inventory_report(source, options, "t"), store)
        for commit in ("one", "two"):  # the second finds nothing to do
            done, names = left(lambda: job(source, f"{folder}/{path}", "t", options, store, commit, copy_files=False))
            assert names == ["summary"] and done.first().migrated_models == (2 if commit == "one" else 0)

    def broken(*_):
        raise OSError("no space")

    monkeypatch.setattr(transfer, "write_registry", broken)

    def failing():
        with pytest.raises(OSError, match="no space"):
            transfer.migrate_all(source, f"{folder}/broken", "t", options, "c", copy_files=False)

    assert left(failing)[1] == []


def test_a_cleared_block_is_of_its_thread(spark):
    other, rows = [], spark.range(3)

    def elsewhere():
        other.append(session.written(rows, "other"))

    with session.cleared(spark):
        gone = session.written(rows, "gone")
        with session.cleared(spark):
            stays = session.kept(rows, "inner")
        assert gone.count() == stays.count() == 3
        result = session.kept(stays, "outer")
        thread = threading.Thread(target=elsewhere)
        thread.start()
        thread.join()
    assert result.count() == other[0].count() == 3
    for df in (gone, stays):
        with pytest.raises(Exception, match="(?i)not.*exist"):
            df.count()


def test_joined_files_are_written_row_by_row(spark, folder):
    """Python gets a row by text; files hold the texts in order, without the null ones."""
    from checks.queries import write_joined

    rows = [("a", 3, "z"), ("a", 1, ""), ("a", 2, None), ("a", 1, "y"), ("b", 1, None), ("c", 2, ""), ("c", 1, ""), ("d", None, "n"), ("d", 0, "\u00e9")]
    texts = spark.createDataFrame([(f"{folder}/x/{a}", n, t) for a, n, t in rows], "address string, doc_id long, text string")
    assert write_joined(texts, ["doc_id", "text"]) == len(rows)
    plain = texts.groupBy("address").agg(F.sort_array(F.collect_list(F.struct("doc_id", "text"))).alias("held")).select(
        "address", F.array_join("held.text", "\n").alias("text"))
    for row in plain.collect():
        with open(row.address, encoding="utf-8", newline="") as file:
            assert file.read() == row.text, row.address


def _shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for k in range(found.size()) if (name := found.apply(k).getName()).startswith("shuffle_")}


def _settled(look, done, seconds=20):
    """What ``look`` gives once ``done``; files are removed a little after the write."""
    ends = time.time() + seconds
    while not done(found := look()) and time.time() < ends:
        time.sleep(0.1)
    return found


def test_what_is_staged_leaves_no_shuffle_files(spark, folder):
    before = spark.conf.get(session.SHUFFLES_SETTING)
    rows = spark.range(5000).withColumn("k", F.col("id") % 701)
    sums = rows.join(rows.groupBy("k").agg(F.sum("id").alias("total")).hint("shuffle_merge"), "k").groupBy("total").count()
    there = _shuffle_files(spark)
    staged = session.written(sums, "sums")
    assert not _settled(lambda: _shuffle_files(spark) - there, lambda left: not left)
    records = {"models": sums.select(F.col("total").cast("string").alias("model_name"))}
    registry.write_registry(records, f"{folder}/registry", small.HOST, "one")
    retry_queue.write_queue(spark.createDataFrame([], RETRIES).repartition(3, "path"), f"{folder}/registry")
    assert not _settled(lambda: _shuffle_files(spark) - there, lambda left: not left)
    # The plan can be used again, and the setting is as it was.
    assert sorted(staged.collect()) == sorted(sums.collect()) == sorted(session.written(sums, "again").collect())
    assert spark.conf.get(session.SHUFFLES_SETTING) == before
    with pytest.raises(ValueError), session.shuffles_dropped(spark):
        raise ValueError
    assert spark.conf.get(session.SHUFFLES_SETTING) == before


def test_files_are_copied_in_rounds(spark, folder, monkeypatch):
    """No round's files wait for the next, a run is in one round, and every file of every text is copied."""
    ids = [*range(47), *range(60, 200, 3)]
    texts = {n: "é" * (n % 5) + "x" * n for n in ids}
    spark.createDataFrame(
        [(n, texts[n], "en", f"s{n % 3}", len(texts[n])) for n in ids], "doc_id long, text string, lang string, source string, n_chars long"
    ).write.parquet(f"{folder}/documents.parquet")
    places, rounds, write = [], [], queries.write_texts

    def path_of(spark, name, make=queries.scratch_path):
        places.append(make(spark, name))
        return places[-1]

    def noted(files):
        assert not any(os.path.exists(p) for p in places if "/tree-" in p or "/moved-" in p)
        rounds.append({r.address.split("/artifacts/")[0].rsplit("/", 1)[1] for r in files.collect()})
        return write(files)

    monkeypatch.setattr(queries, "FILES_AT_ONCE", 20)
    monkeypatch.setattr(queries, "write_texts", noted)
    monkeypatch.setattr(queries, "scratch_path", path_of)
    got = sorted(tuple(r) for r in queries.all_queries()["artifact_copy"](spark, folder).collect())
    name = {0: "model/MLmodel", 1: "model/code/pkg/__init__.py", 3: "model/MLmodel", 4: "model/.cfg"}
    assert got == sorted(
        (str(n // 3), name.get(n % 6, f"plots/_a/b/s{n % 3}.png"), True, size, size) for n in ids for size in [len(texts[n].encode())])
    assert len(rounds) == 5 and sum(len(r) for r in rounds) == len(set().union(*rounds)) == len({n // 3 for n in ids})
    assert not any(os.path.exists(p) for p in places if "/tree-" in p or "/moved-" in p)
