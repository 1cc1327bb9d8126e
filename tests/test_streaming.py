"""The live tracking stream against the batch update."""

import itertools
import os

import pytest

from modelferry.operators import upsert
from modelferry.sources.tracking_store import TrackingStore
from modelferry.streaming import live_tracking
from tests import small

SCHEMA = "source_host string, model_name string, event_id bigint, event_ms bigint, target_versions int, migration_status string"
EVENTS = [
    ("h/", "a", 1, 100, 1, "PARTIAL"), ("h", "a", 2, 100, 2, "PARTIAL"), ("h", "a", 3, 90, 9, "FAILED"),
    ("h", "b", 4, 50, 1, "COMPLETED"), ("h", "nobody", 5, 60, 1, "COMPLETED"), ("h", "a", 2, 100, 2, "PARTIAL"),
]


def state(store):
    return sorted(tuple(r) for r in store.read_with_position().select(
        "model_name", "target_versions", "migration_status", "last_updated_at", "event_ms", "event_id").collect())


def start(spark, path):
    store = TrackingStore(spark, path)
    store.write(small.tracking(
        spark, {"source_host": "h", "model_name": "a", "migration_status": "PENDING", "migration_comments": "kept"},
        {"source_host": "h", "model_name": "b", "migration_status": "PENDING"}))
    return store


def run(spark, store, base, name):
    events = spark.readStream.schema(SCHEMA).json(f"{base}/{name}")
    live_tracking.track_stream(events, store, f"{base}/{name}-checkpoint").awaitTermination()


def test_any_split_gives_the_same_state(spark, folder):
    expected = None
    for number, size in enumerate((1, 2, 3, 6)):
        base, store = f"{folder}/{number}", start(spark, f"{folder}/{number}/tracking")
        chunks = [EVENTS[i:i + size] for i in range(0, len(EVENTS), size)]
        for chunk in chunks:
            spark.createDataFrame(chunk, SCHEMA).coalesce(1).write.mode("append").json(f"{base}/in")
        run(spark, store, base, "in")
        got = state(store)
        assert expected is None or got == expected
        expected = got
    assert [(r[0], r[1], r[2], r[4], r[5]) for r in expected] == [
        ("a", 2, "PARTIAL", 100, 2), ("b", 1, "COMPLETED", 50, 4)]


def test_order_and_repetition_do_not_matter(spark, folder):
    results = set()
    for number, order in enumerate(itertools.islice(itertools.permutations(EVENTS[:3]), 6)):
        tracking = start(spark, f"{folder}/{number}").read_with_position()
        for event in (*order, order[0]):
            tracking = live_tracking.apply_events(tracking, spark.createDataFrame([event], SCHEMA))
        results.add(repr(sorted(tracking.collect())))
    assert len(results) == 1 and "kept" in results.pop()


def test_stream_equals_batch(spark, folder):
    store = start(spark, f"{folder}/tracking")
    before = store.read_with_position()
    spark.createDataFrame(EVENTS, SCHEMA).write.json(f"{folder}/in")
    run(spark, store, folder, "in")
    latest = live_tracking.latest_outcomes(spark.createDataFrame(EVENTS, SCHEMA))
    batch = upsert.apply_outcomes(before, latest, target_columns=("target_versions", "migration_status"))
    pick = lambda df: sorted(map(tuple, df.select("model_name", "target_versions", "migration_status").collect()))
    assert pick(store.read()) == pick(batch)


def test_old_states_go_and_two_writers_cannot_share_a_number(spark, folder, monkeypatch):
    from modelferry.sources import tracking_store

    monkeypatch.setattr(tracking_store, "KEPT", 2)
    store = tracking_store.TrackingStore(spark, f"{folder}/t")
    store.create()
    for _ in range(4):
        store.update(lambda state: state)
    assert store._numbers() == [4, 5] and store.current() == 5
    monkeypatch.setattr(store, "_numbers", lambda: [4])
    monkeypatch.setattr(tracking_store.storage, "names", lambda spark, path: [])
    with pytest.raises(Exception, match="exist"):
        store.write(store.spark.createDataFrame([], store.schema))


def test_segments_follow_the_rows():
    from modelferry.operators.ranking import segment_levels

    assert [segment_levels(n) for n in (0, 10**6, 10**9, 10**12)] == [8, 8, 10, 16]


def folder_bytes(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def outcome(spark, *rows):
    return live_tracking.latest_outcomes(spark.createDataFrame(list(rows), SCHEMA))


def test_what_is_written_follows_the_batch(spark, folder, monkeypatch):
    from modelferry.sources import tracking_store

    monkeypatch.setattr(tracking_store, "MERGE_AFTER", 3)
    store = TrackingStore(spark, folder)
    store.write(small.tracking(spark, *[
        {"source_host": "h", "model_name": f"m{i}", "requirements": f"{i * i} a long text {i}" * 20} for i in range(2000)]))
    whole = folder_bytes(folder)
    plain = store.read_with_position()
    events = [("h", f"m{i % 5}", i, 100 - i, i, "PARTIAL") for i in range(12)] + [("h", "unknown", 50, 50, 1, "PARTIAL")]
    for event in events:
        store.append(outcome(spark, event))
        assert len(store.changes()) <= 4
    assert store.current() == 1 and folder_bytes(folder) - whole < whole / 2
    expected = live_tracking.apply_events(plain, spark.createDataFrame(events, SCHEMA))
    assert sorted(map(repr, store.read_with_position().collect())) == sorted(map(repr, expected.collect()))
    # Old changes go, the merged ones stay.
    assert len(store._numbers("change=")) < len(events)


def test_many_outcomes_go_into_the_table(spark, folder, monkeypatch):
    from modelferry.sources import tracking_store

    monkeypatch.setattr(tracking_store, "MERGE_AFTER", 2)
    store = start(spark, folder)
    before = store.read_with_position()
    for event in EVENTS:
        store.append(outcome(spark, event))
    assert store.current() > 1
    expected = live_tracking.apply_events(before, spark.createDataFrame(EVENTS, SCHEMA))
    assert sorted(map(repr, store.read_with_position().collect())) == sorted(map(repr, expected.collect()))


def test_a_broken_change_and_other_columns(spark, folder):
    store = start(spark, folder)
    store.append(outcome(spark, EVENTS[0]))
    os.makedirs(f"{folder}/change=00000009")  # never finished
    store.append(outcome(spark, EVENTS[1]).drop("target_versions"))
    row = store.read_with_position().where("model_name = 'a'").first()
    assert (row.target_versions, row.migration_status, row.event_id) == (1, "PARTIAL", 2)
    # A change of the table takes the logged outcomes along.
    store.update(lambda state: upsert.reset_status(state, "PARTIAL", "PENDING"))
    assert store.changes() == [] and store.read().where("model_name = 'a'").first().migration_status == "PENDING"
    with pytest.raises(FileNotFoundError):
        TrackingStore(spark, f"{folder}/nowhere").append(outcome(spark, EVENTS[0]))
