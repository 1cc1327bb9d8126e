"""Small registries for edge cases: tables as lists of dicts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from modelferry import Snapshot
from modelferry.schemas import TABLES, TRACKING
from modelferry.sources.registry import conformed

HOST = "https://source.example"


def table(spark: SparkSession, name: str, rows: list[dict]) -> DataFrame:
    schema = TABLES[name]
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


def registry(spark: SparkSession, host: str = HOST, **tables: list[dict]) -> Snapshot:
    made = {n: table(spark, n, tables.get(n, [])) for n in TABLES}
    made["models"] = conformed(made["models"], "models", host)
    return Snapshot(host=host, **made)


def tracking(spark: SparkSession, *rows: dict) -> DataFrame:
    return spark.createDataFrame([tuple(r.get(f.name) for f in TRACKING) for r in rows], TRACKING)


def plain(df: DataFrame) -> list[dict]:
    return [r.asDict() for r in df.collect()]


def sample_source(spark: SparkSession) -> Snapshot:
    """Two models; versions that are fine, without run, and with a lost run."""
    return registry(
        spark,
        models=[{"model_name": "m1", "description": "first", "creation_ms": 1_600_000_000_000},
                {"model_name": "m2"}, {"model_name": "cat.sch.m3"}],
        versions=[
            {"model_name": "m1", "version": 1, "run_id": "r1", "user_id": "ann", "stage": "Production",
             "source_uri": "dbfs:/x/r1/artifacts/model", "creation_ms": 1_600_000_000_000},
            {"model_name": "m1", "version": 2, "run_id": None, "user_id": "bob", "stage": "None"},
            {"model_name": "m1", "version": 3, "run_id": "gone", "user_id": "cy", "stage": None},
            {"model_name": "m2", "version": 1, "run_id": "r2", "user_id": None, "stage": "", "creation_ms": 0},
            {"model_name": "cat.sch.m3", "version": 1, "run_id": "r1"},
        ],
        experiments=[{"experiment_id": "e1", "name": "/Users/ann/exp/"}, {"experiment_id": "e2", "name": "/Users/bob/exp"}],
        runs=[
            {"run_id": "r1", "experiment_id": "e1", "run_user": "dan", "status": "FINISHED", "lifecycle": "active",
             "start_ms": 10, "end_ms": 20, "artifact_uri": "dbfs:/x/r1/artifacts"},
            {"run_id": "r2", "experiment_id": "e2", "status": "FINISHED", "lifecycle": "deleted", "start_ms": 30},
            {"run_id": "r3", "experiment_id": "e1", "status": "RUNNING", "lifecycle": "active", "start_ms": 40},
        ],
        run_params=[{"run_id": "r1", "key": "a", "value": "1"}, {"run_id": "r3", "key": "b", "value": "2"}],
        run_metrics=[{"run_id": "r1", "key": "loss", "value": 0.5}, {"run_id": "r1", "key": "acc", "value": 0.9},
                     {"run_id": "r3", "key": "acc", "value": 0.1}],
        metric_points=[{"run_id": "r1", "key": "loss", "value": 0.7, "ts_ms": 11, "step": 0},
                       {"run_id": "r1", "key": "loss", "value": 0.5, "ts_ms": 12, "step": 1},
                       {"run_id": "r1", "key": "orphan", "value": 9.0, "ts_ms": 12, "step": 1}],
        run_tags=[{"run_id": "r1", "key": "mlflow.runName", "value": "first run"},
                  {"run_id": "r1", "key": "source_run_id", "value": "stale"},
                  {"run_id": "r1", "key": "team", "value": "x"}],
        run_artifacts=[{"run_id": "r1", "path": "model/MLmodel", "size_bytes": 3},
                       {"run_id": "r1", "path": "model/data/m.bin", "size_bytes": 4},
                       {"run_id": "r1", "path": "plots/p.png", "size_bytes": 5},
                       {"run_id": "r1", "path": "  ", "size_bytes": 6},
                       {"run_id": "r2", "path": "model/MLmodel", "size_bytes": 3}],
        model_tags=[{"model_name": "m1", "key": "source_model_name", "value": "stale"},
                    {"model_name": "m1", "key": "mlflow.note", "value": "kept"}],
        version_tags=[{"model_name": "m1", "version": 1, "key": "source_model_version", "value": "stale"}],
        experiment_tags=[{"experiment_id": "e1", "key": "mlflow.ownerId", "value": "1"},
                         {"experiment_id": "e1", "key": "team", "value": "one"},
                         {"experiment_id": "e2", "key": "team", "value": "two"}],
    )
