"""A model registry made from the driver tables, in SQL that Spark and DuckDB share.

Views follow FIXTURES.md with one difference: every source table is used whole.
Runs and experiments that FIXTURES.md leaves out are kept under an id nobody
refers to, and all order lines become versions. ``PUBLISHED`` holds the three
views as FIXTURES.md gives them, for tests of the figures printed there. The
last views add columns that the operators read and the driver tables lack.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from modelferry.schemas import Snapshot
from modelferry.session import written

SOURCE_HOST = "https://adb-1001.1.example.net"
TARGET_HOST = "https://adb-3003.3.example.net/"
# When the transfers of the checks say that they ran.
COMMIT_MS = 1_700_000_000_000

# Written out once: a window makes it, which every later reader would repeat.
STORED = ("versions",)

DRIVER_TABLES = ("part", "lineitem", "orders", "customer", "events", "documents")

VIEWS: dict[str, str] = {}

VIEWS["models"] = """
  SELECT 'https://adb-1001.1.example.net/' AS source_host,
         p_partkey AS model_key,
         concat(CASE WHEN p_partkey % 20 = 7 THEN 'main.' ELSE '' END,
                CASE WHEN p_partkey % 40 = 11 THEN 'o''' ELSE '' END,
                replace(p_name, ' ', '_'), '_', CAST(p_partkey AS VARCHAR(20)),
                CASE WHEN p_partkey % 50 = 3 THEN '  ' ELSE '' END) AS model_name,
         p_type AS description,
         1600000000000 + p_partkey * 3600000 AS creation_ms
  FROM part
"""

VIEWS["versions"] = """
  SELECT m.model_name,
         CAST(row_number() OVER (PARTITION BY l_partkey
              ORDER BY l_orderkey, l_linenumber, l_suppkey, l_extendedprice,
                       l_quantity, l_discount, l_tax, l_returnflag,
                       l_linestatus, l_shipdate) AS INT) AS version,
         CASE WHEN l_linenumber = 7 THEN NULL ELSE l_orderkey END AS run_id,
         concat('supp', CAST(l_suppkey AS VARCHAR(20))) AS user_id,
         CASE l_returnflag WHEN 'R' THEN 'Production'
                           WHEN 'A' THEN 'Staging' ELSE 'None' END AS stage,
         CASE WHEN l_linestatus = 'F'
              THEN concat('dbfs:/src/', CAST(l_orderkey AS VARCHAR(20)), '/artifacts/model/')
              ELSE 'models:/registered' END AS source_uri,
         1500000000000 + l_orderkey * 60000 + l_linenumber AS creation_ms,
         l_orderkey AS src_key
  FROM lineitem JOIN models m ON m.model_key = l_partkey
"""

VIEWS["runs"] = """
  SELECT CASE WHEN o_orderkey % 7 = 3 THEN -1 - o_orderkey ELSE o_orderkey END AS run_id, o_custkey AS experiment_id,
         concat('run-', CAST(o_orderkey AS VARCHAR(20))) AS run_name,
         CASE WHEN o_orderkey % 5 = 0 THEN NULL
              ELSE concat('user', CAST(o_custkey % 50 AS VARCHAR(20))) END AS run_user,
         CASE o_orderstatus WHEN 'F' THEN 'FINISHED'
                            WHEN 'O' THEN 'RUNNING' ELSE 'FAILED' END AS status,
         CASE WHEN o_orderkey % 11 = 5 THEN 'deleted' ELSE 'active' END AS lifecycle,
         1500000000000 + o_orderkey * 60000 AS start_ms,
         CASE WHEN o_orderstatus = 'O' THEN NULL
              ELSE 1500000000000 + o_orderkey * 60000 + 30000 END AS end_ms,
         o_totalprice AS total
  FROM orders
"""

VIEWS["experiments"] = """
  SELECT CASE WHEN c_custkey % 29 = 4 THEN -1 - c_custkey ELSE c_custkey END AS experiment_id,
         concat('/Users/', lower(c_mktsegment), '/exp_',
                CAST(CASE WHEN c_custkey % 10 = 9 THEN c_custkey - 1
                          ELSE c_custkey END AS VARCHAR(20)),
                CASE WHEN c_custkey % 13 = 0 THEN '/' ELSE '' END) AS name
  FROM customer
"""

VIEWS["run_params"] = """
  SELECT CAST((event_id - event_id % 5) / 5 AS BIGINT) AS run_id,
         event_type AS key,
         max(replace(replace(props, '{"k": ', ''), '}', '')) AS value
  FROM events GROUP BY 1, 2
"""

VIEWS["metric_points"] = """
  SELECT CAST((event_id - event_id % 5) / 5 AS BIGINT) AS run_id,
         event_type AS key, value,
         1500000000000 + event_id * 1000 AS ts_ms, event_id % 5 AS step
  FROM events
"""

VIEWS["run_metrics"] = """
  SELECT run_id, key, max_by(value, step) AS value FROM metric_points GROUP BY 1, 2
  UNION ALL
  SELECT run_id, 'total' AS key, total AS value FROM runs WHERE run_id % 3 = 0
"""

VIEWS["run_tags"] = """
  SELECT run_id, 'mlflow.runName' AS key, run_name AS value FROM runs
  UNION ALL SELECT run_id, 'mlflow.user', run_user FROM runs WHERE run_user IS NOT NULL
  UNION ALL SELECT run_id, 'team', concat('team', CAST(experiment_id % 7 AS VARCHAR(20))) FROM runs
  UNION ALL SELECT run_id, 'source_run_id', 'stale' FROM runs WHERE run_id % 17 = 2
"""

VIEWS["run_artifacts"] = """
  SELECT CAST((doc_id - doc_id % 3) / 3 AS BIGINT) AS run_id,
         CASE WHEN doc_id % 31 = 0 THEN ''
              WHEN doc_id % 3 = 0 THEN 'model/MLmodel'
              WHEN doc_id % 3 = 1 THEN 'model/requirements.txt'
              ELSE concat('plots/', source, '.png') END AS path,
         n_chars AS size_bytes
  FROM documents
"""

VIEWS["tgt_versions"] = """
  SELECT concat('mig_', model_name) AS model_name, version + 10 AS version,
         1000000 + run_id AS run_id, CAST(version AS VARCHAR(20)) AS source_model_version
  FROM versions WHERE run_id IS NOT NULL AND src_key % 7 <> 3 AND src_key % 2 = 0
  UNION ALL
  SELECT concat('mig_', model_name), version + 1000, 1000000 + run_id, CAST(version AS VARCHAR(20))
  FROM versions WHERE run_id IS NOT NULL AND src_key % 14 = 8
  UNION ALL
  SELECT concat('mig_', model_name), 1, NULL, NULL FROM models WHERE model_key % 4 = 1
"""

VIEWS["tgt_run_params"] = """
  SELECT 1000000 + run_id AS run_id, key, value FROM run_params
  WHERE NOT (run_id % 6 = 0 AND key = 'click')
"""

VIEWS["tgt_experiments"] = """
  SELECT 500000 + c_custkey AS experiment_id,
         concat('/Shared/mlflow-workspace-migration/exp_', CAST(c_custkey AS VARCHAR(20))) AS name
  FROM customer WHERE c_custkey % 10 <> 9 AND c_custkey % 6 <> 0 AND c_custkey % 29 <> 4
"""

VIEWS["tgt_runs"] = """
  SELECT 1000000 + r.run_id AS run_id, t.experiment_id,
         CAST(r.run_id AS VARCHAR(20)) AS source_run_id
  FROM runs r JOIN tgt_experiments t
    ON t.experiment_id = 500000 + CASE WHEN r.experiment_id % 10 = 9
                                       THEN r.experiment_id - 1 ELSE r.experiment_id END
  WHERE r.run_id % 2 = 0
  UNION ALL
  SELECT 3000000 + run_id, 999999, CAST(run_id AS VARCHAR(20)) FROM runs WHERE run_id % 30 = 7
"""

VIEWS["tgt_run_metrics"] = """
  SELECT 1000000 + run_id AS run_id, key, value FROM run_metrics
  WHERE NOT (run_id % 10 = 4 AND key = 'total')
"""

VIEWS["tgt_run_artifacts"] = """
  SELECT 1000000 + run_id AS run_id, path, size_bytes FROM run_artifacts
  WHERE path LIKE 'model/%' AND NOT (run_id % 8 = 2 AND path = 'model/requirements.txt')
"""

VIEWS["tgt_models"] = """
  SELECT concat('mig_', model_name) AS model_name FROM models WHERE model_key % 5 <> 0
"""

VIEWS["model_tags"] = """
  SELECT model_name, 'team' AS key, concat('team', CAST(model_key % 7 AS VARCHAR(20))) AS value FROM models
  UNION ALL SELECT model_name, 'mlflow.note', 'kept on models' FROM models WHERE model_key % 4 = 0
  UNION ALL SELECT model_name, 'source_model_name', 'stale' FROM models WHERE model_key % 9 = 0
"""

VIEWS["version_tags"] = """
  SELECT model_name, version, 'stage_note' AS key, lower(stage) AS value FROM versions
  UNION ALL SELECT model_name, version, 'source_model_version', 'stale' FROM versions WHERE src_key % 13 = 0
"""

VIEWS["experiment_tags"] = """
  SELECT experiment_id, 'mlflow.ownerId' AS key, CAST(experiment_id AS VARCHAR(20)) AS value FROM experiments
  UNION ALL SELECT experiment_id, 'team', concat('team', CAST(experiment_id % 7 AS VARCHAR(20))) FROM experiments
  UNION ALL SELECT experiment_id, 'source_workspace_host', 'stale' FROM experiments WHERE experiment_id % 8 = 0
"""

VIEWS["error_log"] = """
  SELECT event_id AS call_id, CAST(event_id % 6 AS INT) AS attempt,
         CAST(CASE event_id % 7 WHEN 0 THEN 429 WHEN 1 THEN 500 WHEN 2 THEN 503
                                WHEN 3 THEN 404 WHEN 4 THEN 400 END AS INT) AS status_code,
         CASE event_id % 9 WHEN 0 THEN 'HTTP 429 for url' WHEN 1 THEN 'RESOURCE_EXHAUSTED'
              WHEN 2 THEN 'Too Many Requests' WHEN 3 THEN 'got 503' WHEN 4 THEN 'TEMPORARILY_UNAVAILABLE'
              WHEN 5 THEN 'HTTP 500 internal' WHEN 6 THEN 'RESOURCE_DOES_NOT_EXIST: run 14290'
              ELSE 'bad request' END AS message
  FROM events
"""

VIEWS["inventory_failures"] = """
  SELECT model_name, concat('timeout while reading ', model_name, ' from the source workspace registry, giving up after all retries; ',
                            'the rest of this message is longer than one hundred and twenty characters') AS message
  FROM models WHERE model_key % 97 = 5
"""

VIEWS["tracking_prev"] = """
  SELECT 'https://adb-1001.1.example.net' AS source_host, model_name,
         'STALE' AS readiness, 99 AS source_versions,
         CAST(model_key % 4 AS INT) AS source_versions_migratable,
         CAST(model_key % 5 AS INT) AS target_versions,
         CASE model_key % 4 WHEN 0 THEN 'COMPLETED' WHEN 1 THEN 'FAILED'
                            WHEN 2 THEN 'PARTIAL' ELSE 'PENDING' END AS migration_status,
         CASE WHEN model_key % 4 = 1 THEN 'old failure' END AS migration_comments
  FROM models WHERE model_key % 3 = 0
  UNION ALL
  SELECT 'https://adb-2002.2.example.net', model_name, 'OTHER HOST', 7, 7, 7, 'PENDING', NULL
  FROM models WHERE model_key % 10 = 0
"""

VIEWS["src_versions"] = """
  SELECT model_name, version, run_id, user_id, stage, source_uri,
         concat('registered by ', user_id) AS description, creation_ms
  FROM versions
"""

VIEWS["made_versions"] = """
  SELECT 'https://adb-1001.1.example.net' AS source_host,
         model_name, version, run_id, source_model_version
  FROM tgt_versions
"""

VIEWS["made_runs"] = """
  SELECT 'https://adb-1001.1.example.net' AS source_host,
         run_id, experiment_id, source_run_id,
         concat('dbfs:/tgt/', CAST(run_id AS VARCHAR(20)), '/artifacts') AS artifact_uri
  FROM tgt_runs
"""

PUBLISHED: dict[str, str] = {}

PUBLISHED["versions"] = """
  SELECT m.model_name,
         CAST(row_number() OVER (PARTITION BY l_partkey
              ORDER BY l_orderkey, l_linenumber, l_suppkey, l_extendedprice,
                       l_quantity, l_discount, l_tax, l_returnflag,
                       l_linestatus, l_shipdate) AS INT) AS version,
         CASE WHEN l_linenumber = 7 THEN NULL ELSE l_orderkey END AS run_id,
         concat('supp', CAST(l_suppkey AS VARCHAR(20))) AS user_id,
         CASE l_returnflag WHEN 'R' THEN 'Production'
                           WHEN 'A' THEN 'Staging' ELSE 'None' END AS stage,
         CASE WHEN l_linestatus = 'F'
              THEN concat('dbfs:/src/', CAST(l_orderkey AS VARCHAR(20)), '/artifacts/model/')
              ELSE 'models:/registered' END AS source_uri,
         1500000000000 + l_orderkey * 60000 + l_linenumber AS creation_ms,
         l_orderkey AS src_key
  FROM lineitem JOIN models m ON m.model_key = l_partkey
  WHERE l_quantity <= 4
"""

PUBLISHED["runs"] = """
  SELECT o_orderkey AS run_id, o_custkey AS experiment_id,
         concat('run-', CAST(o_orderkey AS VARCHAR(20))) AS run_name,
         CASE WHEN o_orderkey % 5 = 0 THEN NULL
              ELSE concat('user', CAST(o_custkey % 50 AS VARCHAR(20))) END AS run_user,
         CASE o_orderstatus WHEN 'F' THEN 'FINISHED'
                            WHEN 'O' THEN 'RUNNING' ELSE 'FAILED' END AS status,
         CASE WHEN o_orderkey % 11 = 5 THEN 'deleted' ELSE 'active' END AS lifecycle,
         1500000000000 + o_orderkey * 60000 AS start_ms,
         CASE WHEN o_orderstatus = 'O' THEN NULL
              ELSE 1500000000000 + o_orderkey * 60000 + 30000 END AS end_ms,
         o_totalprice AS total
  FROM orders WHERE o_orderkey % 7 <> 3
"""

PUBLISHED["experiments"] = """
  SELECT c_custkey AS experiment_id,
         concat('/Users/', lower(c_mktsegment), '/exp_',
                CAST(CASE WHEN c_custkey % 10 = 9 THEN c_custkey - 1
                          ELSE c_custkey END AS VARCHAR(20)),
                CASE WHEN c_custkey % 13 = 0 THEN '/' ELSE '' END) AS name
  FROM customer WHERE c_custkey % 29 <> 4
"""


def closure(names: list[str]) -> list[str]:
    """The named views and all they are made from, in order."""
    needed: set[str] = set()
    todo = [n for n in names if n in VIEWS]
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo += [v for v in VIEWS if v != name and re.search(rf"\b{v}\b", VIEWS[name])]
    return [v for v in VIEWS if v in needed]


def numbered_versions(lines: DataFrame, models: DataFrame) -> DataFrame:
    """The rows of ``VIEWS["versions"]``, numbered before their model is looked up, so that no name moves with a line.

    A model that is listed n times has each of its lines n times, one after the other.
    """
    order = ("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus", "l_shipdate")
    place = F.row_number().over(Window.partitionBy("l_partkey").orderBy(*order))
    numbered = lines.where(F.col("l_partkey").isNotNull()).select("l_partkey", *order, place.alias("place"))
    listed = models.groupBy("model_key").agg(F.array_sort(F.collect_list(F.struct("model_name"))).alias("names"))
    named = numbered.join(listed, F.col("l_partkey") == F.col("model_key")).select("*", F.posexplode("names").alias("copy", "named"))
    return named.selectExpr(
        "named.model_name", "CAST((place - 1) * size(names) + copy + 1 AS INT) AS version",
        "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_orderkey END AS run_id",
        "concat('supp', CAST(l_suppkey AS VARCHAR(20))) AS user_id",
        "CASE l_returnflag WHEN 'R' THEN 'Production' WHEN 'A' THEN 'Staging' ELSE 'None' END AS stage",
        """CASE WHEN l_linestatus = 'F' THEN concat('dbfs:/src/', CAST(l_orderkey AS VARCHAR(20)), '/artifacts/model/')
           ELSE 'models:/registered' END AS source_uri""",
        "1500000000000 + l_orderkey * 60000 + l_linenumber AS creation_ms", "l_orderkey AS src_key",
    )


_loaded: dict[tuple[str, str, bool], dict[str, DataFrame]] = {}


def tables(spark: SparkSession, sf_dir: str, published: bool = False) -> dict[str, DataFrame]:
    """Lazy DataFrames of all views, made once by session and folder."""
    key = (spark.sparkContext.applicationId, sf_dir, published)
    if key not in _loaded:
        made: dict[str, DataFrame] = {}
        for name in DRIVER_TABLES:
            df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
            df.createOrReplaceTempView(name)
        views = {**VIEWS, **PUBLISHED} if published else VIEWS
        for name, body in views.items():
            made[name] = spark.sql(body)
            if name == "versions" and not published:
                made[name] = numbered_versions(spark.table("lineitem"), made["models"])
            if name in STORED:
                made[name] = written(made[name], name)
            made[name].createOrReplaceTempView(name)
        _loaded[key] = made
    return _loaded[key]


def source(spark: SparkSession, sf_dir: str, published: bool = False) -> Snapshot:
    """The source registry, ids BIGINT."""
    t = tables(spark, sf_dir, published)
    return Snapshot(
        host=SOURCE_HOST, models=t["models"], versions=t["src_versions"],
        experiments=t["experiments"], runs=t["runs"], run_params=t["run_params"],
        run_metrics=t["run_metrics"], metric_points=t["metric_points"], run_tags=t["run_tags"],
        run_artifacts=t["run_artifacts"], model_tags=t["model_tags"],
        version_tags=t["version_tags"], experiment_tags=t["experiment_tags"],
    )


def target(spark: SparkSession, sf_dir: str, published: bool = False) -> Snapshot:
    """The target registry as an earlier migration left it."""
    t = tables(spark, sf_dir, published)
    return Snapshot(
        host=TARGET_HOST, models=t["tgt_models"], versions=t["made_versions"],
        experiments=t["tgt_experiments"], runs=t["made_runs"], run_params=t["tgt_run_params"],
        run_metrics=t["tgt_run_metrics"], metric_points=None, run_tags=None,
        run_artifacts=t["tgt_run_artifacts"],
    )
