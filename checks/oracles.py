"""The same queries in SQL for DuckDB, written apart from the Spark code."""

from __future__ import annotations

import re

from checks.fixtures import COMMIT_MS, SOURCE_HOST, TARGET_HOST, VIEWS

THOST = TARGET_HOST.rstrip("/")
ROOT = "/Shared/mlflow-workspace-migration"

PARTS: dict[str, str] = {}

PARTS["src_counts"] = """
  SELECT run_id, CAST(sum(p) AS BIGINT) AS params, CAST(sum(m) AS BIGINT) AS metrics,
         CAST(sum(f) AS BIGINT) AS model_files
  FROM (SELECT run_id, 1 AS p, 0 AS m, 0 AS f FROM run_params
        UNION ALL SELECT run_id, 0, 1, 0 FROM run_metrics
        UNION ALL SELECT run_id, 0, 0, count(DISTINCT split_part(path, '/', 2)) FROM run_artifacts
                  WHERE path LIKE 'model/_%' GROUP BY run_id) q
  GROUP BY run_id
"""
PARTS["in_scope_missing"] = """
  SELECT v.* FROM src_versions v
  LEFT JOIN (SELECT DISTINCT model_name, source_model_version FROM made_versions) t
    ON t.model_name = concat('mig_', v.model_name) AND t.source_model_version = CAST(v.version AS VARCHAR)
  WHERE t.model_name IS NULL AND position('.' IN v.model_name) = 0
"""
PARTS["after_rows"] = """
  SELECT 'models' AS table_name, (SELECT count(*) FROM tgt_models) + (SELECT count(*) FROM models
    WHERE position('.' IN model_name) = 0 AND concat('mig_', model_name) NOT IN (SELECT model_name FROM tgt_models)) AS n_rows
  UNION ALL SELECT 'versions', (SELECT count(*) FROM made_versions) + (SELECT count(*) FROM created)
  UNION ALL SELECT 'experiments', (SELECT count(*) FROM tgt_experiments) + (SELECT count(*) FROM exp_new)
  UNION ALL SELECT 'runs', (SELECT count(*) FROM made_runs) + (SELECT count(*) FROM fresh)
"""
PARTS["tgt_counts"] = (
    PARTS["src_counts"].replace("run_params", "tgt_run_params")
    .replace("run_metrics", "tgt_run_metrics").replace("run_artifacts", "tgt_run_artifacts")
)
PARTS["src_readable"] = """
  SELECT r.run_id, r.experiment_id, r.run_user, coalesce(params, 0) AS params,
         coalesce(metrics, 0) AS metrics, coalesce(model_files, 0) AS model_files
  FROM runs r LEFT JOIN src_counts c ON c.run_id = r.run_id
"""
PARTS["tgt_readable"] = """
  SELECT r.run_id, r.experiment_id, coalesce(params, 0) AS params,
         coalesce(metrics, 0) AS metrics, coalesce(model_files, 0) AS model_files
  FROM made_runs r LEFT JOIN tgt_counts c ON c.run_id = r.run_id
"""
PARTS["states"] = """
  SELECT v.*, r.experiment_id, r.run_user, r.params, r.metrics, r.model_files,
         CASE WHEN v.run_id IS NULL THEN 'NO_RUN' WHEN r.run_id IS NOT NULL THEN 'READY'
              ELSE 'BLOCKED' END AS run_state
  FROM src_versions v LEFT JOIN src_readable r ON r.run_id = v.run_id
"""
PARTS["exp_runs"] = """
  SELECT experiment_id, count(*) AS runs FROM runs WHERE lifecycle = 'active' GROUP BY experiment_id
"""
PARTS["inv_experiments"] = """
  SELECT p.model_name, count(*) AS n,
         sum(CASE WHEN e.experiment_id IS NULL THEN 0 ELSE coalesce(x.runs, 0) END) AS runs,
         string_agg(DISTINCT coalesce(e.name, concat('(id: ', p.experiment_id, ')')), ' | '
                    ORDER BY coalesce(e.name, concat('(id: ', p.experiment_id, ')'))) AS names
  FROM (SELECT DISTINCT model_name, experiment_id FROM states WHERE run_state = 'READY') p
  LEFT JOIN experiments e ON e.experiment_id = p.experiment_id
  LEFT JOIN exp_runs x ON x.experiment_id = p.experiment_id
  GROUP BY p.model_name
"""
PARTS["inv_users"] = """
  SELECT model_name, string_agg(DISTINCT u, ', ' ORDER BY u) AS owners
  FROM (SELECT model_name, user_id AS u FROM states
        UNION ALL SELECT model_name, coalesce(run_user, user_id, '') FROM states WHERE run_state = 'READY') q
  WHERE u <> '' GROUP BY model_name
"""
PARTS["inv_numbers"] = """
  SELECT model_name, count(*) AS versions, count(*) FILTER (WHERE run_state = 'BLOCKED') AS blocked,
         sum(params) AS params, sum(metrics) AS metrics, sum(model_files) AS files,
         max(creation_ms) AS latest,
         string_agg(DISTINCT stage, ', ' ORDER BY stage) FILTER (WHERE stage <> 'None') AS stages,
         string_agg(concat('v', version, ': run missing'), '; ' ORDER BY version)
           FILTER (WHERE run_state = 'BLOCKED') AS comments
  FROM states GROUP BY model_name
"""
PARTS["inv_all"] = f"""
  SELECT rtrim(m.source_host, '/') AS source_host, '{THOST}' AS target_host, m.model_name,
         CASE WHEN coalesce(versions - blocked, 0) = 0 THEN '❌ BLOCKED — all runs deleted'
              WHEN blocked > 0 THEN concat('⚠️ PARTIAL — ', versions - blocked, '/', versions, ' versions migratable')
              ELSE '✅ READY' END AS readiness,
         CAST(coalesce(versions, 0) AS INT) AS source_versions,
         CAST(coalesce(versions - blocked, 0) AS INT) AS source_versions_migratable,
         CAST(coalesce(blocked, 0) AS INT) AS source_versions_blocked,
         CAST(coalesce(e.n, 0) AS INT) AS source_experiments,
         CAST(coalesce(e.runs, 0) AS INT) AS source_runs,
         CAST(coalesce(params, 0) AS INT) AS source_params,
         CAST(coalesce(metrics, 0) AS INT) AS source_metrics,
         CAST(coalesce(files, 0) AS INT) AS source_artifacts,
         coalesce(stages, 'None') AS stages, coalesce(owners, '') AS owner_emails,
         CAST(NULL AS VARCHAR) AS flavors, CAST(NULL AS VARCHAR) AS requirements,
         CAST(NULL AS VARCHAR) AS python_version, coalesce(e.names, '') AS experiments,
         coalesce(strftime(epoch_ms(latest), '%Y-%m-%d %H:%M'), '') AS latest_version_created,
         strftime(epoch_ms(m.creation_ms), '%Y-%m-%d') AS created,
         CAST(0 AS INT) AS target_versions, CAST(0 AS INT) AS target_runs, CAST(0 AS INT) AS target_params,
         CAST(0 AS INT) AS target_metrics, CAST(0 AS INT) AS target_artifacts,
         'PENDING' AS migration_status, comments AS discovery_comments,
         CAST(NULL AS VARCHAR) AS migration_comments, CAST(NULL AS VARCHAR) AS target_model_url,
         CAST(NULL AS VARCHAR) AS target_experiment_urls
  FROM models m
  LEFT JOIN inv_numbers n ON n.model_name = m.model_name
  LEFT JOIN inv_experiments e ON e.model_name = m.model_name
  LEFT JOIN inv_users u ON u.model_name = m.model_name
"""
PARTS["inv_scoped"] = "SELECT * FROM inv_all WHERE position('.' IN model_name) = 0"
PARTS["inv_errors"] = """
  SELECT i.model_name,
         CASE WHEN f.model_name IS NULL THEN readiness ELSE concat('❌ ERROR — ', left(message, 60)) END AS readiness,
         CASE WHEN f.model_name IS NULL THEN source_versions ELSE CAST(0 AS INT) END AS source_versions,
         CASE WHEN f.model_name IS NULL THEN stages ELSE 'None' END AS stages,
         CASE WHEN f.model_name IS NULL THEN discovery_comments
              ELSE concat('Inventory error: ', left(message, 120)) END AS discovery_comments
  FROM inv_scoped i LEFT JOIN inventory_failures f ON f.model_name = i.model_name
"""

# The migration: versions in scope that have no target version yet.
PARTS["scope_versions"] = "SELECT * FROM src_versions WHERE position('.' IN model_name) = 0"
PARTS["to_clone"] = """
  SELECT v.*, concat('mig_', v.model_name) AS target_model FROM scope_versions v
  WHERE NOT EXISTS (SELECT 1 FROM made_versions t WHERE t.model_name = concat('mig_', v.model_name)
                    AND t.source_model_version = CAST(v.version AS VARCHAR))
"""
PARTS["ref_experiments"] = """
  SELECT * FROM experiments WHERE experiment_id IN
    (SELECT r.experiment_id FROM scope_versions v JOIN runs r ON r.run_id = v.run_id)
"""
PARTS["exp_map"] = f"""
  SELECT e.experiment_id, e.target_name,
         coalesce(CAST(t.experiment_id AS VARCHAR), sha256(concat('experiment/', e.target_name))) AS target_experiment_id,
         t.experiment_id IS NULL AS is_new
  FROM (SELECT experiment_id, concat('{ROOT}/', split_part(rtrim(name, '/'), '/', -1)) AS target_name
        FROM ref_experiments) e
  LEFT JOIN tgt_experiments t ON t.name = e.target_name
"""
PARTS["exp_new"] = """
  SELECT target_experiment_id, target_name, min(experiment_id) AS source_experiment_id
  FROM exp_map WHERE is_new GROUP BY 1, 2
"""
PARTS["candidates"] = """
  SELECT * FROM runs r
  WHERE (lifecycle = 'active' AND experiment_id IN (SELECT experiment_id FROM ref_experiments))
     OR EXISTS (SELECT 1 FROM to_clone v WHERE v.run_id = r.run_id)
"""
PARTS["mapped"] = f"""
  SELECT c.run_id, c.experiment_id, c.lifecycle, c.status, c.start_ms, c.end_ms, x.target_name, x.target_experiment_id,
         coalesce(CAST(t.run_id AS VARCHAR), CASE WHEN x.target_experiment_id IS NOT NULL
                  THEN sha256(concat('{SOURCE_HOST}/', c.run_id)) END) AS target_run_id,
         coalesce(t.artifact_uri, CASE WHEN x.target_experiment_id IS NOT NULL THEN
                  concat('dbfs:/moved/', x.target_experiment_id, '/', sha256(concat('{SOURCE_HOST}/', c.run_id)), '/artifacts')
                  END) AS target_artifact_uri,
         t.run_id IS NULL AND x.target_experiment_id IS NOT NULL AS is_new
  FROM candidates c LEFT JOIN exp_map x ON x.experiment_id = c.experiment_id
  LEFT JOIN made_runs t ON CAST(t.experiment_id AS VARCHAR) = x.target_experiment_id
                       AND t.source_run_id = CAST(c.run_id AS VARCHAR)
"""
PARTS["fresh"] = "SELECT * FROM mapped WHERE is_new"
PARTS["judged"] = """
  SELECT v.*, m.target_run_id, m.target_artifact_uri,
         CASE WHEN tail IS NULL OR tail = '' THEN 'model' ELSE tail END AS model_path,
         m.target_name, m.run_id IS NOT NULL AS run_found, m.experiment_id
  FROM (SELECT *, CASE WHEN instr(source_uri, '/artifacts/') > 0 THEN
               trim(substr(source_uri, instr(source_uri, '/artifacts/') + 11), '/') END AS tail FROM to_clone) v
  LEFT JOIN mapped m ON m.run_id = v.run_id
"""
PARTS["verdicts"] = """
  SELECT j.*,
         EXISTS (SELECT 1 FROM tgt_run_artifacts a WHERE CAST(a.run_id AS VARCHAR) = j.target_run_id
                 AND starts_with(a.path, concat(j.model_path, '/'))) AS on_target,
         EXISTS (SELECT 1 FROM run_artifacts a WHERE a.run_id = j.run_id
                 AND (a.path = j.model_path OR starts_with(a.path, concat(j.model_path, '/')))) AS in_source
  FROM judged j
"""
PARTS["reasons"] = """
  SELECT *, left(CASE
      WHEN run_id IS NULL THEN concat('Model version ', model_name, ' v', version, ' has no run_id')
      WHEN NOT run_found THEN concat('Run ', run_id, ' not found')
      WHEN target_name IS NULL THEN concat('Experiment ', experiment_id, ' not found')
      WHEN NOT on_target AND NOT in_source THEN concat('No model artifacts at ', model_path, ' in run ', run_id)
    END, 120) AS reason
  FROM verdicts
"""
PARTS["created"] = """
  SELECT r.*, CAST(coalesce(last, 0) + row_number() OVER (PARTITION BY r.target_model ORDER BY r.version) AS INT) AS number
  FROM (SELECT * FROM reasons WHERE reason IS NULL) r
  LEFT JOIN (SELECT model_name, max(version) AS last FROM made_versions GROUP BY 1) t ON t.model_name = r.target_model
"""
PARTS["model_files"] = """
  SELECT DISTINCT a.run_id, c.target_run_id, a.path, a.size_bytes
  FROM created c JOIN run_artifacts a ON a.run_id = c.run_id
  WHERE NOT c.on_target AND (a.path = c.model_path OR starts_with(a.path, concat(c.model_path, '/')))
"""
PARTS["all_files"] = """
  SELECT * FROM model_files
  UNION SELECT a.run_id, f.target_run_id, a.path, a.size_bytes FROM fresh f JOIN run_artifacts a ON a.run_id = f.run_id
  WHERE trim(a.path) <> ''
"""
_MANIFEST = """
  SELECT f.run_id, f.target_run_id, f.path, nullif(regexp_extract(f.path, '^(.*)/[^/]*$', 1), '') AS parent, f.size_bytes
  FROM {files} f WHERE NOT EXISTS
    (SELECT 1 FROM tgt_run_artifacts t WHERE CAST(t.run_id AS VARCHAR) = f.target_run_id AND t.path = f.path)
"""
PARTS["wanted_files"] = f"""
  SELECT f.*, octet_length(encode(d.text)) AS bytes FROM ({_MANIFEST.format(files="all_files")}) f
  LEFT JOIN (SELECT CAST((doc_id - doc_id % 3) / 3 AS BIGINT) AS run_id, text,
                    CASE doc_id % 3 WHEN 0 THEN 'model/MLmodel' WHEN 1 THEN 'model/requirements.txt'
                         ELSE concat('plots/', source, '.png') END AS path
             FROM documents WHERE doc_id % 31 <> 0 AND doc_id % 17 <> 5) d ON d.run_id = f.run_id AND d.path = f.path
"""
PARTS["moved_verdicts"] = """
  SELECT r.*, r.reason IS NOT NULL OR (NOT r.on_target AND EXISTS (
    SELECT 1 FROM wanted_files w WHERE w.bytes IS NULL AND w.run_id = r.run_id
      AND (w.path = r.model_path OR starts_with(w.path, concat(r.model_path, '/'))))) AS failed
  FROM reasons r
"""
PARTS["fail_comments"] = """
  SELECT model_name, count(*) AS failed, string_agg(left(reason, 60), '; ' ORDER BY version) AS comments
  FROM reasons WHERE reason IS NOT NULL GROUP BY model_name
"""
PARTS["rollup"] = f"""
  SELECT v.model_name, count(*) AS versions, CAST(coalesce(sum(params), 0) AS BIGINT) AS params,
         CAST(coalesce(sum(metrics), 0) AS BIGINT) AS metrics, CAST(coalesce(sum(model_files), 0) AS BIGINT) AS model_files,
         string_agg(DISTINCT '{THOST}/ml/experiments/' || r.experiment_id, ' | '
                    ORDER BY '{THOST}/ml/experiments/' || r.experiment_id) AS experiment_urls
  FROM made_versions v LEFT JOIN tgt_readable r ON r.run_id = v.run_id
  WHERE v.source_model_version <> '' GROUP BY v.model_name
"""
PARTS["outcomes"] = f"""
  SELECT '{SOURCE_HOST}' AS source_host, m.model_name,
         CAST(coalesce(r.versions, 0) AS INT) AS target_versions, CAST(coalesce(c.n, 0) AS INT) AS target_runs,
         CAST(coalesce(r.params, 0) AS INT) AS target_params, CAST(coalesce(r.metrics, 0) AS INT) AS target_metrics,
         CAST(coalesce(r.model_files, 0) AS INT) AS target_artifacts,
         CASE WHEN coalesce(r.versions, 0) >= t.source_versions_migratable AND t.source_versions_migratable > 0 THEN 'COMPLETED'
              WHEN r.versions > 0 THEN 'PARTIAL' WHEN f.failed > 0 THEN 'FAILED' ELSE 'SKIPPED' END AS migration_status,
         f.comments AS migration_comments,
         concat('{THOST}/ml/models/mig_', m.model_name, '?o=3003') AS target_model_url,
         r.experiment_urls AS target_experiment_urls
  FROM models m
  LEFT JOIN rollup r ON r.model_name = concat('mig_', m.model_name)
  LEFT JOIN (SELECT model_name, count(*) AS n FROM created GROUP BY 1) c ON c.model_name = m.model_name
  LEFT JOIN fail_comments f ON f.model_name = m.model_name
  LEFT JOIN tracking_prev t ON t.model_name = m.model_name AND t.source_host = '{SOURCE_HOST}'
  WHERE position('.' IN m.model_name) = 0
"""
PARTS["last_target"] = """
  SELECT model_name, source_model_version, max(version) AS version, max_by(run_id, version) AS run_id
  FROM made_versions WHERE source_model_version <> '' GROUP BY 1, 2
"""
PARTS["report"] = """
  SELECT v.model_name AS source_model, v.version, concat('mig_', v.model_name) AS target_model,
         CASE WHEN t.model_name IS NOT NULL THEN '✅ MIGRATED' WHEN s.run_id IS NULL THEN '❌ RUN_DELETED'
              WHEN s.model_files = 0 THEN '❌ NO_ARTIFACTS' ELSE '⚠️ FAILED' END AS status,
         s.run_id IS NOT NULL AS source_run_accessible,
         CAST(coalesce(s.params, 0) AS INT) AS source_params,
         CAST(CASE WHEN t.model_name IS NOT NULL THEN coalesce(g.params, 0) END AS INT) AS target_params,
         CASE WHEN t.model_name IS NOT NULL THEN g.run_id IS NOT NULL AND g.params = coalesce(s.params, 0) END AS params_match,
         CAST(coalesce(s.metrics, 0) AS INT) AS source_metrics,
         CAST(CASE WHEN t.model_name IS NOT NULL THEN coalesce(g.metrics, 0) END AS INT) AS target_metrics,
         CASE WHEN t.model_name IS NOT NULL THEN g.run_id IS NOT NULL AND g.metrics = coalesce(s.metrics, 0) END AS metrics_match,
         CAST(coalesce(s.model_files, 0) AS INT) AS source_model_files,
         CAST(CASE WHEN t.model_name IS NOT NULL THEN coalesce(g.model_files, 0) END AS INT) AS target_model_files,
         CASE WHEN t.model_name IS NOT NULL THEN g.run_id IS NOT NULL AND g.model_files = coalesce(s.model_files, 0) END AS artifacts_match
  FROM scope_versions v
  LEFT JOIN last_target t ON t.model_name = concat('mig_', v.model_name) AND t.source_model_version = CAST(v.version AS VARCHAR)
  LEFT JOIN src_readable s ON s.run_id = v.run_id
  LEFT JOIN tgt_readable g ON g.run_id = t.run_id
"""
PARTS["waiting"] = f"""
  SELECT model_name FROM tracking_prev WHERE migration_status = 'PENDING' AND source_host = '{SOURCE_HOST}'
"""
PARTS["described"] = """
  SELECT CAST(doc_id AS VARCHAR) AS run_id,
         CASE WHEN doc_id % 5 <> 0 THEN concat('python_function, ', source) END AS flavors,
         array_to_string(list_transform(list_filter(string_split(text, chr(10)),
           lambda s: trim(s, concat(' ', chr(9), chr(13), chr(10))) <> '' AND NOT starts_with(s, '#')),
           lambda s: trim(s, concat(' ', chr(9), chr(13), chr(10)))), '; ') AS requirements,
         CASE WHEN doc_id % 5 <> 0 THEN concat('3.', doc_id % 4 + 9, '.1') END AS python_version
  FROM documents
"""

QUERIES: dict[str, str] = {
    "scoped_models": "SELECT rtrim(source_host, '/') AS source_host, model_name, creation_ms FROM models WHERE position('.' IN model_name) = 0",
    "allowed_models": """
        SELECT model_name FROM models WHERE trim(model_name) IN
          (SELECT trim(model_name) FROM src_versions WHERE stage = 'Production')""",
    "capped_versions": """
        SELECT model_name, version, run_id FROM
          (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY version DESC) AS n FROM src_versions) q
        WHERE n <= 2""",
    "capped_runs": """
        SELECT experiment_id, run_id, start_ms FROM
          (SELECT *, row_number() OVER (PARTITION BY experiment_id ORDER BY start_ms DESC, run_id) AS n FROM runs) q
        WHERE n <= 3""",
    "capped_runs_large": """
        SELECT experiment_id, run_id, start_ms FROM
          (SELECT *, row_number() OVER (PARTITION BY experiment_id ORDER BY start_ms DESC, run_id) AS n FROM runs) q
        WHERE n <= 150""",
    "active_runs": "SELECT run_id, experiment_id, lifecycle FROM runs WHERE lifecycle = 'active'",
    "version_status": "SELECT model_name, version, run_id, run_state FROM states",
    "referenced_experiments": """
        SELECT * FROM experiments WHERE experiment_id IN (0, 987654321) OR experiment_id IN
          (SELECT r.experiment_id FROM src_versions v JOIN runs r ON r.run_id = v.run_id)""",
    "dangling_references": """
        SELECT 'version_run' AS kind, model_name, version, CAST(run_id AS VARCHAR) AS id,
               concat(model_name, ' version ', version, ' points to run ', run_id, ', which is lost') AS message
        FROM states WHERE run_state = 'BLOCKED'
        UNION ALL
        SELECT 'run_experiment', NULL, NULL, CAST(experiment_id AS VARCHAR),
               concat('wanted experiment ', experiment_id, ' is lost')
        FROM (SELECT experiment_id FROM states WHERE run_state = 'READY' UNION SELECT 0 UNION SELECT 987654321) w
        WHERE experiment_id NOT IN (SELECT experiment_id FROM experiments)""",
    "experiment_names": f"""
        SELECT w.experiment_id, coalesce(e.name, concat('(id: ', w.experiment_id, ')')) AS experiment_name,
               CASE WHEN e.name IS NOT NULL THEN concat('{ROOT}/team_', split_part(rtrim(e.name, '/'), '/', -1)) END AS target_name
        FROM (SELECT DISTINCT experiment_id FROM states WHERE run_state = 'READY') w
        LEFT JOIN experiments e ON e.experiment_id = w.experiment_id""",
    "targeted_discovery": """
        SELECT m.model_name, coalesce(v.n, 0) AS versions, coalesce(x.experiments, 0) AS experiments,
               CAST(coalesce(x.runs, 0) AS BIGINT) AS runs
        FROM models m
        LEFT JOIN (SELECT model_name, count(*) AS n FROM src_versions GROUP BY 1) v ON v.model_name = m.model_name
        LEFT JOIN (SELECT p.model_name, count(*) AS experiments, sum(coalesce(runs, 0)) AS runs
                   FROM (SELECT DISTINCT model_name, experiment_id FROM states WHERE run_state = 'READY') p
                   LEFT JOIN exp_runs r ON r.experiment_id = p.experiment_id GROUP BY 1) x ON x.model_name = m.model_name
        WHERE trim(m.model_name) IN (SELECT trim(model_name) FROM waiting)""",
    "migration_scope": """
        SELECT 'models' AS entity, count(*) AS n FROM models WHERE position('.' IN model_name) = 0
        UNION ALL SELECT 'versions', count(*) FROM scope_versions
        UNION ALL SELECT 'experiments', count(*) FROM ref_experiments
        UNION ALL SELECT 'runs', count(*) FROM runs WHERE lifecycle = 'active'
          AND experiment_id IN (SELECT experiment_id FROM ref_experiments)""",
    "run_counts": "SELECT * FROM src_counts",
    "version_counts": """
        SELECT v.model_name, v.version, v.run_id, coalesce(params, 0) AS params, coalesce(metrics, 0) AS metrics,
               coalesce(model_files, 0) AS model_files FROM states v""",
    "runs_per_experiment": "SELECT experiment_id, count(*) AS runs FROM runs GROUP BY 1",
    "runs_per_model": """
        SELECT p.model_name, count(*) AS experiments, CAST(sum(n) AS BIGINT) AS runs
        FROM (SELECT DISTINCT model_name, experiment_id FROM states WHERE run_state = 'READY') p
        JOIN (SELECT experiment_id, count(*) AS n FROM runs GROUP BY 1) r ON r.experiment_id = p.experiment_id
        GROUP BY 1""",
    "inventory_report": "SELECT * FROM inv_scoped",
    "inventory_with_metadata": """
        SELECT m.model_name, f.flavors, p.python_version, q.requirements FROM models m
        LEFT JOIN (SELECT model_name, string_agg(DISTINCT flavors, ' | ' ORDER BY flavors) AS flavors
                   FROM states s JOIN described d ON d.run_id = CAST(s.run_id AS VARCHAR)
                   WHERE run_state = 'READY' AND flavors <> '' GROUP BY 1) f ON f.model_name = m.model_name
        LEFT JOIN (SELECT model_name, string_agg(DISTINCT python_version, ', ' ORDER BY python_version) AS python_version
                   FROM states s JOIN described d ON d.run_id = CAST(s.run_id AS VARCHAR)
                   WHERE run_state = 'READY' AND python_version <> '' GROUP BY 1) p ON p.model_name = m.model_name
        LEFT JOIN (SELECT model_name, nullif(max_by(requirements, version), '') AS requirements
                   FROM states s JOIN described d ON d.run_id = CAST(s.run_id AS VARCHAR)
                   WHERE run_state = 'READY' AND flavors <> '' GROUP BY 1) q ON q.model_name = m.model_name
        WHERE position('.' IN m.model_name) = 0""",
    "inventory_summary": """
        SELECT count(*) AS models, CAST(sum(source_versions) AS BIGINT) AS versions,
               CAST(sum(source_versions_migratable) AS BIGINT) AS migratable,
               count(*) FILTER (WHERE starts_with(readiness, '✅')) AS ready,
               count(*) FILTER (WHERE starts_with(readiness, '⚠')) AS partial,
               count(*) FILTER (WHERE starts_with(readiness, '❌')) AS blocked,
               (SELECT count(DISTINCT u) FROM (SELECT unnest(string_split(owner_emails, ', ')) AS u
                FROM inv_scoped WHERE owner_emails <> '') o) AS unique_owners
        FROM inv_scoped""",
    "error_rows": "SELECT * FROM inv_errors",
    "readiness_codes": """
        SELECT model_name, CASE WHEN readiness LIKE '✅%' THEN 'READY' WHEN readiness LIKE '⚠%' THEN 'PARTIAL'
               ELSE 'BLOCKED' END AS readiness_code FROM inv_errors""",
    "merge_inventory": f"""
        SELECT coalesce(t.source_host, i.source_host) AS source_host, coalesce(t.model_name, i.model_name) AS model_name,
               coalesce(i.readiness, t.readiness) AS readiness, coalesce(i.source_versions, t.source_versions) AS source_versions,
               coalesce(i.source_versions_migratable, t.source_versions_migratable) AS source_versions_migratable,
               coalesce(t.target_versions, i.target_versions) AS target_versions,
               coalesce(t.migration_status, i.migration_status) AS migration_status,
               t.migration_comments
        FROM tracking_prev t FULL OUTER JOIN inv_all i ON i.source_host = t.source_host AND i.model_name = t.model_name""",
    "model_outcomes": "SELECT * FROM outcomes",
    "apply_outcomes": """
        SELECT t.source_host, t.model_name, t.readiness, t.source_versions, t.source_versions_migratable,
               CASE WHEN o.model_name IS NULL THEN t.target_versions ELSE o.target_versions END AS target_versions,
               CASE WHEN o.model_name IS NULL THEN t.migration_status ELSE o.migration_status END AS migration_status,
               CASE WHEN o.model_name IS NULL THEN t.migration_comments ELSE o.migration_comments END AS migration_comments
        FROM tracking_prev t LEFT JOIN outcomes o ON o.model_name = t.model_name AND o.source_host = t.source_host""",
    "reset_failed": """
        SELECT source_host, model_name, readiness, source_versions, source_versions_migratable, target_versions,
               replace(migration_status, 'FAILED', 'PENDING') AS migration_status, migration_comments FROM tracking_prev""",
    "pending_models": "SELECT * FROM waiting",
    "status_counts": "SELECT migration_status, count(*) AS models FROM tracking_prev GROUP BY 1",
    "tracking_report": "SELECT * FROM tracking_prev",
    "new_versions": """
        SELECT v.model_name, v.version, concat('mig_', v.model_name) AS target_model FROM src_versions v
        LEFT JOIN (SELECT DISTINCT model_name, source_model_version FROM made_versions) t
          ON t.model_name = concat('mig_', v.model_name) AND t.source_model_version = CAST(v.version AS VARCHAR)
        WHERE t.model_name IS NULL""",
    "provenance_from_tags": """
        SELECT v.model_name, v.version, CAST(NULL AS BIGINT) AS run_id FROM src_versions v
        LEFT JOIN (SELECT DISTINCT model_name, source_model_version FROM made_versions) t
          ON t.model_name = concat('mig_', v.model_name) AND t.source_model_version = CAST(v.version AS VARCHAR)
        WHERE t.model_name IS NULL
        UNION ALL SELECT NULL, NULL, run_id FROM fresh""",
    "switched_off": """
        SELECT 'experiments' AS off, 'experiments' AS kind, count(*) AS n FROM experiments WHERE experiment_id IN
          (SELECT r.experiment_id FROM in_scope_missing w JOIN runs r ON r.run_id = w.run_id)
        UNION ALL SELECT 'experiments', 'versions', count(*) FROM in_scope_missing
        UNION ALL SELECT 'models', 'experiments', count(*) FROM ref_experiments
        UNION ALL SELECT 'models', 'versions', 0""",
    "migrate_with_files": """
        SELECT 'file' AS kind, target_run_id AS name, path, bytes AS n FROM wanted_files WHERE bytes IS NOT NULL
        UNION ALL SELECT 'record', target_run_id, path, 0 FROM wanted_files WHERE bytes IS NOT NULL
        UNION ALL SELECT 'version', target_model, NULL, coalesce(last, 0) + row_number() OVER (PARTITION BY target_model ORDER BY version)
          FROM moved_verdicts LEFT JOIN (SELECT model_name AS target_model, max(version) AS last FROM made_versions GROUP BY 1) l
          USING (target_model) WHERE NOT failed
        UNION ALL SELECT 'failure', model_name, NULL, version FROM moved_verdicts WHERE failed""",
    "file_failures": """
        SELECT CAST(run_id AS VARCHAR) AS run_id, path, kind, 1 AS attempts, CASE kind WHEN 'queued' THEN 2000 ELSE 0 END AS wait_ms
        FROM wanted_files, (VALUES ('queued'), ('reported')) k(kind) WHERE bytes IS NULL""",
    "retried_files": """
        SELECT 'three' AS commit, CAST(run_id AS VARCHAR) AS run_id, path, true AS ok FROM wanted_files WHERE bytes IS NULL""",
    "second_migration":
        "SELECT round, table_name, n_rows, n_rows AS n_keys FROM after_rows, (SELECT unnest(['one', 'two']) AS round) r",
    "new_models": """
        SELECT model_name, concat('mig_', model_name) AS target_model FROM models
        WHERE concat('mig_', model_name) NOT IN (SELECT model_name FROM tgt_models)""",
    "new_experiments": "SELECT * FROM exp_new",
    "candidate_runs": "SELECT run_id, experiment_id, lifecycle FROM candidates",
    "run_id_map": "SELECT run_id, experiment_id, target_experiment_id, target_run_id, is_new FROM mapped",
    "new_runs": "SELECT run_id, target_experiment_id FROM fresh",
    "target_experiments": f"""
        SELECT '{SOURCE_HOST}' AS source_host, target_experiment_id AS experiment_id, target_name AS name,
               CAST(source_experiment_id AS VARCHAR) AS source_experiment_id FROM exp_new""",
    "target_experiment_tags": f"""
        SELECT experiment_id, key, max_by(value, rank) AS value FROM (
          SELECT x.target_experiment_id AS experiment_id, t.key, t.value, x.experiment_id AS rank
          FROM experiment_tags t JOIN exp_map x ON x.experiment_id = t.experiment_id WHERE t.key NOT LIKE 'mlflow.%'
          UNION ALL SELECT target_experiment_id, 'source_workspace_host', '{SOURCE_HOST}', -9000000000 FROM exp_new
          UNION ALL SELECT target_experiment_id, 'source_experiment_id', CAST(source_experiment_id AS VARCHAR), -9000000000 FROM exp_new
        ) q GROUP BY 1, 2""",
    "target_models": f"""
        SELECT '{SOURCE_HOST}' AS source_host, concat('mig_', model_name) AS model_name, description,
               {COMMIT_MS} AS creation_ms, model_name AS source_model_name
        FROM models WHERE position('.' IN model_name) = 0 AND concat('mig_', model_name) NOT IN (SELECT model_name FROM tgt_models)""",
    "target_model_tags": f"""
        SELECT model_name, key, max_by(value, rank) AS value FROM (
          SELECT concat('mig_', model_name) AS model_name, key, value, 1 AS rank FROM model_tags
          UNION ALL SELECT concat('mig_', model_name), 'source_workspace_host', '{SOURCE_HOST}', 0 FROM models
                    WHERE concat('mig_', model_name) NOT IN (SELECT model_name FROM tgt_models)
          UNION ALL SELECT concat('mig_', model_name), 'source_model_name', model_name, 0 FROM models
                    WHERE concat('mig_', model_name) NOT IN (SELECT model_name FROM tgt_models)
        ) q WHERE position('.' IN model_name) = 0 GROUP BY 1, 2""",
    "target_runs": f"""
        SELECT '{SOURCE_HOST}' AS source_host, f.target_run_id AS run_id, f.target_experiment_id AS experiment_id,
               t.value AS run_name, u.run_user, f.status, 'active' AS lifecycle, f.start_ms, f.end_ms, f.target_artifact_uri AS artifact_uri,
               CAST(f.run_id AS VARCHAR) AS source_run_id
        FROM fresh f JOIN runs u ON u.run_id = f.run_id
        LEFT JOIN run_tags t ON t.run_id = f.run_id AND t.key = 'mlflow.runName'""",
    "target_run_tags": f"""
        SELECT f.target_run_id AS run_id, q.key, max_by(q.value, q.rank) AS value FROM fresh f JOIN (
          SELECT run_id, key, value, 0 AS rank FROM run_tags WHERE key NOT LIKE 'mlflow.%'
          UNION ALL SELECT run_id, 'source_workspace_host', '{SOURCE_HOST}', 1 FROM fresh
          UNION ALL SELECT run_id, 'source_run_id', CAST(run_id AS VARCHAR), 1 FROM fresh) q ON q.run_id = f.run_id
        GROUP BY 1, 2""",
    "target_params": "SELECT f.target_run_id AS run_id, p.key, p.value FROM run_params p JOIN fresh f ON f.run_id = p.run_id",
    "metric_history": """
        SELECT f.target_run_id AS run_id, m.key, coalesce(p.value, m.value) AS value,
               CASE WHEN p.run_id IS NOT NULL THEN p.ts_ms
                    ELSE coalesce(nullif(f.end_ms, 0), nullif(f.start_ms, 0), 0) END AS ts_ms,
               coalesce(p.step, 0) AS step
        FROM fresh f JOIN run_metrics m ON m.run_id = f.run_id
        LEFT JOIN metric_points p ON p.run_id = m.run_id AND p.key = m.key""",
    "target_versions": f"""
        SELECT '{SOURCE_HOST}' AS source_host, target_model AS model_name, number AS version, target_run_id AS run_id, user_id, stage,
               concat(target_artifact_uri, '/', model_path) AS source_uri, description, {COMMIT_MS} AS creation_ms,
               CAST(version AS VARCHAR) AS source_model_version, model_name AS source_model_name FROM created""",
    "target_version_tags": f"""
        SELECT target_model AS model_name, number AS version, key, max_by(value, rank) AS value FROM (
          SELECT c.target_model, c.number, t.key, t.value, 1 AS rank FROM created c
          JOIN version_tags t ON t.model_name = c.model_name AND t.version = c.version
          UNION ALL SELECT target_model, number, 'source_workspace_host', '{SOURCE_HOST}', 0 FROM created
          UNION ALL SELECT target_model, number, 'source_model_name', model_name, 0 FROM created
          UNION ALL SELECT target_model, number, 'source_model_version', CAST(version AS VARCHAR), 0 FROM created
        ) q GROUP BY 1, 2, 3""",
    "migration_failures": "SELECT model_name, version, reason FROM reasons WHERE reason IS NOT NULL",
    "run_failures": """
        SELECT CAST(c.run_id AS VARCHAR) AS run_id, CAST(c.experiment_id AS VARCHAR) AS experiment_id,
               left(CASE WHEN x.target_name IS NULL THEN concat('Experiment ', c.experiment_id, ' not found')
                    ELSE concat('Missing target experiment ', x.target_name) END, 120) AS reason
        FROM candidates c LEFT JOIN exp_map x ON x.experiment_id = c.experiment_id
        WHERE x.target_name IS NULL OR x.target_name NOT IN (SELECT name FROM tgt_experiments)""",
    "failure_comments": "SELECT * FROM fail_comments",
    "failure_parts": """
        SELECT model_name, CAST(floor(version / 4096) AS BIGINT) AS part, count(*) AS rows,
               string_agg(left(reason, 60), '; ' ORDER BY version) AS text
        FROM reasons WHERE reason IS NOT NULL GROUP BY 1, 2""",
    "artifact_manifest": _MANIFEST.format(files="all_files"),
    "model_manifest": _MANIFEST.format(files="model_files"),
    "migration_summary": """
        SELECT (SELECT count(*) FROM models WHERE position('.' IN model_name) = 0) AS migrated_models,
               count(*) AS migrated_model_versions, (SELECT count(*) FROM ref_experiments) AS migrated_experiments,
               count(*) AS migrated_runs, count(DISTINCT target_run_id) AS distinct_runs FROM created""",
    "model_batches": """
        SELECT model_name, CAST(floor((row_number() OVER (ORDER BY model_name) - 1) / 10) AS BIGINT) AS batch_id FROM models""",
    "reconcile_report": "SELECT * FROM report",
    "reconcile_summary": """
        SELECT count(*) AS total, count(*) FILTER (WHERE status LIKE '%MIGRATED') AS migrated,
               count(*) FILTER (WHERE status LIKE '%FAILED') AS failed,
               count(*) FILTER (WHERE status LIKE '%RUN_DELETED') AS run_deleted,
               count(*) FILTER (WHERE status LIKE '%NO_ARTIFACTS') AS no_artifacts FROM report""",
    "target_rollup": "SELECT * FROM rollup",
    "latest_target_versions": "SELECT * FROM last_target",
    "sanitized_names": r"""
        SELECT name, CASE WHEN token = '' THEN 'item' ELSE token END AS token FROM (
          SELECT name, trim(regexp_replace(name, '[^a-zA-Z0-9_.-]+', '_', 'g'), '_') AS token FROM
            (SELECT model_name AS name FROM models UNION ALL SELECT name FROM experiments) n) q""",
    "sanitized_texts": r"""
        SELECT doc_id, CASE WHEN token = '' THEN 'item' ELSE token END AS token FROM (
          SELECT doc_id, trim(regexp_replace(text, '[^a-zA-Z0-9_.-]+', '_', 'g'), '_') AS token FROM documents) q""",
    "retry_classes": """
        SELECT call_id, retryable,
               CASE WHEN retryable AND attempt < 5 THEN CAST(2.0 * pow(2.0, attempt) + 0.5 * attempt AS DOUBLE) END AS wait_seconds
        FROM (SELECT call_id, attempt, coalesce(status_code IN (429, 500, 503), false)
                OR regexp_matches(message, '429|RESOURCE_EXHAUSTED|Too Many Requests|503|TEMPORARILY_UNAVAILABLE') AS retryable
              FROM error_log) q""",
    "requirements_text": "SELECT CAST(run_id AS BIGINT) AS doc_id, requirements FROM described",
    "model_metadata": "SELECT run_id, flavors, requirements, python_version FROM described",
    "paged_extract": """
        SELECT model_name, creation_ms, NULL AS lost_token, NULL AS kind FROM models
        UNION ALL SELECT NULL, NULL, concat('p', CAST(ceil(count(*) / 100.0) AS BIGINT)), 'missing' FROM models
        UNION ALL SELECT DISTINCT NULL::VARCHAR, NULL::BIGINT, concat(x.letter, batch_id), CASE x.letter WHEN 'c' THEN 'loop' ELSE 'orphan' END
        FROM (SELECT CAST((row_number() OVER (ORDER BY model_name) - 1) // 100 AS BIGINT) AS batch_id FROM models) b
        CROSS JOIN (VALUES ('c'), ('s')) x(letter)""",
    "artifact_copy": """
        SELECT CAST(doc_id // 3 AS VARCHAR) AS run_id,
               CASE WHEN doc_id % 3 = 0 THEN 'model/MLmodel' WHEN doc_id % 6 = 1 THEN 'model/code/pkg/__init__.py'
                    WHEN doc_id % 3 = 1 THEN 'model/.cfg' ELSE concat('plots/_a/b/', source, '.png') END AS path,
               true AS ok, octet_length(encode(text)) AS bytes, octet_length(encode(text)) AS arrived_bytes FROM documents""",
    "copy_bins": """
        WITH f AS (
          SELECT concat('s3://moved/', doc_id) AS target_address,
                 CASE WHEN doc_id % 50 = 7 THEN n_chars * 1000000 WHEN doc_id % 50 = 8 THEN 1
                      WHEN doc_id % 50 <> 9 THEN octet_length(encode(text)) END AS size_bytes FROM documents
        ), r AS (
          SELECT target_address, coalesce(size_bytes, 0) AS size, greatest((coalesce(size_bytes, 0) + 268435455) // 268435456, 1) AS n_ranges
          FROM f
        ), x AS (SELECT *, unnest(range(0, n_ranges)) AS range_no FROM r
        ), y AS (SELECT *, range_no * 268435456 AS range_start, least(268435456, size - range_no * 268435456) AS range_length FROM x
        ), t AS (SELECT CAST(sum(range_length + 1048576) AS BIGINT) AS total FROM y
        ), n AS (SELECT total, greatest((total + 1073741823) // 1073741824, 1) AS bins FROM t
        ), w AS (SELECT (total + bins - 1) // bins AS width FROM n
        ), z AS (SELECT *, coalesce(sum(range_length + 1048576) OVER (
            ORDER BY target_address, range_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM y)
        SELECT target_address, CAST(range_no AS BIGINT) AS range_no, CAST(n_ranges AS BIGINT) AS n_ranges, CAST(range_start AS BIGINT) AS range_start,
               CAST(range_length AS BIGINT) AS range_length, CAST(before // width AS INT) AS bin FROM z, w""",
    "copy_large_files": """
        SELECT lang AS run_id, concat('model/', doc_id % 3) AS path, true AS ok,
               octet_length(encode(string_agg(text, chr(10) ORDER BY doc_id))) AS bytes, md5(string_agg(text, chr(10) ORDER BY doc_id)) AS digest
        FROM documents GROUP BY lang, doc_id % 3""",
    "track_stream": """
        SELECT t.source_host, t.model_name, t.readiness, t.source_versions, t.source_versions_migratable,
               CASE WHEN e.model_name IS NULL THEN t.target_versions ELSE e.target_versions END AS target_versions,
               CASE WHEN e.model_name IS NULL THEN t.migration_status ELSE e.migration_status END AS migration_status,
               CASE WHEN e.model_name IS NULL THEN t.migration_comments ELSE e.migration_comments END AS migration_comments
        FROM tracking_prev t LEFT JOIN (
          SELECT rtrim(m.source_host, '/') AS source_host, m.model_name, CAST(event_id % 9 AS INT) AS target_versions,
                 CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'COMPLETED' END AS migration_status,
                 CASE WHEN event_type = 'error' THEN props END AS migration_comments
          FROM events JOIN models m ON m.model_key = user_id
          QUALIFY row_number() OVER (PARTITION BY m.model_name ORDER BY epoch_ms(ts) DESC, event_id DESC) = 1
        ) e ON e.model_name = t.model_name AND e.source_host = t.source_host""",
}
QUERIES["migrate_all"] = QUERIES["migration_summary"]


def _table_digest(name: str, rows: str, columns: str) -> str:
    """Number of rows and sum of a hash of their text; ``columns`` are those of the table in order of name."""
    def cell(c: str) -> str:
        return f"coalesce(CAST({f'CAST(round({c} * 1000) AS BIGINT)' if c == 'value' and name in DOUBLES else c} AS VARCHAR), '~')"

    cells = ", ".join(cell(c) if c != "-" else "'~'" for c in columns.split())
    return f"""SELECT '{name}' AS table_name, count(*) AS n_rows,
      CAST(sum(CAST(concat('0x', substr(md5(concat_ws('|', {cells})), 1, 8)) AS BIGINT)) AS BIGINT) AS digest
      FROM (SELECT *, '{SOURCE_HOST}' AS of_host FROM ({rows}) r) q"""


DOUBLES = ("run_metrics", "metric_points")
# Every written table in its columns by name; of_host is the source's host, - a column that is NULL.
_WRITTEN = {
    "run_params": ("target_params", "key run_id of_host value"),
    "run_metrics": ("", "key run_id of_host value"),
    "metric_points": ("metric_history", "key run_id of_host step ts_ms value"),
    "run_tags": ("target_run_tags", "key run_id of_host value"),
    "run_artifacts": ("", "path run_id size_bytes of_host"),
    "experiment_tags": ("target_experiment_tags", "experiment_id key of_host value"),
    "experiments": ("target_experiments", "experiment_id name source_experiment_id of_host"),
    "runs": ("target_runs", "artifact_uri end_ms experiment_id lifecycle run_id run_name run_user of_host source_run_id start_ms status"),
    "version_tags": ("target_version_tags", "key model_name of_host value version"),
    "versions": ("target_versions", "creation_ms description model_name run_id of_host source_model_version source_uri stage user_id version"),
    "model_tags": ("target_model_tags", "key model_name of_host value"),
    "models": ("target_models", "creation_ms description model_name of_host source_model_name"),
}
_OTHER = {
    "run_metrics": "SELECT f.target_run_id AS run_id, m.key, m.value FROM run_metrics m JOIN fresh f ON f.run_id = m.run_id",
    "run_artifacts": f"SELECT target_run_id AS run_id, path, size_bytes FROM ({_MANIFEST.format(files='all_files')}) m",
}
QUERIES["committed_tables"] = "\nUNION ALL\n".join(
    _table_digest(name, QUERIES[query] if query else _OTHER[name], columns) for name, (query, columns) in _WRITTEN.items())
QUERIES["target_as_source"] = f"""
  SELECT * FROM (WITH v AS (
    SELECT model_name, CAST(run_id AS VARCHAR) AS run_id FROM made_versions
    UNION ALL SELECT model_name, run_id FROM ({QUERIES["target_versions"]}) c
  ), r AS (SELECT CAST(run_id AS VARCHAR) AS run_id FROM made_runs UNION ALL SELECT run_id FROM ({QUERIES["target_runs"]}) f
  ), p AS (
    SELECT run_id, count(*) AS n FROM (SELECT CAST(run_id AS VARCHAR) AS run_id FROM tgt_run_params
      UNION ALL SELECT run_id FROM ({QUERIES["target_params"]}) n) q GROUP BY run_id
  ), k AS (
    SELECT run_id, count(*) AS n FROM (SELECT CAST(run_id AS VARCHAR) AS run_id FROM tgt_run_metrics
      UNION ALL SELECT run_id FROM ({_OTHER["run_metrics"]}) n) q GROUP BY run_id
  ), m AS (SELECT model_name FROM tgt_models UNION ALL SELECT model_name FROM ({QUERIES["target_models"]}) n)
  SELECT '{THOST}' AS source_host, m.model_name, CAST(count(v.model_name) AS INT) AS source_versions,
         CAST(count(*) FILTER (WHERE v.model_name IS NOT NULL AND (v.run_id IS NULL OR r.run_id IS NOT NULL)) AS INT) AS source_versions_migratable,
         CAST(coalesce(sum(CASE WHEN r.run_id IS NOT NULL THEN p.n END), 0) AS INT) AS source_params,
         CAST(coalesce(sum(CASE WHEN r.run_id IS NOT NULL THEN k.n END), 0) AS INT) AS source_metrics
  FROM m LEFT JOIN v ON v.model_name = m.model_name LEFT JOIN r ON r.run_id = v.run_id
  LEFT JOIN p ON p.run_id = v.run_id LEFT JOIN k ON k.run_id = v.run_id
  WHERE position('.' IN m.model_name) = 0 GROUP BY m.model_name) q"""

# A resumed migration: only waiting models, and the target as it is afterwards.
RESUMED: dict[str, str] = {}
RESUMED["scope_versions"] = """
  SELECT * FROM src_versions WHERE position('.' IN model_name) = 0
    AND trim(model_name) IN (SELECT trim(model_name) FROM waiting)
"""
RESUMED["after_versions"] = """
  SELECT model_name, CAST(run_id AS VARCHAR) AS run_id FROM made_versions WHERE source_model_version <> ''
  UNION ALL SELECT target_model, target_run_id FROM created
"""
RESUMED["after_runs"] = """
  SELECT CAST(run_id AS VARCHAR) AS run_id, CAST(experiment_id AS VARCHAR) AS experiment_id FROM made_runs
  UNION ALL SELECT target_run_id, target_experiment_id FROM fresh
"""
RESUMED["after_counts"] = """
  SELECT run_id, sum(p) AS params, sum(m) AS metrics, count(DISTINCT child) AS files FROM (
    SELECT CAST(run_id AS VARCHAR) AS run_id, 1 AS p, 0 AS m, NULL AS child FROM tgt_run_params
    UNION ALL SELECT f.target_run_id, 1, 0, NULL FROM run_params q JOIN fresh f ON f.run_id = q.run_id
    UNION ALL SELECT CAST(run_id AS VARCHAR), 0, 1, NULL FROM tgt_run_metrics
    UNION ALL SELECT f.target_run_id, 0, 1, NULL FROM run_metrics q JOIN fresh f ON f.run_id = q.run_id
    UNION ALL SELECT CAST(run_id AS VARCHAR), 0, 0, split_part(path, '/', 2) FROM tgt_run_artifacts WHERE path LIKE 'model/_%'
    UNION ALL SELECT target_run_id, 0, 0, split_part(path, '/', 2) FROM all_files WHERE path LIKE 'model/_%') q
  GROUP BY run_id
"""
RESUMED["after_rollup"] = f"""
  SELECT v.model_name, count(*) AS versions,
         coalesce(sum(CASE WHEN r.run_id IS NOT NULL THEN coalesce(c.params, 0) END), 0) AS params,
         coalesce(sum(CASE WHEN r.run_id IS NOT NULL THEN coalesce(c.metrics, 0) END), 0) AS metrics,
         coalesce(sum(CASE WHEN r.run_id IS NOT NULL THEN coalesce(c.files, 0) END), 0) AS files,
         string_agg(DISTINCT '{THOST}/ml/experiments/' || r.experiment_id, ' | '
                    ORDER BY '{THOST}/ml/experiments/' || r.experiment_id) AS urls
  FROM after_versions v LEFT JOIN after_runs r ON r.run_id = v.run_id LEFT JOIN after_counts c ON c.run_id = v.run_id
  GROUP BY v.model_name
"""
RESUMED["after_models"] = """
  SELECT m.model_name FROM models m WHERE position('.' IN model_name) = 0
    AND trim(model_name) IN (SELECT trim(model_name) FROM waiting)
"""
QUERIES["migrate_pending"] = f"""
  SELECT t.source_host, t.model_name, t.readiness, t.source_versions, t.source_versions_migratable,
         CASE WHEN m.model_name IS NULL THEN t.target_versions ELSE CAST(coalesce(r.versions, 0) AS INT) END AS target_versions,
         CASE WHEN m.model_name IS NULL THEN t.migration_status
              WHEN coalesce(r.versions, 0) >= t.source_versions_migratable AND t.source_versions_migratable > 0 THEN 'COMPLETED'
              WHEN r.versions > 0 THEN 'PARTIAL' WHEN f.failed > 0 THEN 'FAILED' ELSE 'SKIPPED' END AS migration_status,
         CASE WHEN m.model_name IS NULL THEN t.migration_comments ELSE f.comments END AS migration_comments,
         CASE WHEN m.model_name IS NOT NULL THEN CAST(coalesce(c.n, 0) AS INT) END AS target_runs,
         CASE WHEN m.model_name IS NOT NULL THEN CAST(coalesce(r.params, 0) AS INT) END AS target_params,
         CASE WHEN m.model_name IS NOT NULL THEN CAST(coalesce(r.metrics, 0) AS INT) END AS target_metrics,
         CASE WHEN m.model_name IS NOT NULL THEN CAST(coalesce(r.files, 0) AS INT) END AS target_artifacts,
         CASE WHEN m.model_name IS NOT NULL THEN r.urls END AS target_experiment_urls
  FROM tracking_prev t
  LEFT JOIN after_models m ON m.model_name = t.model_name AND t.source_host = '{SOURCE_HOST}'
  LEFT JOIN after_rollup r ON r.model_name = concat('mig_', m.model_name)
  LEFT JOIN fail_comments f ON f.model_name = m.model_name
  LEFT JOIN (SELECT model_name, count(*) AS n FROM created GROUP BY 1) c ON c.model_name = m.model_name
"""

QUERIES["migrate_in_batches"] = QUERIES["migrate_pending"]


def with_views(text: str, parts: dict[str, str]) -> str:
    """The query with the views and parts it is made from in front."""
    known = {**VIEWS, **PARTS, **parts}
    reach, seen = {text}, set()
    while reach:
        words = set(re.findall(r"\w+", reach.pop()))
        for name in known:
            if name in words and name not in seen:
                seen.add(name)
                reach.add(known[name])
    ordered = _in_order([n for n in known if n in seen], known)
    views = ",\n".join(f"{n} AS ({known[n]})" for n in ordered)
    return f"WITH {views}\n{text}" if ordered else text


def _in_order(names: list[str], known: dict[str, str]) -> list[str]:
    """Each after those it is made from."""
    placed: list[str] = []

    def place(name: str) -> None:
        if name not in placed:
            words = set(re.findall(r"\w+", known[name]))
            for other in names:
                if other != name and other in words:
                    place(other)
            placed.append(name)

    for name in names:
        place(name)
    return placed


def all_oracles() -> dict[str, str]:
    return {
        name: with_views(text, RESUMED if name in ("migrate_pending", "migrate_in_batches") else {})
        for name, text in QUERIES.items()
    }
