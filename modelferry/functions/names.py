"""Names, paths and addresses of registry records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Path parts and patterns that target addresses must match.
ARTIFACT_MARK = "/artifacts/"
DEFAULT_MODEL_PATH = "model"
WORKSPACE_ID = "adb-([0-9]+)"
UNSAFE_CHARACTERS = "[^a-zA-Z0-9_.-]+"
RESERVED_TAG_PREFIX = "mlflow."


def normalize_host(host: Column) -> Column:
    """Host without trailing slashes."""
    return F.rtrim(host, F.lit("/"))


def normal_host(host: str) -> str:
    """E1 for a plain value given as a parameter."""
    return host.rstrip("/")


def target_experiment_name(name: Column, root: str, prefix: str = "") -> Column:
    """Root, prefix and last part of the source name."""
    leaf = F.element_at(F.split(F.rtrim(name, F.lit("/")), "/"), -1)
    return F.concat(F.lit(f"{root}/{prefix}"), leaf)


def target_model_name(name: Column, prefix: str) -> Column:
    """Prefix and source name."""
    return F.concat(F.lit(prefix), name)


def model_artifact_path(source_uri: Column) -> Column:
    """Path after the first '/artifacts/', or 'model' (E4)."""
    found = F.instr(source_uri, ARTIFACT_MARK)
    tail = F.trim(F.substr(source_uri, found + len(ARTIFACT_MARK)), F.lit("/"))
    return F.coalesce(
        F.when(found > 0, F.nullif(tail, F.lit(""))), F.lit(DEFAULT_MODEL_PATH)
    )


def model_source_uri(artifact_uri: Column, path: Column) -> Column:
    """Address of the model files of a run (E5)."""
    return F.concat_ws("/", artifact_uri, path)


def target_model_url(host: Column, model: Column) -> Column:
    """Model page, with the workspace id when the host holds one."""
    base = normalize_host(host)
    workspace = F.regexp_extract(base, WORKSPACE_ID, 1)
    query = F.when(workspace != "", F.concat(F.lit("?o="), workspace)).otherwise("")
    return F.concat(base, F.lit("/ml/models/"), model, query)


def target_experiment_url(host: Column, experiment_id: Column) -> Column:
    """Experiment page (one part of E7)."""
    return F.concat(
        normalize_host(host), F.lit("/ml/experiments/"), experiment_id.cast("string")
    )


def path_token(text: Column) -> Column:
    """Path-safe token; 'item' when nothing is left."""
    token = F.trim(F.regexp_replace(text, UNSAFE_CHARACTERS, "_"), F.lit("_"))
    return F.when(token == "", "item").otherwise(token)


def parent_path(path: Column) -> Column:
    """Folder of a path, NULL at the top."""
    return F.nullif(F.regexp_extract(path, "^(.*)/[^/]*$", 1), F.lit(""))


def folders_above(path: Column, with_itself: bool) -> Column:
    """'a/b/c' -> ['a', 'a/b'], and the path itself if asked for."""
    parts = F.split(path, "/")
    last = F.size(parts) if with_itself else F.size(parts) - 1
    depths = F.when(last > 0, F.sequence(F.lit(1), last))
    return F.transform(depths, lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))


def is_reserved_tag(key: Column) -> Column:
    """Keys the tracking server keeps for itself."""
    return key.startswith(RESERVED_TAG_PREFIX)


def stable_id(*parts: Column) -> Column:
    """Id that is the same on every attempt."""
    return F.sha2(F.concat_ws("/", *[p.cast("string") for p in parts]), 256)
