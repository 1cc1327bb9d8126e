"""Run options: plan parameters, checked once."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values (defaults a user of the migration relies on).
DEFAULT_EXPERIMENT_ROOT = "/Shared/mlflow-workspace-migration"
MAX_COPY_THREADS = 64


@dataclass(frozen=True)
class Options:
    """Parameters of discovery, transfer and reporting.

    ``copy_threads`` is the number of files that one task copies at once; how many
    tasks there are follows from the files. ``batch_size`` is the number of models
    whose outcome is committed together. ``artifact_root`` is the address below which
    copied files go; without one no file can be copied. A cap of None means "all".
    """

    experiment_root: str = DEFAULT_EXPERIMENT_ROOT
    model_prefix: str = ""
    experiment_prefix: str = ""
    artifact_root: str | None = None
    batch_size: int = 2000
    copy_threads: int = 10
    download_artifacts: bool = True
    include_run_artifacts: bool = True
    migrate_experiments: bool = True
    migrate_models: bool = True
    include_deleted_runs: bool = False
    create_missing_experiments: bool = True
    skip_existing_versions: bool = False
    max_runs_per_experiment: int | None = None
    max_versions_per_model: int | None = None
    model_names: tuple[str, ...] = ()
    extra_experiment_ids: tuple = ()

    def __post_init__(self) -> None:
        if self.batch_size < 1:
            raise ValueError("batch_size must be 1 or more")
        if not 1 <= self.copy_threads <= MAX_COPY_THREADS:
            raise ValueError(f"copy_threads must lie in 1..{MAX_COPY_THREADS}")
        for name in ("max_runs_per_experiment", "max_versions_per_model"):
            cap = getattr(self, name)
            if cap is not None and cap < 1:
                raise ValueError(f"{name} must be None or 1 or more")
