"""Model registry transfer and reconciliation as Spark DataFrame jobs."""

from modelferry.options import Options
from modelferry.schemas import Snapshot

__all__ = ["Options", "Snapshot"]
