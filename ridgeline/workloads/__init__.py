"""The operators over the given tables, each with the SQL that must agree."""

from ridgeline.workloads import corpus, drift, history, metrics, scoring, splits, vectors, versions  # noqa: F401
from ridgeline.workloads.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
