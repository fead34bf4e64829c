"""Registered queries over the driver's tables."""

from stationflow.workload import (  # noqa: F401
    queries_forest,
    queries_learning,
    queries_marts,
    queries_metrics,
    queries_quality,
    queries_relational,
    queries_streaming,
    queries_tables,
    queries_text,
)
from stationflow.workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
