"""All corpus queries."""

from stationflow.llm import queries_dedup, queries_models, queries_native, queries_search, queries_sequences, queries_text  # noqa: F401
from stationflow.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
