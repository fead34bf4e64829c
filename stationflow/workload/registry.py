"""Named queries over the driver's tables, each with its oracle where SQL can state one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stationflow.workload.adapter import Data

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a function of ``Data`` under ``name``."""

    def add(build: Callable[[Data], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, folder: build(Data(spark, folder))
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return add
