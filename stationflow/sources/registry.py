"""Declared sources, addressed by group and table name."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, types as T


@dataclass(frozen=True)
class Source:
    """Where a table lies, and the columns it must have."""

    path: str
    fmt: str = "parquet"
    schema: T.StructType | None = None
    options: dict[str, str] = field(default_factory=dict)


class Sources:
    """``sources.read("raw", "observations")`` gives the declared table, still distributed."""

    def __init__(self, spark: SparkSession, declared: dict[tuple[str, str], Source]):
        self.spark = spark
        self.declared = dict(declared)

    def read(self, group: str, table: str) -> DataFrame:
        try:
            source = self.declared[group, table]
        except KeyError:
            raise KeyError(f"no source {group}.{table} is declared") from None
        reader = self.spark.read.format(source.fmt).options(**source.options)
        if source.schema is not None:
            reader = reader.schema(source.schema)
        return reader.load(source.path)

    def register_views(self) -> list[str]:
        """Expose every declared source to SQL as ``<group>_<table>``."""
        names = []
        for group, table in self.declared:
            names.append(f"{group}_{table}")
            self.read(group, table).createOrReplaceTempView(names[-1])
        return names
