"""Staging: cast and rename by a mapping, keep rows whose required columns are present."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from stationflow.operators.relational import not_null
from stationflow.schemas import EVENT_DAY, STAGE_DISTRICTS, STAGE_PROVINCES, STAGE_WEATHER

Mapping = Sequence[tuple[str, str, str]]


def stage(df: DataFrame, mapping: Mapping, required: Sequence[str] = (), loaded_at: str | None = None) -> DataFrame:
    """Project ``mapping`` rows of (staged name, type, source column)."""
    staged = not_null(df, required).selectExpr(*[f"cast({source} as {kind}) as {name}" for name, kind, source in mapping])
    return staged.withColumn(loaded_at, F.current_timestamp()) if loaded_at else staged


def stage_weather(raw: DataFrame) -> DataFrame:
    """All 25 raw columns cast and renamed; no row is dropped, repeats stay. The raw table's day goes
    along, so that filters on it prune its partitions."""
    day = [(EVENT_DAY, "date", EVENT_DAY)] if EVENT_DAY in raw.columns else []
    return stage(raw, [*STAGE_WEATHER, *day])


def stage_provinces(raw: DataFrame) -> DataFrame:
    return stage(raw, STAGE_PROVINCES, required=["en_name", "province_code"], loaded_at="loaded_at")


def stage_districts(raw: DataFrame) -> DataFrame:
    return stage(
        raw,
        STAGE_DISTRICTS,
        required=["en_name", "province_code", "latitude", "longitude"],
        loaded_at="loaded_at",
    )
