"""The assembled tables: dimensions, daily and regional facts, current snapshot, forecast."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from stationflow.functions.scalar import contains_flag
from stationflow.operators.incremental import after_mark, detect_changes, flag_new_rows
from stationflow.operators.rollups import daily_of_places, daily_rollup, observation_states, region_rollup, with_day
from stationflow.operators.windows import latest_per_key
from stationflow.session import durable
from stationflow.sources.states import StateTable
from stationflow.sources.tables import PartitionedTable, VersionedTable

# The columns whose difference makes a dimension row changed. The local-language
# name counts for districts but not for provinces.
PROVINCE_COMPARE = ["province_name", "latitude", "longitude", "region"]
DISTRICT_COMPARE = ["province_id", "district_name", "district_name_vn", "latitude", "longitude"]

# The columns a merge may change in a known dimension row.
PROVINCE_UPDATE = ["province_name", "province_name_vn", "latitude", "longitude", "region", "updated_at"]
DISTRICT_UPDATE = ["province_id", "district_name", "district_name_vn", "latitude", "longitude", "updated_at"]

# The current snapshot's columns.
CURRENT_COLUMNS = [
    "province_id",
    "region",
    "province_name",
    "weather_updated_at",
    "wind_speed_kph",
    "temperature_celsius",
    "precipitation_mm",
    "humidity_percent",
    "cloud_cover_percent",
    "uv_index",
    "is_daytime",
    "weather_condition",
]

Classify = Callable[[DataFrame], DataFrame]


def audited(df: DataFrame) -> DataFrame:
    now = F.current_timestamp()
    return df.withColumn("created_at", now).withColumn("updated_at", now)


def district_rows(staged: DataFrame) -> DataFrame:
    """One row per district. Repeats share a load time, so the pick is made fixed by the values."""
    rows = audited(staged.drop("loaded_at"))
    ties = [F.asc(c) for c in ("province_id", "district_name", "district_name_vn", "latitude", "longitude")]
    return latest_per_key(rows, ["district_id"], [F.desc("updated_at"), *ties])


def province_rows(staged: DataFrame) -> DataFrame:
    return audited(staged.drop("loaded_at"))


@dataclass(frozen=True)
class DimensionSpec:
    key: str
    compare: list[str]
    update: list[str]


PROVINCES = DimensionSpec("province_id", PROVINCE_COMPARE, PROVINCE_UPDATE)
DISTRICTS = DimensionSpec("district_id", DISTRICT_COMPARE, DISTRICT_UPDATE)


def refresh_dimension(
    rows: DataFrame, table: VersionedTable, spec: DimensionSpec, full_refresh: bool = False, null_safe: bool = False
) -> DataFrame:
    """First run: all rows. Later: merge new and changed rows, whose creation time is kept."""
    if full_refresh or not table.exists():
        return table.replace(rows)
    changed = detect_changes(rows, table.read(), spec.key, spec.compare, null_safe)
    return table.upsert(changed.distinct(), [spec.key], spec.update)


def daily_with_condition(staged: DataFrame, provinces: DataFrame, classify: Classify) -> DataFrame:
    """The daily rollup with its predicted condition."""
    return classify(daily_rollup(staged, provinces))


def daily_mart_rows(daily: DataFrame, provinces: DataFrame) -> DataFrame:
    """Daily rows in the fact's columns, with the dimension's name."""
    names = provinces.select("province_id", F.col("province_name").alias("dim_name"))
    return daily.join(names, "province_id").select(
        "province_id",
        F.col("dim_name").alias("province_name"),
        "weather_date",
        "avg_temperature",
        "max_temperature",
        "min_temperature",
        "sum_precipitation",
        "chance_rain",
        "avg_humidity",
        "avg_wind_kph",
        "avg_wind_mph",
        "region",
        F.col("predicted_condition").alias("condition"),
        F.current_timestamp().alias("updated_at"),
    )


def refresh_daily_mart(
    daily: DataFrame, provinces: DataFrame, table: PartitionedTable, full_refresh: bool = False, reprocess_days: int = 0
) -> DataFrame:
    """Merge the days after the fact's last day; an empty fact takes everything.

    Days up to the mark are never revised unless ``reprocess_days`` reopens them.
    """
    keys = ["province_id", "weather_date"]
    if full_refresh or not table.exists():
        return table.overwrite(flag_new_rows(daily_mart_rows(daily, provinces), None, keys))
    mark = table.max_of("weather_date")
    rows = daily_mart_rows(after_mark(daily, "weather_date", mark, True, reprocess_days), provinces)
    known = after_mark(table.read(), "weather_date", mark, True, reprocess_days)  # the same days, as a literal
    return table.upsert(flag_new_rows(rows, known, keys), keys)


def daily_states(spark: SparkSession, path: str, staged: DataFrame) -> StateTable:
    """Partial states of the daily measures by station name and day; ``staged`` gives the columns."""
    return StateTable(spark, path, ["province_name"], "weather_date", observation_states(), with_day(staged))


def refresh_daily_with_late(
    staged: DataFrame, batch: int, states: StateTable, provinces: DataFrame, classify: Classify, table: PartitionedTable
) -> DataFrame:
    """Add a batch of observations of any days to the daily fact; returns the fact's rows of these days.

    Unlike ``refresh_daily_mart`` no day is closed: late rows add up with what the day's states hold,
    and the fact has the day as one rollup of all rows so far would. States and fact are written one
    after the other; a run that ends between is made good by adding the batch again."""
    daily = classify(daily_of_places(states.add(with_day(staged), batch), provinces))
    keys = ["province_id", "weather_date"]
    rows = daily_mart_rows(daily, provinces)
    known = table.touched(rows) if table.exists() else None
    rows = durable(flag_new_rows(rows, known, keys), "late-days")
    table.upsert(rows, keys)
    return table.touched(rows)


def refresh_region_days(days: DataFrame, provinces: DataFrame, table: PartitionedTable) -> DataFrame:
    """Roll whole days of the daily fact up by region and put them in the place of what was there."""
    return table.upsert(region_mart_rows(days, provinces), ["region", "weather_date"])


def region_mart_rows(daily: DataFrame, provinces: DataFrame) -> DataFrame:
    return region_rollup(daily, provinces).withColumn("updated_at", F.current_timestamp())


def refresh_region_mart(
    daily: DataFrame,
    provinces: DataFrame,
    table: PartitionedTable,
    full_refresh: bool = False,
    guard_empty: bool = False,
    reprocess_days: int = 0,
) -> DataFrame:
    """Merge the days after the fact's last day.

    By default an existing but empty fact has no last day to compare with and stays empty;
    ``guard_empty=True`` lets everything in.
    """
    if full_refresh or not table.exists():
        return table.overwrite(region_mart_rows(daily, provinces))
    fresh = after_mark(daily, "weather_date", table.max_of("weather_date"), guard_empty, reprocess_days)
    return table.upsert(region_mart_rows(fresh, provinces), ["region", "weather_date"])


def current_rows(staged: DataFrame, provinces: DataFrame) -> DataFrame:
    """The newest observation per province.

    The newest row per name is picked before the join, so the join has one row per station;
    equal times are settled by the condition and the readings.
    """
    columns = [c for c in CURRENT_COLUMNS if c not in ("province_id", "region")]
    ties = [F.asc("weather_condition"), F.desc("temperature_celsius"), F.desc("precipitation_mm"), F.desc("humidity_percent")]
    newest = latest_per_key(staged.select(*columns), ["province_name"], [F.desc("weather_updated_at"), *ties])
    places = provinces.select("province_id", "region", "province_name")
    return newest.join(places, "province_name").select(*CURRENT_COLUMNS)


def current_mart(staged: DataFrame, provinces: DataFrame) -> DataFrame:
    rows = current_rows(staged, provinces)
    return rows.withColumn("is_raining", contains_flag(F.col("weather_condition"))).withColumn(
        "created_at", F.current_timestamp()
    )


def forecast_mart(predictions: DataFrame) -> DataFrame:
    """The forecast table under its public column names."""
    return predictions.select(
        "province_id",
        "region",
        "predicted_date",
        F.col("avgtemp_c").alias("avg_temperature_c"),
        F.col("mintemp_c").alias("min_temperature_c"),
        F.col("maxtemp_c").alias("max_temperature_c"),
        "daily_chance_of_rain",
        F.col("totalprecip_mm").alias("total_precip_mm"),
        F.col("avghumidity").alias("avg_humidity"),
        F.col("maxwind_kph").alias("max_wind_kph"),
        F.col("maxwind_mph").alias("max_wind_mph"),
        "predicted_condition",
        contains_flag(F.col("predicted_condition")).alias("is_raining"),
        F.current_timestamp().alias("created_at"),
        F.current_timestamp().alias("updated_at"),
    )
