"""Latest row per key and lag features."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stationflow.functions.scalar import within_lookback

# Lag family, daily measure, position of its first lag in the newest-first array.
LAG_FAMILIES = [
    ("avgtemp", "avg_temperature", 0),
    ("maxtemp", "max_temperature", 1),
    ("mintemp", "min_temperature", 1),
    ("precip", "sum_precipitation", 1),
    ("rainchance", "chance_rain", 1),
    ("humidity", "avg_humidity", 1),
    ("windkph", "avg_wind_kph", 1),
    ("windmph", "avg_wind_mph", 1),
]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key in ``order``; end ``order`` with a tie-breaker for a fixed pick.

    For this form Spark cuts each map task to one row per key before the shuffle, so a hot key
    ships no more rows than there are map tasks.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_pick", F.row_number().over(window)).where(F.col("_pick") == 1).drop("_pick")


def lag_arrays(
    daily: DataFrame,
    key: str,
    day: str,
    arrays: Mapping[str, str],
    following: int = 3,
) -> DataFrame:
    """Per row, arrays of this and the next older rows' values, newest first, NULLs left out.

    All arrays share one window, hence one shuffle and sort. ``daily`` has one row per key and
    day, which bounds a key's window by the calendar.
    """
    window = Window.partitionBy(key).orderBy(F.desc(day)).rowsBetween(Window.currentRow, following)
    return daily.select("*", *[F.collect_list(measure).over(window).alias(name) for name, measure in arrays.items()])


def lag_features(
    daily: DataFrame,
    provinces: DataFrame,
    as_of: dt.date | str | None = None,
    lookback_days: int = 4,
    aligned: bool = False,
) -> DataFrame:
    """The newest day per province with three lags of each measure.

    Lags count available rows, not calendar days, and a NULL measure is skipped so that later
    lags move up. Average temperature starts at the newest day itself while the other families
    start one row back; ``aligned=True`` starts all of them at the newest day. A model must be fitted
    on rows of ``learning.training_table`` with the same ``aligned``.

    Only the newest row's arrays are wanted, so the four newest rows are picked and aggregated
    per province, which needs no second shuffle and no window over arrays. ``daily`` has one row
    per province and day, which bounds a group by the look-back.
    """
    measures = [measure for _, measure, _ in LAG_FAMILIES]
    places = provinces.select("province_id", F.col("region").alias("dim_region"))
    recent = daily.where(within_lookback(F.col("weather_date"), as_of, lookback_days)).join(places, "province_id")
    window = Window.partitionBy("province_id").orderBy(F.desc("weather_date"))
    newest = recent.withColumn("_row", F.row_number().over(window)).where(F.col("_row") <= 4)

    def newest_first(measure: str) -> Column:
        value = F.col(measure).cast("double")
        return F.sort_array(F.collect_list(F.when(value.isNotNull(), F.struct("weather_date", value.alias("v")))), asc=False)

    with_arrays = newest.groupBy("province_id").agg(
        F.max_by("dim_region", "weather_date").alias("region"),
        F.max("weather_date").alias("weather_date"),
        *[newest_first(measure).alias(f"_{measure}") for measure in measures],
    )
    return with_arrays.selectExpr(
        "province_id",
        "region",
        "weather_date",
        "1 as row_num",
        *[
            f"get(_{measure}, {(0 if aligned else first) + i}).v as {family}{i + 1}"
            for family, measure, first in LAG_FAMILIES
            for i in range(3)
        ],
    )
