"""Daily and regional rollups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stationflow.functions.scalar import indicator, kph_to_mph, to_day
from stationflow.operators.partials import Kept
from stationflow.schemas import EVENT_DAY

# The daily facts' measures.
DAILY_MEASURES = (
    "avg_temperature",
    "max_temperature",
    "min_temperature",
    "sum_precipitation",
    "chance_rain",
    "avg_humidity",
    "avg_wind_kph",
    "avg_wind_mph",
)


def rollup(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    measures: Mapping[str, Column],
    day: str = "weather_date",
) -> DataFrame:
    """Aggregate ``measures`` by key and calendar day.

    Every measure has a fixed-size buffer, so Spark combines map-side and a station with most
    of the rows still ships one row per day and task.
    """
    return df.groupBy(*keys, to_day(F.col(ts)).alias(day)).agg(*[m.alias(name) for name, m in measures.items()])


def observation_measures() -> dict[str, Column]:
    temperature, rain, wind = F.col("temperature_celsius"), F.col("precipitation_mm"), F.col("wind_speed_kph")
    return {
        "avg_temperature": F.avg(temperature),
        "max_temperature": F.max(temperature),
        "min_temperature": F.min(temperature),
        "sum_precipitation": F.sum(rain),
        "chance_rain": F.max(indicator(rain)),
        "avg_humidity": F.avg("humidity_percent"),
        "avg_wind_kph": F.avg(wind),
        "avg_wind_mph": F.avg(kph_to_mph(wind)),
    }


def observation_states() -> dict[str, Kept]:
    """The daily measures as what partial states keep of them."""
    temperature, rain, wind = F.col("temperature_celsius"), F.col("precipitation_mm"), F.col("wind_speed_kph")
    return {
        "avg_temperature": Kept("average", temperature),
        "max_temperature": Kept("max", temperature),
        "min_temperature": Kept("min", temperature),
        "sum_precipitation": Kept("sum", rain),
        "chance_rain": Kept("max", indicator(rain)),
        "avg_humidity": Kept("average", F.col("humidity_percent")),
        "avg_wind_kph": Kept("average", wind),
        "avg_wind_mph": Kept("average", kph_to_mph(wind)),
    }


def with_day(staged: DataFrame) -> DataFrame:
    """Add ``weather_date``, by which observations are rolled up."""
    time = EVENT_DAY if EVENT_DAY in staged.columns else "weather_updated_at"
    return staged.withColumn("weather_date", to_day(F.col(time)))


def daily_rollup(staged: DataFrame, provinces: DataFrame) -> DataFrame:
    """One row per province and day; names unknown to the dimension are dropped.

    The observations are aggregated by name before the join, which is equal as long as names
    are unique in the dimension (a data test), and leaves days x stations rows to be joined
    rather than every observation.
    """
    time = EVENT_DAY if EVENT_DAY in staged.columns else "weather_updated_at"
    return daily_of_places(rollup(staged, ["province_name"], time, observation_measures()), provinces)


def daily_of_places(daily: DataFrame, provinces: DataFrame) -> DataFrame:
    """Daily rows by name with the dimension's columns; unknown names are dropped."""
    places = provinces.select("province_id", "region", "province_name")
    return daily.join(places, "province_name").select(
        "province_id", "region", "province_name", "weather_date", *DAILY_MEASURES
    )


def region_rollup(daily: DataFrame, provinces: DataFrame) -> DataFrame:
    """Daily rows by region: averages of daily averages (unweighted), extremes of extremes."""
    places = provinces.select("province_id", F.col("region").alias("dim_region"))
    rain, wind = F.col("sum_precipitation"), F.col("avg_wind_kph")
    return (
        daily.join(places, "province_id")
        .groupBy(F.col("dim_region").alias("region"), F.col("weather_date").cast("date").alias("weather_date"))
        .agg(
            F.avg("avg_temperature").alias("avg_temperature"),
            F.max("max_temperature").alias("max_temperature"),
            F.min("min_temperature").alias("min_temperature"),
            F.avg("avg_humidity").alias("avg_humidity"),
            F.sum(rain).alias("sum_precipitation"),
            F.max(indicator(rain)).alias("chance_rain"),
            F.avg(wind).alias("avg_wind_kph"),
            F.avg(kph_to_mph(wind)).alias("avg_wind_mph"),
        )
    )


def distinct_text(col: Column, sep: str = ", ") -> Column:
    """Aggregate: distinct values, sorted, joined by ``sep``."""
    return F.array_join(F.array_sort(F.collect_set(col)), sep)


def ordered_text(order: Column, text: Column, sep: str = "\n\n") -> Column:
    """Aggregate: texts joined by ``sep`` in ``order``."""
    ranked = F.array_sort(F.collect_list(F.struct(order.alias("pos"), text.alias("text"))))
    return F.array_join(F.transform(ranked, lambda r: F.coalesce(r["text"], F.lit(""))), sep)
