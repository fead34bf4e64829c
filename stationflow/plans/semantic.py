"""The declared semantic models and metrics. All names and aggregations are fixed values."""

from __future__ import annotations

from stationflow.operators.metrics import Dimension, Entity, Measure, Metric, SavedQuery, SemanticModel

PROVINCES = SemanticModel(
    name="dim_provinces",
    entities=(Entity("province", "primary", "province_id"),),
    dimensions=(
        Dimension("province_name", "categorical"),
        Dimension("province_name_vn", "categorical"),
        Dimension("region", "categorical"),
        Dimension("latitude", "categorical"),
        Dimension("longitude", "categorical"),
        Dimension("created_at", "time"),
        Dimension("updated_at", "time"),
    ),
)

CURRENT = SemanticModel(
    name="fct_current_weather_province",
    primary_entity="current_weather_province",
    entities=(Entity("current_weather_province", "foreign", "province_id"),),
    dimensions=(
        Dimension("region", "categorical"),
        Dimension("current_province_name", "categorical", "province_name"),
        Dimension("weather_date", "time", "weather_updated_at"),
        Dimension("weather_condition", "categorical"),
        Dimension("is_daytime", "categorical"),
        Dimension("is_raining", "categorical"),
        Dimension("created_at", "time"),
    ),
    measures=(
        Measure("wind_speed_kph", "max"),
        Measure("temperature_celsius", "max"),
        Measure("precipitation_mm", "max"),
        Measure("humidity_percent", "max"),
        Measure("cloud_cover_percent", "max"),
        Measure("uv_index", "max"),
    ),
    time_dimension="weather_date",
)

DAILY = SemanticModel(
    name="fct_weather_province",
    entities=(
        Entity("province_date", "primary", "province_id || '-' || weather_date"),
        Entity("province", "foreign", "province_id"),
    ),
    dimensions=(
        Dimension("province_name", "categorical"),
        Dimension("weather_date", "time"),
        Dimension("region", "categorical"),
        Dimension("condition", "categorical"),
    ),
    measures=(
        Measure("avg_temperature", "average"),
        Measure("max_temperature", "max"),
        Measure("min_temperature", "min"),
        Measure("sum_precipitation", "sum"),
        Measure("avg_humidity", "average"),
        Measure("avg_wind_kph", "average"),
        Measure("avg_wind_mph", "average"),
        Measure("chance_rain", "average"),
        Measure("rainy_day", "sum", "CASE WHEN sum_precipitation > 0 THEN 1 ELSE 0 END"),
    ),
    time_dimension="weather_date",
)

FORECAST = SemanticModel(
    name="forecast_7days",
    entities=(
        Entity("province_predicted_date", "primary", "province_id || '-' || predicted_date"),
        Entity("province", "foreign", "province_id"),
    ),
    dimensions=(
        Dimension("region", "categorical"),
        Dimension("predicted_date", "time"),
        Dimension("predicted_condition", "categorical"),
    ),
    measures=(
        Measure("predict_avg_temperature_c", "average", "avg_temperature_c"),
        Measure("predict_min_temperature_c", "min", "min_temperature_c"),
        Measure("predict_max_temperature_c", "max", "max_temperature_c"),
        Measure("predict_daily_chance_of_rain", "average", "daily_chance_of_rain"),
        Measure("predict_total_precip_mm", "sum", "total_precip_mm"),
        Measure("predict_avg_humidity", "average", "avg_humidity"),
        Measure("predict_max_wind_kph", "max", "max_wind_kph"),
        Measure("predict_max_wind_mph", "max", "max_wind_mph"),
        Measure("total_forecast_days", "count", "is_raining"),
        Measure("total_rainy_days", "sum", "is_raining"),
    ),
    time_dimension="predicted_date",
)

MODELS = (PROVINCES, CURRENT, DAILY, FORECAST)

METRICS = (
    Metric("metric_wind_speed_kph", measure="wind_speed_kph", label="Max Wind Speed"),
    Metric("metric_temperature_celsius", measure="temperature_celsius", label="Max Temperature"),
    Metric("metric_precipitation_mm", measure="precipitation_mm", label="Max Precipitation"),
    Metric("metric_humidity_percent", measure="humidity_percent", label="Max Humidity"),
    Metric("metric_cloud_cover_percent", measure="cloud_cover_percent", label="Max Cloud Cover"),
    Metric("metric_uv_index", measure="uv_index", label="Max UV Index"),
    Metric(
        "current_weather_province",
        kind="derived",
        inputs=(
            "metric_wind_speed_kph",
            "metric_temperature_celsius",
            "metric_precipitation_mm",
            "metric_humidity_percent",
            "metric_cloud_cover_percent",
            "metric_uv_index",
        ),
        label="Current Weather index by Province",
    ),
    Metric("avg_temperature_by_province_history", measure="avg_temperature", label="Average Temperature by Province"),
    Metric("avg_humidity_by_province_history", measure="avg_humidity", label="Average Humidity by Province"),
    Metric("total_precipitation_by_province_history", measure="sum_precipitation", label="Total Precipitation by Province"),
    Metric("rainy_days_by_province", measure="rainy_day", label="Rainy Days by Province"),
    Metric("avg_temp_by_region", measure="predict_avg_temperature_c", label="Average Temperature by Region"),
    Metric("total_precip_by_day", measure="predict_total_precip_mm", label="Total Precipitation by Day"),
    Metric("count_of_rainy_days", measure="total_rainy_days", label="Count of Rainy Days"),
    Metric("count_of_forecast_days", measure="total_forecast_days", label="Count of Forecast Days"),
    Metric(
        "rainy_day_percentage",
        kind="ratio",
        numerator="count_of_rainy_days",
        denominator="count_of_forecast_days",
        label="Rainy Day Percentage",
    ),
)

CURRENT_SUMMARY = SavedQuery(
    "current_weather_summary",
    metrics=("current_weather_province",),
    group_by=("current_weather_province__current_province_name",),
)
