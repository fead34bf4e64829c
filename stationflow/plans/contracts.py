"""The 74 data tests on sources, staging and marts. Columns and bounds are fixed values."""

from __future__ import annotations

from stationflow.operators.quality import accepted_range, not_null, relationship, unique, unique_combination

SOURCE_CHECKS = [
    *not_null("raw_observations", "province_name", "last_updated", "temp_c", "condition_text", "humidity"),
    *not_null("raw_provinces", "province_code", "en_name", "vn_name", "latitude", "longitude"),
    *not_null("raw_districts", "district_code", "province_code", "en_name", "vn_name"),
]

STAGING_CHECKS = [
    *not_null(
        "stg_provinces", "province_id", "province_name", "province_name_vn", "latitude", "longitude", "loaded_at"
    ),
    *unique("stg_provinces", "province_id", "province_name"),
    *relationship("stg_provinces", "province_id", "stg_districts", "province_id"),
    *accepted_range("stg_provinces", "latitude", 8.0, 24.0),
    *accepted_range("stg_provinces", "longitude", 102.0, 110.0),
    *unique_combination("stg_provinces", "province_id", "loaded_at"),
    *not_null(
        "stg_weather",
        "province_name",
        "weather_updated_at",
        "temperature_celsius",
        "humidity_percent",
        "weather_condition",
        "record_loaded_at",
    ),
    *relationship("stg_weather", "province_name", "stg_provinces", "province_name"),
    *accepted_range("stg_weather", "temperature_celsius", -20, 50),
    *accepted_range("stg_weather", "humidity_percent", 0, 100),
    *accepted_range("stg_weather", "precipitation_mm", 0, 1000),
    *accepted_range("stg_weather", "wind_speed_kph", 0, 200),
    *accepted_range("stg_weather", "pressure_millibars", 870, 1090),
    *accepted_range("stg_weather", "cloud_cover_percent", 0, 100),
]

MART_CHECKS = [
    *unique("dim_districts", "district_id"),
    *not_null("dim_districts", "district_id"),
    *unique("dim_provinces", "province_id"),
    *not_null("dim_provinces", "province_id"),
    *not_null("fct_current_weather_province", "province_id"),
    *relationship("fct_current_weather_province", "province_id", "dim_provinces", "province_id"),
    *not_null(
        "fct_weather_province",
        "province_id",
        "province_name",
        "weather_date",
        "avg_temperature",
        "max_temperature",
        "min_temperature",
        "sum_precipitation",
        "avg_humidity",
        "avg_wind_kph",
        "avg_wind_mph",
        "region",
        "condition",
        "updated_at",
        "is_new_row",
    ),
    *relationship("fct_weather_province", "province_id", "dim_provinces", "province_id"),
    *not_null(
        "fct_weather_region",
        "region",
        "weather_date",
        "avg_temperature",
        "max_temperature",
        "min_temperature",
        "avg_humidity",
        "sum_precipitation",
        "avg_wind_kph",
        "avg_wind_mph",
        "updated_at",
    ),
    *relationship("fct_weather_region", "region", "dim_provinces", "region"),
    *not_null("forecast_7days", "province_id", "predicted_date"),
    *relationship("forecast_7days", "province_id", "dim_provinces", "province_id"),
]

ALL_CHECKS = [*SOURCE_CHECKS, *STAGING_CHECKS, *MART_CHECKS]
