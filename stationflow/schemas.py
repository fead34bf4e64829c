"""Declared schemas. Nothing in this library infers a schema from data."""

from __future__ import annotations

from pyspark.sql import types as T

# The message fields, in message order.
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("province_name", T.StringType()),
        T.StructField("last_updated", T.StringType()),
        T.StructField("temp_c", T.DoubleType()),
        T.StructField("temp_f", T.DoubleType()),
        T.StructField("is_day", T.IntegerType()),
        T.StructField(
            "condition",
            T.StructType(
                [
                    T.StructField("text", T.StringType()),
                    T.StructField("icon", T.StringType()),
                    T.StructField("code", T.IntegerType()),
                ]
            ),
        ),
        T.StructField("wind_mph", T.DoubleType()),
        T.StructField("wind_kph", T.DoubleType()),
        T.StructField("wind_degree", T.IntegerType()),
        T.StructField("wind_dir", T.StringType()),
        T.StructField("pressure_mb", T.DoubleType()),
        T.StructField("pressure_in", T.DoubleType()),
        T.StructField("precip_mm", T.DoubleType()),
        T.StructField("precip_in", T.DoubleType()),
        T.StructField("humidity", T.IntegerType()),
        T.StructField("cloud", T.IntegerType()),
        T.StructField("feelslike_c", T.DoubleType()),
        T.StructField("feelslike_f", T.DoubleType()),
        T.StructField("vis_km", T.DoubleType()),
        T.StructField("vis_miles", T.DoubleType()),
        T.StructField("uv", T.DoubleType()),
        T.StructField("gust_mph", T.DoubleType()),
        T.StructField("gust_kph", T.DoubleType()),
    ]
)


def _raw_fields() -> list[T.StructField]:
    """The message with ``condition`` lifted to ``condition_<part>`` columns."""
    fields = []
    for field in MESSAGE_SCHEMA.fields:
        if isinstance(field.dataType, T.StructType):
            fields += [T.StructField(f"{field.name}_{f.name}", f.dataType) for f in field.dataType]
        else:
            fields.append(field)
    return fields


RAW_SCHEMA = T.StructType(_raw_fields())
RAW_COLUMNS = RAW_SCHEMA.fieldNames()

# The raw table: the message's time is read once, at ingest, and stored typed; its day is the
# partition, so that refreshes and look-backs read the days they need.
EVENT_DAY = "event_day"
RAW_TABLE_SCHEMA = T.StructType(
    [
        *[T.StructField(f.name, T.TimestampNTZType() if f.name == "last_updated" else f.dataType) for f in RAW_SCHEMA.fields],
        T.StructField(EVENT_DAY, T.DateType()),
    ]
)

# Columns a raw row must carry; a message without them is a dead letter.
RAW_REQUIRED = ["province_name", "last_updated", "temp_c", "condition_text", "humidity"]

# Staged name, staged type, raw column.
STAGE_WEATHER = [
    ("province_name", "string", "province_name"),
    ("weather_updated_at", "timestamp_ntz", "last_updated"),
    ("temperature_celsius", "double", "temp_c"),
    ("temperature_fahrenheit", "double", "temp_f"),
    ("is_daytime", "boolean", "is_day"),
    ("weather_condition", "string", "condition_text"),
    ("condition_icon_url", "string", "condition_icon"),
    ("condition_code", "int", "condition_code"),
    ("wind_speed_mph", "double", "wind_mph"),
    ("wind_speed_kph", "double", "wind_kph"),
    ("wind_direction_degrees", "int", "wind_degree"),
    ("wind_direction", "string", "wind_dir"),
    ("pressure_millibars", "double", "pressure_mb"),
    ("pressure_inches", "double", "pressure_in"),
    ("precipitation_mm", "double", "precip_mm"),
    ("precipitation_inches", "double", "precip_in"),
    ("humidity_percent", "int", "humidity"),
    ("cloud_cover_percent", "int", "cloud"),
    ("feels_like_celsius", "double", "feelslike_c"),
    ("feels_like_fahrenheit", "double", "feelslike_f"),
    ("visibility_km", "double", "vis_km"),
    ("visibility_miles", "double", "vis_miles"),
    ("uv_index", "double", "uv"),
    ("wind_gust_mph", "double", "gust_mph"),
    ("wind_gust_kph", "double", "gust_kph"),
    ("record_loaded_at", "timestamp_ntz", "last_updated"),
]

# Staged name, staged type, source column.
STAGE_PROVINCES = [
    ("province_id", "int", "province_code"),
    ("province_name", "string", "en_name"),
    ("province_name_vn", "string", "vn_name"),
    ("latitude", "double", "latitude"),
    ("longitude", "double", "longitude"),
    ("region", "string", "region"),
]

# Staged name, staged type, source column.
STAGE_DISTRICTS = [
    ("district_id", "int", "district_code"),
    ("province_id", "int", "province_code"),
    ("district_name", "string", "en_name"),
    ("district_name_vn", "string", "vn_name"),
    ("latitude", "double", "latitude"),
    ("longitude", "double", "longitude"),
]

# The forecast table as declared; its key stays an int like the dimension's.
FORECAST_SCHEMA = T.StructType(
    [
        T.StructField("province_id", T.IntegerType()),
        T.StructField("region", T.StringType()),
        T.StructField("predicted_date", T.DateType()),
        T.StructField("avgtemp_c", T.DoubleType()),
        T.StructField("maxtemp_c", T.DoubleType()),
        T.StructField("mintemp_c", T.DoubleType()),
        T.StructField("totalprecip_mm", T.DoubleType()),
        T.StructField("daily_chance_of_rain", T.DoubleType()),
        T.StructField("avghumidity", T.DoubleType()),
        T.StructField("maxwind_kph", T.DoubleType()),
        T.StructField("maxwind_mph", T.DoubleType()),
        T.StructField("predicted_condition", T.StringType()),
    ]
)

_MEASURES = "avg_temperature double, max_temperature double, min_temperature double"
DAILY_FACT_SCHEMA = (
    f"province_id int, province_name string, weather_date date, {_MEASURES}, sum_precipitation double, chance_rain int, "
    "avg_humidity double, avg_wind_kph double, avg_wind_mph double, region string, condition string, "
    "updated_at timestamp, is_new_row boolean"
)
REGION_FACT_SCHEMA = (
    f"region string, weather_date date, {_MEASURES}, avg_humidity double, sum_precipitation double, chance_rain int, "
    "avg_wind_kph double, avg_wind_mph double, updated_at timestamp"
)
