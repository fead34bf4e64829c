"""The driver's tables in the shapes this library works on.

Each shape is stated once as SQL expressions that Spark and DuckDB read alike, so that a query
and its oracle start from the same rows. Where the dialects differ, both spellings are given.
Every 26th observation names a place the dimension lacks, and districts of suppliers with a
negative balance lack coordinates, so that dropping and reporting have something to find.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from stationflow.operators.learning import (
    classify_daily,
    complete,
    feature_table,
    label_encoder,
    recursive_forecast,
    weighted_mean_step,
)
from stationflow.operators.metrics import SemanticLayer
from stationflow.operators.rollups import daily_rollup
from stationflow.operators.staging import stage_districts, stage_provinces, stage_weather
from stationflow.operators.windows import lag_features
from stationflow.plans import marts, semantic
from stationflow.schemas import EVENT_DAY, RAW_TABLE_SCHEMA
from stationflow.session import durable, scratch_path
from stationflow.sources.messages import typed
from stationflow.sources.tables import append_batch, read_batches

AS_OF = "2024-01-30"
SPLIT = "2024-01-20"

K = "cast(regexp_extract(props, '([0-9]+)', 1) as int)"

RAW = [
    ("province_name", "concat('NATION_', cast(event_id % 26 as string))"),
    ("last_updated", ("date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS')", "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')")),
    ("temp_c", "value"),
    ("temp_f", "value * 1.8e0 + 32e0"),
    ("is_day", "case when hour(ts) between 6 and 17 then 1 else 0 end"),
    (
        "condition_text",
        "case event_type when 'error' then 'Moderate rain' when 'signup' then 'Light Rain shower'"
        " when 'click' then 'Sunny' when 'view' then 'Cloudy' else 'Overcast' end",
    ),
    ("condition_icon", "concat('//icons/', event_type, '.png')"),
    ("condition_code", "1000 + k"),
    ("wind_mph", "4e0 * sqrt(k) * 0.621371e0"),
    ("wind_kph", "4e0 * sqrt(k)"),
    ("wind_degree", "cast(event_id % 360 as int)"),
    (
        "wind_dir",
        "case when event_id % 360 < 90 then 'N' when event_id % 360 < 180 then 'E'"
        " when event_id % 360 < 270 then 'S' else 'W' end",
    ),
    ("pressure_mb", "860e0 + 2.4e0 * k"),
    ("pressure_in", "(860e0 + 2.4e0 * k) * 0.02953e0"),
    ("precip_mm", "case when event_type = 'error' then value else 0e0 end"),
    ("precip_in", "case when event_type = 'error' then value * 0.03937e0 else 0e0 end"),
    ("humidity", "k"),
    ("cloud", "k"),
    ("feelslike_c", "value - 1e0"),
    ("feelslike_f", "(value - 1e0) * 1.8e0 + 32e0"),
    ("vis_km", "10e0"),
    ("vis_miles", "6e0"),
    ("uv", "k / 10e0"),
    ("gust_mph", "6e0 * sqrt(k) * 0.621371e0"),
    ("gust_kph", "6e0 * sqrt(k)"),
]

PROVINCES = [
    ("province_code", "n_nationkey"),
    ("en_name", "n_name"),
    ("vn_name", "concat('Tinh ', n_name)"),
    ("latitude", "8e0 + 0.6e0 * n_nationkey"),
    ("longitude", "102e0 + 0.3e0 * n_nationkey"),
    ("region", "r_name"),
]

DISTRICTS = [
    ("district_code", "s_suppkey"),
    ("province_code", "s_nationkey"),
    ("en_name", "s_name"),
    ("vn_name", "concat('Huyen ', s_name)"),
    ("latitude", "case when s_acctbal < 0 then null else 8e0 + 0.6e0 * s_nationkey end"),
    ("longitude", "case when s_acctbal < 0 then null else 102e0 + 0.3e0 * s_nationkey end"),
]

QUESTION = (
    "case when c_acctbal < 0 then 'will it rain tomorrow?'"
    " when c_custkey % 4 = 0 then concat('What is the weather in ', lower(n_name), ' now?')"
    " when c_custkey % 8 = 1 then concat('How was it in ', n_name, ' in the past?')"
    " when c_custkey % 8 = 5 then concat('Forecast for ', n_name, '?')"
    " else concat('Weather in ', n_name, ' on ', {day}, ' please') end"
)
#: A question as it may be typed: with accents, a letter wrong or missing, or too many of them missing.
TYPED = (
    "case question_id % 5 when 0 then replace(replace(question, 'I', 'Í'), 'a', 'à')"
    " when 1 then replace(replace(question, 'TIO', 'TO'), 'tio', 'tyo')"
    " when 2 then replace(question, 'NATION', 'NATN') else question end"
)
ASKED_DAY = ("date_add(date '2024-01-10', cast(c_custkey % 30 as int))", "(date '2024-01-10' + cast(c_custkey % 30 as int))")
SPARK_DAY = (
    "case c_custkey % 3 when 0 then date_format({0}, 'dd/MM/yyyy') when 1 then date_format({0}, 'yyyy-MM-dd')"
    " else date_format({0}, 'dd-MM-yyyy') end"
).format(ASKED_DAY[0])
DUCK_DAY = (
    "case c_custkey % 3 when 0 then strftime({0}, '%d/%m/%Y') when 1 then strftime({0}, '%Y-%m-%d')"
    " else strftime({0}, '%d-%m-%Y') end"
).format(ASKED_DAY[1])


def _spark(expr) -> str:
    return expr[0] if isinstance(expr, tuple) else expr


def _duck(expr) -> str:
    return expr[1] if isinstance(expr, tuple) else expr


def _select(shape, side) -> list[str]:
    return [f"{side(expr)} as {name}" for name, expr in shape]


def raw_rows(events: DataFrame) -> DataFrame:
    """Observations as messages have them, with the time as text."""
    return events.selectExpr("*", f"{K} as k").selectExpr(*_select(RAW, _spark))


def typed_rows(events: DataFrame) -> DataFrame:
    """Observations as the raw table has them, with the time typed and its day."""
    shape = [(name, "cast(ts as timestamp_ntz)" if name == "last_updated" else expr) for name, expr in RAW]
    return typed(events.selectExpr("*", f"{K} as k").selectExpr(*_select(shape, _spark)))


class Tables(Mapping):
    """Tables by name, each planned when it is first asked for."""

    def __init__(self, build: dict[str, Callable[[], DataFrame]]):
        self._build = build

    def __getitem__(self, name: str) -> DataFrame:
        return self._build[name]()

    def __iter__(self):
        return iter(self._build)

    def __len__(self) -> int:
        return len(self._build)


class Data:
    """Lazily built inputs of one scale-factor folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}.parquet"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    @cached_property
    def raw(self) -> DataFrame:
        return typed_rows(self.table("events")).drop(EVENT_DAY)

    @cached_property
    def raw_table(self) -> DataFrame:
        """The raw table as the ingest stores it, by batch and day."""
        path = scratch_path(self.spark, "raw")
        append_batch(typed_rows(self.table("events")), path, "all", [EVENT_DAY])
        return read_batches(self.spark, path, RAW_TABLE_SCHEMA)

    @cached_property
    def raw_provinces(self) -> DataFrame:
        joined = self.table("nation").join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        return joined.selectExpr(*_select(PROVINCES, _spark))

    @cached_property
    def raw_districts(self) -> DataFrame:
        return self.table("supplier").selectExpr(*_select(DISTRICTS, _spark))

    @cached_property
    def staged(self) -> DataFrame:
        return stage_weather(self.raw)

    @cached_property
    def staged_provinces(self) -> DataFrame:
        return stage_provinces(self.raw_provinces)

    @cached_property
    def staged_districts(self) -> DataFrame:
        return stage_districts(self.raw_districts)

    @cached_property
    def provinces(self) -> DataFrame:
        return marts.province_rows(self.staged_provinces)

    @cached_property
    def districts(self) -> DataFrame:
        return marts.district_rows(self.staged_districts)

    @cached_property
    def daily(self) -> DataFrame:
        return daily_rollup(self.staged, self.provinces)

    @cached_property
    def classified(self) -> DataFrame:
        return classify_daily(self.daily)

    @cached_property
    def lags(self) -> DataFrame:
        return lag_features(self.daily, self.provinces, AS_OF)

    @cached_property
    def predictions(self) -> DataFrame:
        """The forecast with the weighted-mean step, whose recursion SQL can repeat."""
        features = complete(feature_table(self.lags))
        regions = label_encoder(self.raw_provinces.select("region"), "region", "region_enc")
        return recursive_forecast(regions.transform(features), weighted_mean_step())

    @cached_property
    def forecast(self) -> DataFrame:
        return marts.forecast_mart(self.predictions)

    @cached_property
    def current(self) -> DataFrame:
        return marts.current_mart(self.staged, self.provinces)

    @cached_property
    def daily_mart(self) -> DataFrame:
        return marts.daily_mart_rows(self.classified, self.provinces).withColumn("is_new_row", F.lit(True))

    @cached_property
    def region_mart(self) -> DataFrame:
        return marts.region_mart_rows(self.daily, self.provinces)

    @cached_property
    def questions(self) -> DataFrame:
        asked = self.table("customer").join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        return asked.selectExpr("c_custkey as question_id", f"{QUESTION.format(day=SPARK_DAY)} as question")

    @cached_property
    def typed_questions(self) -> DataFrame:
        return self.questions.selectExpr("question_id", f"{TYPED} as question")

    @cached_property
    def tables(self) -> Tables:
        return Tables(
            {
                "raw_observations": lambda: self.raw,
                "raw_provinces": lambda: self.raw_provinces,
                "raw_districts": lambda: self.raw_districts,
                "stg_provinces": lambda: self.staged_provinces,
                "stg_districts": lambda: self.staged_districts,
                "stg_weather": lambda: self.staged,
                "dim_districts": lambda: self.districts,
                "dim_provinces": lambda: self.provinces,
                "fct_current_weather_province": lambda: self.current,
                "fct_weather_province": lambda: self.daily_mart,
                "fct_weather_region": lambda: self.region_mart,
                "forecast_7days": lambda: self.forecast,
            }
        )

    def landed(self) -> Data:
        """The same tables on top of the stored raw table."""
        landed = Data(self.spark, self.folder)
        landed.raw = self.raw_table
        return landed

    def stored(self) -> Data:
        """The same tables with the marts written first, so that many checks on them do not
        each repeat the rollup of all observations."""
        stored = Data(self.spark, self.folder)
        stored.daily = durable(self.daily, "daily")
        stored.current = durable(self.current, "current")
        stored.predictions = durable(stored.predictions, "predictions")
        return stored

    @cached_property
    def semantic_layer(self) -> SemanticLayer:
        return SemanticLayer(semantic.MODELS, semantic.METRICS, self.tables)


# The same tables as SQL, in dependency order. Staging, rollups and marts are written out here
# independently of the Spark code they check.

_MPH = "0.621371e0"

CTES = {
    "raw": (f"select {', '.join(_select(RAW, _duck))} from (select *, {K} as k from events)", []),
    "raw_provinces": (
        f"select {', '.join(_select(PROVINCES, _duck))} from nation join region on n_regionkey = r_regionkey",
        [],
    ),
    "raw_districts": (f"select {', '.join(_select(DISTRICTS, _duck))} from supplier", []),
    "staged": (
        """select province_name, cast(last_updated as timestamp) as weather_updated_at,
        temp_c as temperature_celsius, temp_f as temperature_fahrenheit, cast(is_day as boolean) as is_daytime,
        condition_text as weather_condition, condition_icon as condition_icon_url, condition_code,
        wind_mph as wind_speed_mph, wind_kph as wind_speed_kph, wind_degree as wind_direction_degrees,
        wind_dir as wind_direction, pressure_mb as pressure_millibars, pressure_in as pressure_inches,
        precip_mm as precipitation_mm, precip_in as precipitation_inches, humidity as humidity_percent,
        cloud as cloud_cover_percent, feelslike_c as feels_like_celsius, feelslike_f as feels_like_fahrenheit,
        vis_km as visibility_km, vis_miles as visibility_miles, uv as uv_index, gust_mph as wind_gust_mph,
        gust_kph as wind_gust_kph, cast(last_updated as timestamp) as record_loaded_at from raw""",
        ["raw"],
    ),
    "provinces": (
        """select cast(province_code as int) as province_id, en_name as province_name, vn_name as province_name_vn,
        latitude, longitude, region from raw_provinces where en_name is not null and province_code is not null""",
        ["raw_provinces"],
    ),
    "districts": (
        """select cast(district_code as int) as district_id, cast(province_code as int) as province_id,
        en_name as district_name, vn_name as district_name_vn, latitude, longitude from raw_districts
        where en_name is not null and province_code is not null and latitude is not null
        and longitude is not null""",
        ["raw_districts"],
    ),
    "daily": (
        f"""select p.province_id, p.region, p.province_name, cast(w.weather_updated_at as date) as weather_date,
        avg(temperature_celsius) as avg_temperature, max(temperature_celsius) as max_temperature,
        min(temperature_celsius) as min_temperature, sum(precipitation_mm) as sum_precipitation,
        max(case when precipitation_mm > 0 then 1 else 0 end) as chance_rain,
        avg(humidity_percent) as avg_humidity, avg(wind_speed_kph) as avg_wind_kph,
        avg(wind_speed_kph * {_MPH}) as avg_wind_mph
        from staged w join provinces p on w.province_name = p.province_name group by all""",
        ["staged", "provinces"],
    ),
    "classified": (
        """select *, case when sum_precipitation > 100 then 'Heavy rain' when sum_precipitation > 0 then 'Light rain'
        when avg_humidity > 55 then 'Cloudy' when avg_temperature > 25 then 'Sunny' else 'Partly cloudy' end
        as predicted_condition from daily""",
        ["daily"],
    ),
    "regional": (
        f"""select p.region, i.weather_date, avg(avg_temperature) as avg_temperature,
        max(max_temperature) as max_temperature, min(min_temperature) as min_temperature,
        avg(avg_humidity) as avg_humidity, sum(sum_precipitation) as sum_precipitation,
        max(case when sum_precipitation > 0 then 1 else 0 end) as chance_rain,
        avg(avg_wind_kph) as avg_wind_kph, avg(avg_wind_kph * {_MPH}) as avg_wind_mph
        from daily i join provinces p on i.province_id = p.province_id group by p.region, i.weather_date""",
        ["daily", "provinces"],
    ),
    "current_rows": (
        """select province_id, region, province_name, weather_updated_at, wind_speed_kph, temperature_celsius,
        precipitation_mm, humidity_percent, cloud_cover_percent, uv_index, is_daytime, weather_condition,
        weather_condition ilike '%rain%' as is_raining
        from (select p.province_id, p.region, w.*, row_number() over (partition by p.province_id
        order by weather_updated_at desc, weather_condition, temperature_celsius desc, precipitation_mm desc,
        humidity_percent desc) as pick from staged w join provinces p on w.province_name = p.province_name)
        where pick = 1""",
        ["staged", "provinces"],
    ),
    "lag_base": (
        f"""select *, row_number() over (partition by province_id order by weather_date desc) as row_num
        from daily where weather_date >= date '{AS_OF}' - 4""",
        ["daily"],
    ),
    "lags": (
        "select province_id, region, weather_date, 1 as row_num, "
        + ", ".join(
            f"a_{family}[{first + i + 1}] as {family}{i + 1}"
            for family, first in [
                ("avgtemp", 0),
                ("maxtemp", 1),
                ("mintemp", 1),
                ("precip", 1),
                ("rainchance", 1),
                ("humidity", 1),
                ("windkph", 1),
                ("windmph", 1),
            ]
            for i in range(3)
        )
        + " from (select province_id, any_value(region) as region, max(weather_date) as weather_date, "
        + ", ".join(
            f"list(cast({measure} as double) order by weather_date desc)"
            f" filter (where row_num <= 4 and {measure} is not null) as a_{family}"
            for family, measure in [
                ("avgtemp", "avg_temperature"),
                ("maxtemp", "max_temperature"),
                ("mintemp", "min_temperature"),
                ("precip", "sum_precipitation"),
                ("rainchance", "chance_rain"),
                ("humidity", "avg_humidity"),
                ("windkph", "avg_wind_kph"),
                ("windmph", "avg_wind_mph"),
            ]
        )
        + " from lag_base group by province_id)",
        ["lag_base"],
    ),
}

_PREDICTED = {
    "avgtemp": "avgtemp_c",
    "maxtemp": "maxtemp_c",
    "mintemp": "mintemp_c",
    "precip": "totalprecip_mm",
    "rainchance": "daily_chance_of_rain",
    "humidity": "avghumidity",
    "windkph": "maxwind_kph",
    "windmph": "maxwind_mph",
}


def _mean(family: str) -> str:
    return f"({family}1 * 4e0 + {family}2 * 2e0 + {family}3 * 1e0) / 7e0"


CTES["forecast_days"] = (
    "select province_id, region, weather_date, 0 as step, "
    + ", ".join(f"{f}{i}" for f in _PREDICTED for i in (1, 2, 3))
    + " from lags where "
    + " and ".join(f"{f}{i} is not null" for f in _PREDICTED for i in (1, 2, 3))
    + " union all select province_id, region, weather_date, step + 1, "
    + ", ".join(f"{_mean(f)}, {f}1, {f}2" for f in _PREDICTED)
    + " from forecast_days where step < 7",
    ["lags"],
)
CTES["predictions"] = (
    "select province_id, region, weather_date + step as predicted_date, "
    + ", ".join(f"{f}1 as {out}" for f, out in _PREDICTED.items())
    + """, case when precip1 > 100 then 'Heavy rain' when precip1 > 0 then 'Light rain'
    when humidity1 > 55 then 'Cloudy' when avgtemp1 > 25 then 'Sunny' else 'Partly cloudy' end as predicted_condition
    from forecast_days where step > 0""",
    ["forecast_days"],
)
CTES["forecast"] = (
    """select province_id, region, predicted_date, avgtemp_c as avg_temperature_c, mintemp_c as min_temperature_c,
    maxtemp_c as max_temperature_c, daily_chance_of_rain, totalprecip_mm as total_precip_mm,
    avghumidity as avg_humidity, maxwind_kph as max_wind_kph, maxwind_mph as max_wind_mph, predicted_condition,
    predicted_condition ilike '%rain%' as is_raining from predictions""",
    ["predictions"],
)
CTES["questions"] = (
    f"select c_custkey as question_id, {QUESTION.format(day=DUCK_DAY)} as question"
    " from customer join nation on c_nationkey = n_nationkey",
    [],
)

CTES["typed"] = (f"select question_id, {TYPED} as question from questions", ["questions"])


def sql(body: str, *tables: str) -> str:
    """``body`` preceded by the CTEs of ``tables`` and of what they are made of."""
    wanted: dict[str, str] = {}

    def need(name: str) -> None:
        text, parents = CTES[name]
        for parent in parents:
            need(parent)
        wanted.setdefault(name, text)

    for table in tables:
        need(table)
    if not wanted:
        return body
    recursive = "recursive " if "forecast_days" in wanted else ""
    return f"with {recursive}" + ", ".join(f"{n} as ({t})" for n, t in wanted.items()) + " " + body


def rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    """Round the double columns, whose last bits depend on the order of summation."""
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def rounded_sql(*columns: str, digits: int = 9, prefix: str = "") -> str:
    return ", ".join(f"round({prefix}{c}, {digits}) as {c}" for c in columns)
