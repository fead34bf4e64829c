"""The sixteen metrics, entity joins, the saved query and the time spine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stationflow.operators.metrics import fill_days, time_spine
from stationflow.plans.semantic import CURRENT_SUMMARY
from stationflow.session import scratch_path
from stationflow.sources.tables import materialize_table
from stationflow.workload.adapter import Data, rounded, sql
from stationflow.workload.registry import query


def _metric(name: str, group_by: list[str], oracle: str, *ctes: str) -> None:
    """Register one metric by its dimensions."""

    @query(name, sql(oracle, *ctes))
    def run(d: Data) -> DataFrame:
        return rounded(d.semantic_layer.query([name], group_by))


_CURRENT = ["wind_speed_kph", "temperature_celsius", "precipitation_mm", "humidity_percent", "cloud_cover_percent", "uv_index"]
for _name, _keys in zip(
    _CURRENT,
    [["region"], ["weather_condition"], ["weather_date"], ["region", "is_raining"], ["is_daytime"], ["current_province_name"]],
):
    _columns = {"weather_date": "cast(weather_updated_at as date)", "current_province_name": "province_name"}
    _select = ", ".join(f"{_columns.get(k, k)} as {k}" for k in _keys)
    _metric(f"metric_{_name}", _keys, f"select {_select}, round(max({_name}), 9) as metric_{_name} from current_rows group by all", "current_rows")

_BUNDLE = ", ".join(f"round(max({c}), 9) as metric_{c}" for c in _CURRENT)

_metric(
    "current_weather_province",
    ["region", "weather_condition"],
    f"select region, weather_condition, {_BUNDLE} from current_rows group by all",
    "current_rows",
)
_metric(
    "avg_temperature_by_province_history",
    ["province_name", "metric_time__month"],
    """select province_name, date_trunc('month', weather_date)::date as metric_time__month, round(avg(avg_temperature), 9)
    as avg_temperature_by_province_history from daily group by all""",
    "daily",
)
_metric(
    "avg_humidity_by_province_history",
    ["province_name", "weather_date__week"],
    """select province_name, date_trunc('week', weather_date)::date as weather_date__week, round(avg(avg_humidity), 9)
    as avg_humidity_by_province_history from daily group by all""",
    "daily",
)
_metric(
    "total_precipitation_by_province_history",
    ["province_name", "condition"],
    """select province_name, predicted_condition as condition, round(sum(sum_precipitation), 9)
    as total_precipitation_by_province_history from classified group by all""",
    "classified",
)
_metric(
    "rainy_days_by_province",
    ["province_name"],
    """select province_name, cast(sum(case when sum_precipitation > 0 then 1 else 0 end) as bigint) as rainy_days_by_province
    from daily group by all""",
    "daily",
)
_metric(
    "avg_temp_by_region",
    ["region"],
    "select region, round(avg(avg_temperature_c), 9) as avg_temp_by_region from forecast group by all",
    "forecast",
)
_metric(
    "total_precip_by_day",
    ["predicted_date"],
    "select predicted_date, round(sum(total_precip_mm), 9) as total_precip_by_day from forecast group by all",
    "forecast",
)
_metric(
    "count_of_rainy_days",
    ["region"],
    "select region, cast(sum(cast(is_raining as int)) as bigint) as count_of_rainy_days from forecast group by all",
    "forecast",
)
_metric(
    "count_of_forecast_days",
    ["predicted_condition"],
    "select predicted_condition, count(is_raining) as count_of_forecast_days from forecast group by all",
    "forecast",
)
_metric(
    "rainy_day_percentage",
    ["province__province_name"],
    """select province_name as province__province_name,
    round(cast(sum(cast(is_raining as int)) as double) / count(is_raining), 9) as rainy_day_percentage
    from forecast f join provinces p on f.province_id = p.province_id group by all""",
    "forecast",
    "provinces",
)


@query(
    "metric_by_region_entity_join",
    sql(
        """select p.region as province__region, i.weather_date as metric_time, round(avg(i.avg_temperature), 9)
        as avg_temperature_by_province_history, cast(sum(case when sum_precipitation > 0 then 1 else 0 end) as bigint)
        as rainy_days_by_province from daily i left join provinces p on i.province_id = p.province_id group by all""",
        "daily",
        "provinces",
    ),
)
def by_region(d: Data) -> DataFrame:
    names = ["avg_temperature_by_province_history", "rainy_days_by_province"]
    return rounded(d.semantic_layer.query(names, ["province__region", "metric_time"]))


_ACROSS = """select {key} as {name}, round(h.warmth, 9) as avg_temperature_by_province_history, h.rainy as rainy_days_by_province,
    round(f.warmth, 9) as avg_temp_by_region, round(f.share, 9) as rainy_day_percentage{more_columns}
    from ({history}) h full join ({forecast}) f on h.k is not distinct from f.k{more_joins}"""
_HISTORY = """select {key} as k, avg(avg_temperature) as warmth, cast(sum(case when sum_precipitation > 0 then 1 else 0 end) as bigint)
    as rainy from daily i left join provinces p on i.province_id = p.province_id group by all"""
_FORECAST = """select {key} as k, avg(avg_temperature_c) as warmth, cast(sum(cast(is_raining as int)) as double) / count(is_raining) as share
    from forecast i left join provinces p on i.province_id = p.province_id group by all"""
_ACROSS_METRICS = ["avg_temperature_by_province_history", "rainy_days_by_province", "avg_temp_by_region", "rainy_day_percentage"]


@query(
    "metrics_across_models",
    sql(
        _ACROSS.format(
            key="coalesce(h.k, f.k, c.k)",
            name="region",
            history=_HISTORY.format(key="i.region"),
            forecast=_FORECAST.format(key="i.region"),
            more_columns=", round(c.warmth, 9) as metric_temperature_celsius",
            more_joins=""" full join (select region as k, max(temperature_celsius) as warmth from current_rows group by all) c
            on c.k is not distinct from coalesce(h.k, f.k)""",
        ),
        "daily", "provinces", "forecast", "current_rows",
    ),
)
def metrics_across_models(d: Data) -> DataFrame:
    """Past, forecast and current metrics of a region beside each other, from three models."""
    return rounded(d.semantic_layer.query([*_ACROSS_METRICS, "metric_temperature_celsius"], ["region"]))


@query(
    "metrics_across_models_by_month",
    sql(
        """select coalesce(h.place, f.place) as province__province_name, coalesce(h.k, f.k) as metric_time__month,
        round(h.warmth, 9) as avg_temperature_by_province_history, h.rainy as rainy_days_by_province,
        round(f.warmth, 9) as avg_temp_by_region, round(f.share, 9) as rainy_day_percentage from ("""
        + _HISTORY.format(key="p.province_name as place, date_trunc('month', i.weather_date)::date")
        + ") h full join ("
        + _FORECAST.format(key="p.province_name as place, date_trunc('month', i.predicted_date)::date")
        + ") f on h.k is not distinct from f.k and h.place is not distinct from f.place",
        "daily", "provinces", "forecast",
    ),
)
def metrics_across_models_by_month(d: Data) -> DataFrame:
    """Months that only one model has keep a row, with NULL metrics of the other."""
    return rounded(d.semantic_layer.query(_ACROSS_METRICS, ["province__province_name", "metric_time__month"]))


@query(
    "saved_query_current_summary",
    sql(
        f"""select province_name as current_weather_province__current_province_name, {_BUNDLE} from current_rows
        group by all""",
        "current_rows",
    ),
)
def current_summary(d: Data) -> DataFrame:
    """The saved query, exported as a table and read back."""
    summary = d.semantic_layer.run_saved(CURRENT_SUMMARY)
    return rounded(materialize_table(summary, scratch_path(d.spark, CURRENT_SUMMARY.name)))


_SPINE = "select date '2020-01-01' + cast(i as int) as date_day from range(5000) t(i)"


@query(
    "time_spine",
    f"""select coalesce(s.date_day, e.day) as date_day, coalesce(n, 0) as events from ({_SPINE}) s full join
    (select cast(ts as date) as day, count(*) as n from events group by all) e on e.day = s.date_day""",
)
def spine(d: Data) -> DataFrame:
    """Days with their events; days of events outside the spine stay."""
    per_day = d.table("events").groupBy(F.to_date("ts").alias("date_day")).agg(F.count("*").alias("events"))
    return fill_days(per_day, time_spine(d.spark), "date_day").fillna(0, ["events"])


@query(
    "metric_fill",
    sql(
        f"""select r.region, s.date_day as weather_date, round(sum(i.sum_precipitation), 9)
        as total_precipitation_by_province_history from (select distinct region from provinces) r cross join ({_SPINE}) s
        left join daily i on i.region = r.region and i.weather_date = s.date_day group by all""",
        "daily",
        "provinces",
    ),
)
def filled(d: Data) -> DataFrame:
    metric = d.semantic_layer.query(["total_precipitation_by_province_history"], ["region", "weather_date"])
    return rounded(fill_days(metric, time_spine(d.spark), "weather_date", d.provinces.select("region").distinct()))
