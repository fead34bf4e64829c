"""Scalar functions, filters, joins, aggregates, ordering."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from stationflow.functions import scalar as s
from stationflow.operators import relational as rel
from stationflow.operators.incremental import new_rows
from stationflow.operators.rollups import distinct_text, ordered_text
from stationflow.session import durable
from stationflow.workload.adapter import AS_OF, SPLIT, Data, rounded, rounded_sql, sql
from stationflow.workload.registry import query


@query(
    "scalar_functions",
    """select event_id, cast(trunc(value) as int) as whole_value, try_cast(event_type as int) as no_number,
    case when event_type = 'error' and value > 0 then 1 else 0 end as rained,
    round(value * 0.621371e0, 9) as miles, cast(ts as date) as day, strftime(cast(ts as date) + 7, '%Y-%m-%d') as next_week,
    coalesce(lower(nullif(event_type, 'view')) like '%er%', false) as has_er,
    strftime(ts + interval 7 hour, '%Y-%m-%d %H:%M:%S') as local_time,
    user_id || '-' || cast(ts as date) as user_day, string_split(event_type, 'r')[3] as third_part,
    json_extract_string(props, '$.k') as k, trim(coalesce(nullif(event_type, 'click'), 'Unknown ')) as kind
    from events""",
)
def scalar_functions(d: Data) -> DataFrame:
    day = s.to_day(F.col("ts"))
    rows = d.table("events").select(
        "event_id",
        s.convert(F.col("value"), "int").alias("whole_value"),
        s.convert(F.col("event_type"), "int", strict=False).alias("no_number"),
        s.indicator(F.when(F.col("event_type") == "error", F.col("value"))).alias("rained"),
        F.round(s.kph_to_mph(F.col("value")), 9).alias("miles"),
        day.alias("day"),
        s.iso_day(s.shift_day(day, 7)).alias("next_week"),
        s.contains_flag(F.nullif(F.col("event_type"), F.lit("view")), "er").alias("has_er"),
        s.local_time(F.col("ts")).alias("local_time"),
        s.composite_key(F.col("user_id"), day).alias("user_day"),
        s.element(F.split("event_type", "r"), 2).alias("third_part"),
        s.json_field(F.col("props"), "$.k").alias("json_k"),
        s.text_or(F.nullif(F.col("event_type"), F.lit("click")), "Unknown ").alias("kind"),
    )
    return rel.rename(rows, {"json_k": "k"})


@query("not_null_filter", sql("select district_code, en_name, latitude from raw_districts where latitude is not null and longitude is not null", "raw_districts"))
def not_null_filter(d: Data) -> DataFrame:
    return rel.not_null(d.raw_districts, ["latitude", "longitude"]).select("district_code", "en_name", "latitude")


@query(
    "lookback_filter",
    sql(f"select province_id, weather_date, max_temperature from daily where weather_date >= date '{AS_OF}' - 4", "daily"),
)
def lookback_filter(d: Data) -> DataFrame:
    """On the stored raw table, of which it reads the last days' partitions."""
    return d.landed().daily.where(s.within_lookback(F.col("weather_date"), AS_OF)).select("province_id", "weather_date", "max_temperature")


@query(
    "ilike_match",
    sql(
        """select province_name, count(*) as readings, max(temperature_celsius) as hottest from staged
        where province_name ilike 'nation_1_' group by province_name""",
        "staged",
    ),
)
def ilike_match(d: Data) -> DataFrame:
    matched = d.staged.where(rel.name_matches(F.col("province_name"), "nation_1_"))
    return matched.groupBy("province_name").agg(F.count("*").alias("readings"), F.max("temperature_celsius").alias("hottest"))


@query(
    "date_eq_optional",
    sql(
        """select 'one day' as asked, province_id, weather_date, max_temperature from daily where weather_date = date '2024-01-15'
        union all select 'any day', province_id, weather_date, max_temperature from daily""",
        "daily",
    ),
)
def date_eq_optional(d: Data) -> DataFrame:
    def asked(label: str, day: str | None) -> DataFrame:
        rows = rel.on_day(d.daily, "weather_date", day)
        return rows.select(F.lit(label).alias("asked"), "province_id", "weather_date", "max_temperature")

    return asked("one day", "2024-01-15").unionByName(asked("any day", None))


@query(
    "join_inner_name",
    sql(
        """select p.province_id, p.region, w.weather_updated_at, w.temperature_celsius from staged w
        join provinces p on w.province_name = p.province_name""",
        "staged",
        "provinces",
    ),
)
def join_inner_name(d: Data) -> DataFrame:
    places = d.provinces.select("province_name", "province_id", "region")
    joined = rel.attach(d.staged.select("province_name", "weather_updated_at", "temperature_celsius"), places, ["province_name"])
    return joined.drop("province_name")


@query(
    "join_inner_id",
    sql(
        """select i.province_id, p.province_name_vn, i.weather_date, i.max_temperature from daily i
        join provinces p on i.province_id = p.province_id""",
        "daily",
        "provinces",
    ),
)
def join_inner_id(d: Data) -> DataFrame:
    rows = d.daily.select("province_id", "weather_date", "max_temperature")
    return rel.attach(rows, d.provinces.select("province_id", "province_name_vn"), ["province_id"])


@query(
    "join_left_existing",
    sql(
        f"""select d.district_id, d.district_name, e.district_id is not null as known from districts d left join
        (select district_id from districts where latitude < 15) e on d.district_id = e.district_id""",
        "districts",
    ),
)
def join_left_existing(d: Data) -> DataFrame:
    existing = d.districts.where(F.col("latitude") < 15).select("district_id", F.lit(True).alias("_hit"))
    joined = rel.attach(d.districts.select("district_id", "district_name"), existing, ["district_id"], "left")
    return joined.withColumn("known", F.col("_hit").isNotNull()).drop("_hit")


@query(
    "join_left_composite",
    sql(
        f"""select e.province_id, e.weather_date, e.max_temperature, t.max_temperature as known_max from daily e left join
        (select * from daily where weather_date <= date '{SPLIT}') t
        on e.province_id = t.province_id and e.weather_date = t.weather_date""",
        "daily",
    ),
)
def join_left_composite(d: Data) -> DataFrame:
    rows = d.daily.select("province_id", "weather_date", "max_temperature")
    known = rows.where(F.col("weather_date") <= F.lit(SPLIT).cast("date")).withColumnRenamed("max_temperature", "known_max")
    return rel.attach(rows, known, ["province_id", "weather_date"], "left")


@query(
    "join_cross_scalar",
    sql(
        """select province_id, weather_date, last_day, date_diff('day', weather_date, last_day) as age from daily
        cross join (select max(weather_date) as last_day from daily)""",
        "daily",
    ),
)
def join_cross_scalar(d: Data) -> DataFrame:
    rows = rel.with_scalar(d.daily.select("province_id", "weather_date"), d.daily, last_day=F.max("weather_date"))
    return rows.withColumn("age", F.datediff("last_day", "weather_date").cast("long"))


@query(
    "scalar_subquery",
    sql(
        """select province_id, weather_date, max_temperature from daily
        where (select max(weather_date) from daily) is null or weather_date = (select max(weather_date) from daily)""",
        "daily",
    ),
)
def scalar_subquery(d: Data) -> DataFrame:
    return d.spark.sql(
        """SELECT province_id, weather_date, max_temperature FROM {daily}
        WHERE (SELECT max(weather_date) FROM {daily}) IS NULL
        OR weather_date = (SELECT max(weather_date) FROM {daily})""",
        daily=d.daily,
    )


@query(
    "anti_join_new",
    sql(
        f"""select province_id, weather_date, max_temperature from daily where (province_id, weather_date) not in
        (select province_id, weather_date from daily where weather_date <= date '{SPLIT}')""",
        "daily",
    ),
)
def anti_join_new(d: Data) -> DataFrame:
    rows = d.daily.select("province_id", "weather_date", "max_temperature")
    known = rows.where(F.col("weather_date") <= F.lit(SPLIT).cast("date"))
    return new_rows(rows, known, ["province_id", "weather_date"])


@query(
    "anti_join_orphans",
    sql(
        """select province_name as key, count(*) as rows from staged where province_name is not null
        and province_name not in (select province_name from provinces) group by province_name""",
        "staged",
        "provinces",
    ),
)
def anti_join_orphans(d: Data) -> DataFrame:
    return rel.orphans(d.staged, d.provinces, "province_name", "province_name")


_LOOKUP = "select {cols} from {fact} f join provinces p on f.province_id = p.province_id where p.province_name ilike {name}{day}"


@query(
    "lookup_current",
    sql(
        _LOOKUP.format(
            cols="f.province_id, p.province_name, weather_updated_at, temperature_celsius, humidity_percent, is_raining",
            fact="current_rows",
            name="'nation_7'",
            day="",
        ),
        "current_rows",
    ),
)
def lookup_current(d: Data) -> DataFrame:
    found = rel.lookup(d.current, d.provinces, "nation_7")
    return found.select(
        "province_id", "province_name", "weather_updated_at", "temperature_celsius", "humidity_percent", "is_raining"
    )


@query(
    "lookup_past",
    sql(
        _LOOKUP.format(
            cols="f.province_id, p.province_name, weather_date, max_temperature, chance_rain",
            fact="daily",
            name="'Nation_1%'",
            day=" and weather_date = date '2024-01-15'",
        ),
        "daily",
    ),
)
def lookup_past(d: Data) -> DataFrame:
    found = rel.lookup(d.daily_mart, d.provinces, "Nation_1%", "2024-01-15", "weather_date")
    return found.select("province_id", "province_name", "weather_date", "max_temperature", "chance_rain")


@query(
    "lookup_forecast",
    sql(
        _LOOKUP.format(
            cols=f"f.province_id, p.province_name, predicted_date, is_raining, {rounded_sql('max_temperature_c')}",
            fact="forecast",
            name="'NATION_3'",
            day="",
        ),
        "forecast",
    ),
)
def lookup_forecast(d: Data) -> DataFrame:
    found = rel.lookup(d.forecast, d.provinces, "NATION_3", None, "predicted_date")
    return rounded(found.select("province_id", "province_name", "predicted_date", "is_raining", "max_temperature_c"))


@query(
    "conditional_max",
    sql(
        """select province_name, max(case when precipitation_mm > 0 then 1 else 0 end) as rained,
        max(case when is_daytime then temperature_celsius end) as hottest_by_day from staged group by province_name""",
        "staged",
    ),
)
def conditional_max(d: Data) -> DataFrame:
    return d.staged.groupBy("province_name").agg(
        F.max(s.indicator(F.col("precipitation_mm"))).alias("rained"),
        F.max(F.when(F.col("is_daytime"), F.col("temperature_celsius"))).alias("hottest_by_day"),
    )


@query("global_max", sql("select max(weather_date) as max_date from daily", "daily"))
def global_max(d: Data) -> DataFrame:
    return d.daily.agg(F.max("weather_date").alias("max_date"))


@query("distinct_rows", sql("select distinct weather_condition, wind_direction, is_daytime from staged", "staged"))
def distinct_rows(d: Data) -> DataFrame:
    return d.staged.select("weather_condition", "wind_direction", "is_daytime").distinct()


@query(
    "group_by_alias",
    "select cast(ts as date) as weather_date, event_type, count(*) as readings from events group by weather_date, event_type",
)
def group_by_alias(d: Data) -> DataFrame:
    return d.spark.sql(
        "SELECT date(ts) AS weather_date, event_type, count(*) AS readings FROM {events} GROUP BY weather_date, event_type",
        events=d.table("events"),
    )


@query(
    "distinct_sorted_concat",
    "select lang, string_agg(source, ', ' order by source) as sources from (select distinct lang, source from documents) group by lang",
)
def distinct_sorted_concat(d: Data) -> DataFrame:
    """Repeats go before a language's sources meet in one task."""
    pairs = d.table("documents").select("lang", "source").distinct()
    return pairs.groupBy("lang").agg(distinct_text(F.col("source")).alias("sources"))


@query(
    "group_concat_ordered",
    sql(
        """select province_id, string_agg(strftime(weather_date, '%Y-%m-%d') || ' ' || predicted_condition, chr(10)||chr(10)
        order by weather_date) as diary from classified group by province_id""",
        "classified",
    ),
)
def group_concat_ordered(d: Data) -> DataFrame:
    line = F.concat(s.iso_day(F.col("weather_date")), F.lit(" "), F.col("predicted_condition"))
    return d.classified.groupBy("province_id").agg(ordered_text(F.col("weather_date"), line).alias("diary"))


@query(
    "order_by",
    sql(
        f"""select region, weather_date, {rounded_sql('avg_temperature', 'sum_precipitation')}, row_number() over
        (order by region, weather_date) - 1 as place from regional""",
        "regional",
    ),
)
def order_by(d: Data) -> DataFrame:
    """Sorted rows with the place they came in, read off the sorted partitions."""
    rows = d.region_mart.select("region", "weather_date", "avg_temperature", "sum_precipitation")
    ordered = durable(rounded(rows).orderBy("region", "weather_date").withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_at", 33).alias("_part")
    sizes = ordered.groupBy(part).agg(F.count("*").alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    placed = ordered.withColumn("_part", part).join(before, "_part")
    return placed.withColumn("place", F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_part", "_at", "_before")


@query(
    "preview_limit",
    sql(
        """select province_id, weather_date, max_temperature, row, greatest(total - 3, 0) as remaining from
        (select province_id, weather_date, max_temperature, cast(row_number() over (partition by province_id
        order by weather_date) as int) as row, count(*) over (partition by province_id) as total from daily) where row <= 3""",
        "daily",
    ),
)
def preview_limit(d: Data) -> DataFrame:
    rows = d.daily.select("province_id", "weather_date", "max_temperature")
    return rel.preview(rows, ["province_id"], [F.asc("weather_date")], 3)


@query(
    "format_rows",
    sql(
        """select province_id, weather_date, '- province_name: ' || province_name || chr(10) || '- weather_date: '
        || strftime(weather_date, '%Y-%m-%d') || chr(10) || '- chance_rain: ' || chance_rain || chr(10) || '- note: '
        || coalesce(nullif(predicted_condition, 'Sunny'), 'None') as lines from classified""",
        "classified",
    ),
)
def format_rows(d: Data) -> DataFrame:
    rows = d.classified.withColumn("note", F.nullif(F.col("predicted_condition"), F.lit("Sunny")))
    lines = rel.format_rows(rows, ["province_name", "weather_date", "chance_rain", "note"])
    return lines.select("province_id", "weather_date", "lines")
