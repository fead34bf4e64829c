"""Staging, rollups, windows, incremental refresh and the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stationflow.operators import incremental as inc
from stationflow.operators.learning import classify_daily
from stationflow.operators.rollups import DAILY_MEASURES, daily_rollup, region_rollup, rollup
from stationflow.operators.staging import stage_weather as staged_weather
from stationflow.operators.windows import LAG_FAMILIES, lag_arrays, latest_per_key
from stationflow.plans import marts
from stationflow.schemas import DAILY_FACT_SCHEMA, REGION_FACT_SCHEMA
from stationflow.session import durable, scratch_path
from stationflow.sources.tables import PartitionedTable, VersionedTable
from stationflow.workload.adapter import SPLIT, Data, rounded, rounded_sql, sql, typed_rows
from stationflow.workload.registry import query

_DOUBLES = ("avg_temperature", "max_temperature", "min_temperature", "sum_precipitation", "avg_humidity", "avg_wind_kph", "avg_wind_mph")
_DAILY = f"province_id, region, province_name, weather_date, chance_rain, {rounded_sql(*_DOUBLES)}"
_REGION = f"region, weather_date, chance_rain, {rounded_sql(*_DOUBLES)}"


def _before(df: DataFrame) -> DataFrame:
    return df.where(F.col("weather_date") <= F.lit(SPLIT).cast("date"))


@query("stage_weather", sql("select * from staged", "staged"))
def stage_weather(d: Data) -> DataFrame:
    return d.staged


@query("stage_provinces", sql("select * from provinces", "provinces"))
def stage_provinces(d: Data) -> DataFrame:
    return d.staged_provinces.drop("loaded_at")


@query("stage_districts", sql("select * from districts", "districts"))
def stage_districts(d: Data) -> DataFrame:
    return d.staged_districts.drop("loaded_at")


@query("daily_rollup", sql(f"select {_DAILY} from daily", "daily"))
def daily(d: Data) -> DataFrame:
    return rounded(daily_rollup(d.staged, d.provinces))


@query("region_rollup", sql(f"select {_REGION} from regional", "regional"))
def regional(d: Data) -> DataFrame:
    return rounded(region_rollup(d.daily, d.provinces))


@query(
    "daily_rollup_shipments",
    """select s_nationkey as station, cast(l_shipdate as date) as ship_day, avg(l_quantity) as avg_quantity, max(l_discount)
    as max_discount, min(l_discount) as min_discount, round(sum(l_extendedprice), 2) as revenue, count(*) as lines
    from lineitem join supplier on l_suppkey = s_suppkey group by all""",
)
def daily_rollup_shipments(d: Data) -> DataFrame:
    """The rollup on other names: lines by the supplier's nation and day of shipment. Lines are
    aggregated by supplier and day before the join, then by nation."""
    parts = {
        "quantity": F.sum("l_quantity"),
        "quantities": F.count("l_quantity"),
        "max_discount": F.max("l_discount"),
        "min_discount": F.min("l_discount"),
        "price": F.sum("l_extendedprice"),
        "n": F.count("*"),
    }
    by_supplier = rollup(d.table("lineitem"), ["l_suppkey"], "l_shipdate", parts, day="ship_day")
    suppliers = d.table("supplier").select("s_suppkey", F.col("s_nationkey").alias("station"))
    by_station = by_supplier.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).groupBy("station", "ship_day")
    return by_station.agg(
        F.try_divide(F.sum("quantity"), F.sum("quantities")).alias("avg_quantity"),
        F.max("max_discount").alias("max_discount"),
        F.min("min_discount").alias("min_discount"),
        F.round(F.sum("price"), 2).alias("revenue"),
        F.sum("n").alias("lines"),
    )


@query(
    "latest_per_key",
    """select user_id, event_id, ts, event_type, value from (select *, row_number() over (partition by user_id
    order by ts desc, event_id desc) as pick from events) where pick = 1""",
)
def latest(d: Data) -> DataFrame:
    rows = d.table("events").select("user_id", "event_id", "ts", "event_type", "value")
    return latest_per_key(rows, ["user_id"], [F.desc("ts"), F.desc("event_id")])


@query(
    "latest_shipment_per_part",
    """select l_partkey, l_orderkey, l_linenumber, l_shipdate, l_quantity, l_extendedprice from (select *, row_number() over
    (partition by l_partkey order by l_shipdate desc, l_orderkey desc, l_linenumber desc, l_suppkey desc, l_quantity desc,
    l_extendedprice desc) as pick from lineitem) where pick = 1""",
)
def latest_shipment_per_part(d: Data) -> DataFrame:
    columns = ["l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice"]
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice"]
    rows = d.table("lineitem").select(*columns)
    return latest_per_key(rows, ["l_partkey"], [F.desc(c) for c in order]).drop("l_suppkey")


@query(
    "dedup_by_key",
    sql(
        """select district_id, province_id, district_name, district_name_vn, latitude, longitude from (select *, row_number()
        over (partition by district_id order by province_id) as pick from
        (select * from districts union all select district_id, province_id + 1, district_name, district_name_vn, latitude,
        longitude from districts)) where pick = 1""",
        "districts",
    ),
)
def dedup_by_key(d: Data) -> DataFrame:
    repeated = d.staged_districts.unionByName(d.staged_districts.withColumn("province_id", F.col("province_id") + 1))
    return marts.district_rows(repeated).drop("created_at", "updated_at")


_HOLES = "select *, nullif(sum_precipitation, 0) as rain from daily"
_MEASURED = ["avg_temperature", "max_temperature", "min_temperature", "rain", "chance_rain", "avg_humidity", "avg_wind_kph", "avg_wind_mph"]


@query(
    "lag_arrays",
    sql(
        "select province_id, weather_date, "
        + ", ".join(f"cast(len(a_{m}) as bigint) as n_{m}, " + ", ".join(f"round(a_{m}[{i + 1}], 9) as {m}_{i}" for i in range(4)) for m in _MEASURED)
        + " from (select province_id, weather_date, "
        + ", ".join(f"list_filter(list(cast({m} as double)) over w, lambda x : x is not null) as a_{m}" for m in _MEASURED)
        + f" from ({_HOLES}) window w as (partition by province_id order by weather_date desc rows between current row and 3 following))",
        "daily",
    ),
)
def arrays(d: Data) -> DataFrame:
    """All eight measures, of which one has holes, with every element of their arrays."""
    rows = d.daily.withColumn("rain", F.nullif("sum_precipitation", F.lit(0.0))).withColumn("chance_rain", F.col("chance_rain").cast("double"))
    out = lag_arrays(rows, "province_id", "weather_date", {f"a_{m}": m for m in _MEASURED})
    columns = []
    for m in _MEASURED:
        columns += [F.size(f"a_{m}").cast("long").alias(f"n_{m}")]
        columns += [F.round(F.get(f"a_{m}", F.lit(i)), 9).alias(f"{m}_{i}") for i in range(4)]
    return out.select("province_id", "weather_date", *columns)


_LAGS = [f"{family}{i}" for family, _, _ in LAG_FAMILIES for i in (1, 2, 3)]


@query("lag_features", sql(f"select province_id, region, weather_date, row_num, {rounded_sql(*_LAGS)} from lags", "lags"))
def lags(d: Data) -> DataFrame:
    """On the stored raw table, of which it reads the last days' partitions."""
    return rounded(d.landed().lags)


@query(
    "current_mart",
    sql("select * from current_rows", "current_rows"),
)
def current(d: Data) -> DataFrame:
    return d.current.drop("created_at")


# Incremental refresh: the target holds the days up to a split, or dimension rows that differ.

_OLD_PROVINCES = """select province_id, case when province_id % 5 = 0 then province_name || ' old' else province_name end
as province_name, case when province_id % 5 = 1 then 'x' else province_name_vn end as province_name_vn,
latitude + case when province_id % 5 = 2 then 1 else 0 end as latitude, longitude,
case when province_id % 5 = 3 then null else region end as region, timestamp '2024-01-01' as created_at
from provinces where province_id < 20 union all select 900, 'GONE', 'GONE', 9e0, 103e0, 'NOWHERE', timestamp '2024-01-01'"""


def _old_provinces(d: Data) -> DataFrame:
    """An earlier state: some names, latitudes and regions differ, five are unknown, one is gone."""
    left = F.col("province_id") % 5
    now = d.provinces.where("province_id < 20").select(
        "province_id",
        F.when(left == 0, F.concat("province_name", F.lit(" old"))).otherwise(F.col("province_name")).alias("province_name"),
        F.when(left == 1, "x").otherwise(F.col("province_name_vn")).alias("province_name_vn"),
        (F.col("latitude") + F.when(left == 2, 1).otherwise(0)).alias("latitude"),
        "longitude",
        F.when(left == 3, F.lit(None)).otherwise(F.col("region")).alias("region"),
    )
    gone = d.spark.createDataFrame([(900, "GONE", "GONE", 9.0, 103.0, "NOWHERE")], now.schema)
    stamp = F.lit("2024-01-01").cast("timestamp")
    return now.unionByName(gone).withColumn("created_at", stamp).withColumn("updated_at", stamp)


_CHANGED = """p.province_name != o.province_name or p.latitude != o.latitude or p.longitude != o.longitude
or p.region != o.region"""


@query(
    "detect_changes",
    sql(
        f"""select 'as is' as mode, p.province_id, p.province_name from provinces p left join ({_OLD_PROVINCES}) o
        on p.province_id = o.province_id where o.province_id is null or {_CHANGED}
        union all select 'null safe', p.province_id, p.province_name from provinces p left join ({_OLD_PROVINCES}) o
        on p.province_id = o.province_id where o.province_id is null or (p.province_name, p.latitude, p.longitude, p.region)
        is distinct from (o.province_name, o.latitude, o.longitude, o.region)""",
        "provinces",
    ),
)
def detect_changes(d: Data) -> DataFrame:
    old = _old_provinces(d)

    def changed(mode: str, null_safe: bool) -> DataFrame:
        rows = inc.detect_changes(d.provinces, old, "province_id", marts.PROVINCE_COMPARE, null_safe)
        return rows.select(F.lit(mode).alias("mode"), "province_id", "province_name")

    return changed("as is", False).unionByName(changed("null safe", True))


@query(
    "preserve_created_at",
    sql(
        f"""select p.province_id, o.created_at is not null as kept from provinces p left join ({_OLD_PROVINCES}) o
        on p.province_id = o.province_id where o.province_id is null or {_CHANGED}""",
        "provinces",
    ),
)
def preserve_created_at(d: Data) -> DataFrame:
    rows = inc.detect_changes(d.provinces, _old_provinces(d), "province_id", marts.PROVINCE_COMPARE)
    return rows.select("province_id", (F.col("created_at") < F.col("updated_at")).alias("kept"))


@query(
    "upsert_dim",
    sql(
        f"""with old as ({_OLD_PROVINCES}), changed as (select p.* from provinces p left join old o
        on p.province_id = o.province_id where o.province_id is null or {_CHANGED})
        select coalesce(c.province_id, o.province_id) as province_id,
        case when c.province_id is null then o.province_name else c.province_name end as province_name,
        case when c.province_id is null then o.province_name_vn else c.province_name_vn end as province_name_vn,
        case when c.province_id is null then o.latitude else c.latitude end as latitude,
        case when c.province_id is null then o.longitude else c.longitude end as longitude,
        case when c.province_id is null then o.region else c.region end as region,
        o.province_id is not null as created_before
        from old o full join changed c on o.province_id = c.province_id""",
        "provinces",
    ).replace(" with old as", ", old as", 1),
)
def upsert_dim(d: Data) -> DataFrame:
    table = VersionedTable(d.spark, scratch_path(d.spark, "dim"))
    table.replace(_old_provinces(d))
    merged = marts.refresh_dimension(d.provinces, table, marts.PROVINCES)
    return merged.withColumn("created_before", F.col("created_at") == F.lit("2024-01-01").cast("timestamp")).drop(
        "created_at", "updated_at"
    )


_OLD_DISTRICTS = """select district_id, province_id, case when district_id % 4 = 0 then district_name || ' old' else district_name
end as district_name, case when district_id % 4 = 1 then 'x' else district_name_vn end as district_name_vn,
latitude, longitude from districts where district_id % 7 <> 0"""


@query(
    "upsert_districts",
    sql(
        f"""select d.*, o.district_id is not null as created_before, o.district_id is not null
        and (d.district_name <> o.district_name or d.district_name_vn <> o.district_name_vn) as refreshed
        from districts d left join ({_OLD_DISTRICTS}) o on d.district_id = o.district_id""",
        "districts",
    ),
)
def upsert_districts(d: Data) -> DataFrame:
    """The district dimension from an earlier state in which some names, local names and rows differ:
    a changed local name counts, and known rows keep their creation time."""
    stamp = F.lit("2024-01-01").cast("timestamp")
    left = F.col("district_id") % 4
    old = d.districts.where("district_id % 7 <> 0").withColumns(
        {
            "district_name": F.when(left == 0, F.concat("district_name", F.lit(" old"))).otherwise(F.col("district_name")),
            "district_name_vn": F.when(left == 1, "x").otherwise(F.col("district_name_vn")),
            "created_at": stamp,
            "updated_at": stamp,
        }
    )
    table = VersionedTable(d.spark, scratch_path(d.spark, "dim"))
    table.replace(old)
    merged = marts.refresh_dimension(d.districts, table, marts.DISTRICTS)
    flags = {"created_before": F.col("created_at") == stamp, "refreshed": (F.col("created_at") == stamp) & (F.col("updated_at") > stamp)}
    return merged.withColumns(flags).drop("created_at", "updated_at")


@query(
    "upsert_fact",
    sql(
        f"""select {_DAILY} from daily where weather_date > date '{SPLIT}' - 3 union all
        select {_DAILY.replace("round(max_temperature, 9)", "round(max_temperature + 1000, 9)")} from daily
        where weather_date <= date '{SPLIT}' - 3""",
        "daily",
    ),
)
def upsert_fact(d: Data) -> DataFrame:
    rows = d.daily
    table = PartitionedTable(d.spark, scratch_path(d.spark, "fact"), ["weather_date"], rows.schema)
    table.overwrite(_before(rows).withColumn("max_temperature", F.col("max_temperature") + 1000))
    fresh = rows.where(F.col("weather_date") > F.date_sub(F.lit(SPLIT).cast("date"), 3))
    return rounded(table.upsert(fresh, ["province_id", "weather_date"]))


_FACT_KEY = ["province_id", "weather_date"]


@query(
    "incremental_province",
    sql(
        f"""select {_DAILY.replace("round(max_temperature, 9)", f"round(max_temperature + case when weather_date <= date '{SPLIT}' then 1000 else 0 end, 9)")},
        predicted_condition as condition, true as is_new_row from classified""",
        "classified",
    ),
)
def incremental_province(d: Data) -> DataFrame:
    """Days up to the split stay as they were stored, later days are added; of the stored raw table
    the refresh reads the later days' partitions."""
    landed = d.landed()
    table = PartitionedTable(d.spark, scratch_path(d.spark, "daily"), ["weather_date"], DAILY_FACT_SCHEMA)
    stored = _before(landed.classified).withColumn("max_temperature", F.col("max_temperature") + 1000)
    marts.refresh_daily_mart(stored, d.provinces, table)
    return rounded(marts.refresh_daily_mart(landed.classified, d.provinces, table).drop("updated_at"))


@query("daily_mart", sql(f"select province_id, province_name, weather_date, region, predicted_condition as condition, chance_rain, {rounded_sql(*_DOUBLES)} from classified", "classified"))
def daily_mart(d: Data) -> DataFrame:
    return rounded(d.daily_mart.drop("updated_at", "is_new_row"))


def _region_table(d: Data) -> PartitionedTable:
    return PartitionedTable(d.spark, scratch_path(d.spark, "region"), ["weather_date"], REGION_FACT_SCHEMA)


@query("region_mart", sql(f"select {_REGION} from regional", "regional"))
def region_mart(d: Data) -> DataFrame:
    table, daily = _region_table(d), d.landed().daily
    marts.refresh_region_mart(_before(daily), d.provinces, table)
    return rounded(marts.refresh_region_mart(daily, d.provinces, table).drop("updated_at"))


def _late_batches(d: Data):
    """All observations as three batches that each hold rows of every day, the last one first, the
    second one twice; yields the daily fact, its table and each batch's days of it."""
    states = marts.daily_states(d.spark, scratch_path(d.spark, "states"), d.staged)
    table = PartitionedTable(d.spark, scratch_path(d.spark, "daily"), ["weather_date"], DAILY_FACT_SCHEMA)
    for batch in (2, 0, 1, 0):
        rows = staged_weather(typed_rows(d.table("events").where(F.col("event_id") % 3 == batch)))
        days = marts.refresh_daily_with_late(rows, batch, states, d.provinces, classify_daily, table)
        yield table, days


@query("late_days", sql(f"select {_DAILY}, predicted_condition as condition from classified", "classified"))
def late_days(d: Data) -> DataFrame:
    """Late rows add up in partial states: the fact equals the rollup of all observations at once."""
    for table, _ in _late_batches(d):
        pass
    return rounded(table.read().drop("updated_at", "is_new_row"))


@query("late_days_by_region", sql(f"select {_REGION} from regional", "regional"))
def late_days_by_region(d: Data) -> DataFrame:
    """The regional fact beside it, of which each batch replaces its days."""
    regions = _region_table(d)
    for _, days in _late_batches(d):
        marts.refresh_region_days(days, d.provinces, regions)
    return rounded(regions.read().drop("updated_at"))


def _emptied(d: Data) -> PartitionedTable:
    """An existing regional fact without rows."""
    table = _region_table(d)
    table.overwrite(marts.region_mart_rows(d.daily, d.provinces).limit(0))
    return table


@query("incremental_region_guarded", sql(f"select {_REGION} from regional", "regional"))
def incremental_region_guarded(d: Data) -> DataFrame:
    """An empty fact takes all days up to the split, and in the next refresh the days after it."""
    table = _emptied(d)
    marts.refresh_region_mart(_before(d.daily), d.provinces, table, guard_empty=True)
    return rounded(marts.refresh_region_mart(d.daily, d.provinces, table, guard_empty=True).drop("updated_at"))


@query(
    "incremental_region_unguarded_empty",
    sql(
        f"""select 'empty' as state, {_REGION} from regional where weather_date > null
        union all select 'seeded', {_REGION} from regional where weather_date >= date '{SPLIT}'""",
        "regional",
    ),
)
def incremental_region_unguarded_empty(d: Data) -> DataFrame:
    """An empty fact stays empty without the guard; once it holds a day, later days come in."""
    table = _emptied(d)
    empty = marts.refresh_region_mart(d.daily, d.provinces, table).withColumn("state", F.lit("empty"))
    stayed = durable(empty, "region-empty")
    one = d.daily.where(F.col("weather_date") == F.lit(SPLIT).cast("date"))
    table.upsert(marts.region_mart_rows(one, d.provinces), ["region", "weather_date"])
    seeded = marts.refresh_region_mart(d.daily, d.provinces, table).withColumn("state", F.lit("seeded"))
    return rounded(stayed.unionByName(seeded).drop("updated_at"))


@query(
    "new_row_flag",
    sql(f"select province_id, weather_date, weather_date > date '{SPLIT}' as is_new_row from daily", "daily"),
)
def new_row_flag(d: Data) -> DataFrame:
    rows = d.daily.select(*_FACT_KEY)
    return inc.flag_new_rows(rows, _before(rows), _FACT_KEY)


@query(
    "first_run_or_incremental",
    sql(
        """select run, province_id, province_name, latitude from (select 'first' as run, * from provinces union all
        select 'second', * from provinces union all select 'refresh', * replace (latitude + 1 as latitude) from provinces)""",
        "provinces",
    ),
)
def first_run_or_incremental(d: Data) -> DataFrame:
    """A first run, a run without changes, and a full rebuild of the same dimension."""
    table = VersionedTable(d.spark, scratch_path(d.spark, "dim"))
    columns = ["province_id", "province_name", "latitude"]
    first = marts.refresh_dimension(d.provinces, table, marts.PROVINCES).select(F.lit("first").alias("run"), *columns)
    second = marts.refresh_dimension(d.provinces, table, marts.PROVINCES).select(F.lit("second").alias("run"), *columns)
    moved = d.provinces.withColumn("latitude", F.col("latitude") + 1)
    rebuilt = marts.refresh_dimension(moved, table, marts.PROVINCES, full_refresh=True)
    return first.unionByName(second).unionByName(rebuilt.select(F.lit("refresh").alias("run"), *columns))


@query(
    "forecast_mart",
    sql(
        "select province_id, region, predicted_date, predicted_condition, is_raining, "
        + rounded_sql(
            "avg_temperature_c",
            "min_temperature_c",
            "max_temperature_c",
            "daily_chance_of_rain",
            "total_precip_mm",
            "avg_humidity",
            "max_wind_kph",
            "max_wind_mph",
        )
        + " from forecast",
        "forecast",
    ),
)
def forecast_mart(d: Data) -> DataFrame:
    return rounded(d.forecast.drop("created_at", "updated_at"))
