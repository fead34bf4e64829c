import datetime as dt
import json

from pyspark.sql import functions as F

from stationflow.functions.scalar import within_lookback
from stationflow.operators.incremental import after_mark
from stationflow.operators.learning import classify_daily
from stationflow.operators.rollups import daily_rollup
from stationflow.operators.windows import lag_features
from stationflow.plans.marts import refresh_daily_mart
from stationflow.schemas import DAILY_FACT_SCHEMA, EVENT_DAY, RAW_COLUMNS, RAW_TABLE_SCHEMA
from stationflow.sources import messages as msg
from stationflow.sources.tables import read_batches
from stationflow.streaming.ingest import dedup, run_to_end, stream_ingest
from stationflow.streaming.serving import stream_daily
from stationflow.operators.staging import stage_weather
from stationflow.sources.tables import PartitionedTable

FULL = {
    "province_name": "A", "last_updated": "2024-01-01 10:15", "temp_c": 1.5, "temp_f": 34.7, "is_day": 1,
    "condition": {"text": "Light rain, later dry", "icon": "//i.png", "code": 1003}, "wind_mph": 1.0, "wind_kph": 1.6,
    "wind_degree": 10, "wind_dir": "N", "pressure_mb": 1000.0, "pressure_in": 29.5, "precip_mm": 0.1, "precip_in": 0.0,
    "humidity": 80, "cloud": 50, "feelslike_c": 1.0, "feelslike_f": 33.8, "vis_km": 10.0, "vis_miles": 6.0, "uv": 1.0,
    "gust_mph": 2.0, "gust_kph": 3.2,
}


def body(**changes):
    return json.dumps({**FULL, **changes})


def bodies(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_raw_columns():
    assert len(RAW_COLUMNS) == 25 and RAW_COLUMNS[5:8] == ["condition_text", "condition_icon", "condition_code"]


def test_empty_bodies_are_skipped(spark):
    values = [None, "null", "{}", " { } ", "", "[]", body()]
    assert msg.drop_empty(bodies(spark, values)).count() == 1


def test_bad_messages_are_rejected_one_by_one(spark):
    values = [body(), "null", body(condition=None), '{"province_name": "cut', body(last_updated=None, humidity=None)]
    judged = msg.judge(bodies(spark, values))
    assert sorted(r._reason for r in msg.rejected(judged).collect()) == [
        "condition_text", "last_updated,humidity", "malformed"
    ]
    good = msg.accepted(judged).collect()
    assert len(good) == 1 and good[0].condition_code == 1003 and msg.accepted(judged).columns == [*RAW_COLUMNS, EVENT_DAY]


def test_a_time_that_cannot_be_read_is_rejected(spark):
    judged = msg.judge(bodies(spark, [body(), body(last_updated="yesterday"), body(last_updated="2024-13-01", humidity=None)]))
    assert sorted(r._reason for r in msg.rejected(judged).collect()) == ["humidity,unreadable last_updated", "unreadable last_updated"]
    good = msg.accepted(judged)
    assert good.schema == RAW_TABLE_SCHEMA and str(good.first().event_day) == "2024-01-01"
    assert stage_weather(good).count() == 1  # staging never raises on what was accepted


def test_payloads_are_named_by_the_station_asked_for(spark):
    current = "struct(1.5D as temp_c) as current"
    payloads = spark.createDataFrame([(1,), (2,), (9,)], "province_id int").selectExpr("province_id", current)
    stations = spark.createDataFrame([(1, "A"), (2, "B")], "province_id int, province_name string")
    assert {r.province_name for r in msg.ingest_payloads(payloads, stations).collect()} == {"A", "B", None}


def test_nesting_is_the_reverse_of_flattening(spark):
    flat = msg.flatten_message(msg.decode(bodies(spark, [body()])))
    assert json.loads(msg.nest_message(flat).first().value) == FULL


def test_staging_keeps_repeats_and_types(spark):
    flat = msg.flatten_message(msg.decode(bodies(spark, [body(), body()])))
    staged = stage_weather(flat)
    types = dict(staged.dtypes)
    assert staged.count() == 2 and len(types) == 26
    assert (types["weather_updated_at"], types["is_daytime"], types["temperature_celsius"]) == ("timestamp_ntz", "boolean", "double")
    row = staged.first()
    assert row.weather_updated_at == row.record_loaded_at and row.is_daytime is True


def _land(folder, name, values):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(values) + "\n")


def _ingest(spark, tmp_path, counts):
    stream = msg.stream_messages(spark, "text", str(tmp_path / "in"), maxFilesPerTrigger="1")
    raw, rejects, checkpoint = (str(tmp_path / p) for p in ("raw", "rejects", "offsets"))
    run_to_end(stream_ingest(stream, raw, rejects, checkpoint, on_counts=lambda b, c: counts.append((b, c))))
    return read_batches(spark, raw, RAW_TABLE_SCHEMA)


def test_ingest_resumes_without_duplicates(spark, tmp_path):
    counts = []
    _land(tmp_path / "in", "a.json", [body(), body(province_name="B"), "{broken"])
    _land(tmp_path / "in", "b.json", [body(province_name="C"), "null"])
    assert _ingest(spark, tmp_path, counts).count() == 3
    assert _ingest(spark, tmp_path, counts).count() == 3  # nothing new
    _land(tmp_path / "in", "c.json", [body(province_name="D")])
    assert {r.province_name for r in _ingest(spark, tmp_path, counts).collect()} == {"A", "B", "C", "D"}
    assert sum(c["processed"] for _, c in counts) == 5 and sum(c["rejected"] for _, c in counts) == 1
    letters = list((tmp_path / "rejects").rglob("*.csv"))
    assert letters and letters[0].read_text().splitlines()[0].startswith("province_name,last_updated,temp_c")


def test_what_reads_the_raw_table_reads_the_days_it_needs(spark, tmp_path):
    """On the very table that the ingest writes."""
    days = [body(last_updated=f"2024-01-{d:02d} 10:00") for d in range(1, 31)]
    _land(tmp_path / "in", "a.json", days[:20])
    _land(tmp_path / "in", "b.json", days[20:])
    raw = _ingest(spark, tmp_path, [])
    provinces = spark.createDataFrame([(1, "A", "a", 1.0, 1.0, "N")], "province_id int, province_name string, province_name_vn string, latitude double, longitude double, region string")
    daily = daily_rollup(stage_weather(raw), provinces)

    def pruned(df, after):
        plan = df._jdf.queryExecution().executedPlan().toString()
        filters = [part.split("]")[0] for part in plan.split("PartitionFilters: [")[1:]]
        assert any(after in f and "event_day" in f for f in filters), plan

    pruned(daily.where(within_lookback(F.col("weather_date"), "2024-01-30")), ">= 2024-01-26")
    pruned(lag_features(daily, provinces, "2024-01-30"), ">= 2024-01-26")
    pruned(after_mark(classify_daily(daily), "weather_date", dt.date(2024, 1, 25)), "> 2024-01-25")
    table = PartitionedTable(spark, str(tmp_path / "fact"), ["weather_date"], DAILY_FACT_SCHEMA)
    refresh_daily_mart(classify_daily(daily).where("weather_date <= '2024-01-25'"), provinces, table)
    assert refresh_daily_mart(classify_daily(daily), provinces, table).count() == 30
    files = daily.where(F.col("weather_date") > "2024-01-25")
    assert files.count() == 5


def test_daily_stream_drops_rows_behind_the_watermark(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "t"), ["weather_date"], "province_name string, n long, weather_date date")

    def run():
        stream = msg.stream_messages(spark, "text", str(tmp_path / "in"), maxFilesPerTrigger="1")
        rows = stage_weather(msg.flatten_message(msg.decode(stream)))
        query = stream_daily(
            rows, table, ["province_name"], "weather_updated_at", {"n": F.count("*")}, str(tmp_path / "offsets"), "1 day"
        )
        run_to_end(query)
        return {(r.province_name, str(r.weather_date), r.n) for r in table.read().collect()}

    at = lambda t: body(last_updated=t)
    _land(tmp_path / "in", "a.json", [at("2024-01-01 23:59"), at("2024-01-02 00:00"), at("2024-01-10 12:00")])
    assert run() == {("A", "2024-01-01", 1), ("A", "2024-01-02", 1), ("A", "2024-01-10", 1)}
    _land(tmp_path / "in", "b.json", [at("2024-01-01 12:00"), at("2024-01-10 13:00"), at("2024-01-09 12:00")])
    expected = {("A", "2024-01-01", 1), ("A", "2024-01-02", 1), ("A", "2024-01-10", 2), ("A", "2024-01-09", 1)}
    assert run() == expected


def test_days_do_not_depend_on_the_session_zone(spark, tmp_path):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Bangkok")
    try:
        test_daily_stream_drops_rows_behind_the_watermark(spark, tmp_path)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_stream_repeats_collapse(spark, tmp_path):
    _land(tmp_path / "in", "a.json", [body(), body(), body(province_name="B")])
    _land(tmp_path / "in", "b.json", [body(), body(last_updated="2024-01-01 11:00")])
    stream = msg.stream_messages(spark, "text", str(tmp_path / "in"), maxFilesPerTrigger="1")
    rows = stage_weather(msg.flatten_message(msg.decode(stream)))
    once = dedup(rows, ["province_name", "weather_updated_at"], "weather_updated_at")
    query = once.writeStream.format("memory").queryName("once").option("checkpointLocation", str(tmp_path / "o"))
    query.trigger(availableNow=True).start().awaitTermination()
    assert spark.table("once").count() == 3
