"""Structured Streaming jobs run over all published messages, compared with their batch result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stationflow.operators.rollups import observation_measures
from stationflow.operators.staging import stage_weather
from stationflow.schemas import EVENT_DAY, RAW_TABLE_SCHEMA
from stationflow.session import scratch_path
from stationflow.sources import messages as msg
from stationflow.sources.changelog import ChangeLog
from stationflow.sources.tables import PartitionedTable, _Files as Files, read_batches
from stationflow.streaming.ingest import STATE_STORE, dedup, run_to_end, settings, start, stream_ingest
from stationflow.streaming.latest import stream_latest
from stationflow.streaming.serving import stream_daily
from stationflow.workload.adapter import Data, raw_rows, rounded, rounded_sql, sql
from stationflow.workload.queries_tables import BATCH_FILES, FILE_MESSAGES, _TYPED_READING, publish_raw
from stationflow.workload.registry import query


def batch_files(spark: SparkSession, path: str, least: int = BATCH_FILES) -> int:
    """Files of a micro-batch: an eighth of those that have landed, within bounds. A trigger costs
    the same whether it has work for one core or for all, so what bounds it is the number of cores."""
    landed = sum(name.startswith("part-") for name in Files(spark, path).children(path))
    return max(least, min(landed // 8, BATCH_FILES * spark.sparkContext.defaultParallelism))


def _stream(d: Data, path: str, files: int | None = None) -> DataFrame:
    """The landed files as a stream of micro-batches, of so many files or ``batch_files``."""
    return msg.stream_messages(d.spark, "text", path, maxFilesPerTrigger=str(files or batch_files(d.spark, path)))


def _staged_stream(d: Data, path: str) -> DataFrame:
    return stage_weather(msg.accepted(msg.judge(_stream(d, path))).drop(EVENT_DAY))


def _whole_period(d: Data) -> str:
    """A watermark's delay that no observation is later than, in whatever order the files come."""
    first, last = d.table("events").agg(F.min("ts"), F.max("ts")).first()
    return f"{(last - first).days + 2 if first else 1} days"


@query("stream_ingest", sql(f"select {_TYPED_READING}, cast(cast(last_updated as timestamp) as date) as event_day from raw", "raw"))
def ingest(d: Data) -> DataFrame:
    """Good messages land in the raw table in several batches; flawed ones do not."""
    raw, checkpoint = scratch_path(d.spark, "raw"), scratch_path(d.spark, "offsets")
    stream = _stream(d, publish_raw(d, flawed=True))
    run_to_end(stream_ingest(stream, raw, scratch_path(d.spark, "rejects"), checkpoint))
    return rounded(read_batches(d.spark, raw, RAW_TABLE_SCHEMA))


@query(
    "micro_batch",
    "select count(*) as processed, true as several, true as bounded, 0 as repeated from events",
)
def micro_batch(d: Data) -> DataFrame:
    """Bounded batches until the input is used up; the counts are what the batches reported. A
    second run from the same checkpoint finds nothing more."""
    counted: dict[int, int] = {}
    again: dict[int, int] = {}
    path, checkpoint = scratch_path(d.spark, "topic"), scratch_path(d.spark, "offsets")
    for half in (0, 1):
        events = d.table("events").where(F.col("event_id") % 2 == half)
        msg.publish(msg.nest_message(raw_rows(events)), path=path, maxRecordsPerFile=str(FILE_MESSAGES))
    files = batch_files(d.spark, path, least=1)
    for into in (counted, again):
        run_to_end(start(_stream(d, path, files), lambda batch, n, into=into: into.update({n: batch.count()}), checkpoint))
    sizes = counted.values()
    row = (sum(sizes), len(sizes) > 1, max(sizes) <= files * FILE_MESSAGES, sum(again.values()))
    return d.spark.createDataFrame([row], "processed long, several boolean, bounded boolean, repeated int")


_LATEST = """province_name string, weather_updated_at timestamp_ntz, weather_condition string, temperature_celsius double,
precipitation_mm double, humidity_percent int, wind_speed_kph double"""


@query(
    "stream_latest",
    sql(
        """select province_name, weather_updated_at, weather_condition, temperature_celsius, round(precipitation_mm, 9) as
        precipitation_mm, humidity_percent, round(wind_speed_kph, 9) as wind_speed_kph from (select *, row_number() over
        (partition by province_name order by weather_updated_at desc, weather_condition, temperature_celsius desc) as pick
        from staged) where pick = 1""",
        "staged",
    ),
)
def latest(d: Data) -> DataFrame:
    """Several triggers; the snapshot is what the changes of all of them amount to."""
    log = ChangeLog(d.spark, scratch_path(d.spark, "latest"), ["province_name"], _LATEST)
    rows = _staged_stream(d, publish_raw(d, flawed=True))
    order = [("weather_updated_at", True), ("weather_condition", False), ("temperature_celsius", True)]
    run_to_end(stream_latest(rows, log, order, scratch_path(d.spark, "offsets")))
    return rounded(log.read())


_MEASURES = ("avg_temperature", "max_temperature", "min_temperature", "sum_precipitation", "avg_humidity", "avg_wind_kph", "avg_wind_mph")
_DAILY_STREAM = "province_name string, weather_date date, chance_rain int, " + ", ".join(f"{m} double" for m in _MEASURES)


@query(
    "stream_daily",
    sql(
        f"""select province_name, cast(weather_updated_at as date) as weather_date,
        max(case when precipitation_mm > 0 then 1 else 0 end) as chance_rain,
        round(avg(temperature_celsius), 9) as avg_temperature, max(temperature_celsius) as max_temperature,
        round(sum(precipitation_mm), 9) as sum_precipitation, round(avg(humidity_percent), 9) as avg_humidity,
        min(temperature_celsius) as min_temperature, round(avg(wind_speed_kph * 0.621371e0), 9) as avg_wind_mph,
        round(avg(wind_speed_kph), 9) as avg_wind_kph from staged group by all""",
        "staged",
    ),
)
def daily(d: Data) -> DataFrame:
    """The files are not in time order, so the watermark allows the whole period."""
    table = PartitionedTable(d.spark, scratch_path(d.spark, "daily"), ["weather_date"], _DAILY_STREAM)
    rows = _staged_stream(d, publish_raw(d, flawed=True))
    checkpoint = scratch_path(d.spark, "offsets")
    query = stream_daily(
        rows, table, ["province_name"], "weather_updated_at", observation_measures(), checkpoint, delay=_whole_period(d)
    )
    run_to_end(query)
    return rounded(table.read().select("province_name", "weather_date", "chance_rain", *_MEASURES))


@query(
    "stream_dedup",
    sql("select distinct province_name, weather_updated_at, weather_condition, temperature_celsius, humidity_percent from staged", "staged"),
)
def deduplicated(d: Data) -> DataFrame:
    """Every message is delivered twice; with the repeats dropped the batch result remains."""
    path, raw = publish_raw(d), scratch_path(d.spark, "raw")
    msg.publish(msg.read_messages(d.spark, path), path=path, maxRecordsPerFile=str(FILE_MESSAGES))
    once = dedup(_staged_stream(d, path), ["province_name", "weather_updated_at"], "weather_updated_at", _whole_period(d))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{raw}/batch={batch_id}")

    with settings(d.spark, STATE_STORE):  # the state holds a key for every message of the period
        run_to_end(start(once, write, scratch_path(d.spark, "offsets")))
    columns = ["province_name", "weather_updated_at", "weather_condition", "temperature_celsius", "humidity_percent"]
    return d.spark.read.parquet(raw).select(*columns)
