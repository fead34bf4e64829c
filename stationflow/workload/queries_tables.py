"""Sources, sinks and materialised tables: written to the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, functions as F, types as T

from stationflow.operators.learning import OUTPUTS
from stationflow.schemas import EVENT_DAY, FORECAST_SCHEMA, MESSAGE_SCHEMA, RAW_SCHEMA, RAW_TABLE_SCHEMA
from stationflow.session import scratch_path
from stationflow.sources import messages as msg
from stationflow.sources import tables
from stationflow.sources.registry import Source, Sources
from stationflow.streaming.ingest import dead_letter
from stationflow.workload.adapter import Data, raw_rows, rounded, rounded_sql, sql, typed_rows
from stationflow.workload.registry import query

# All 25 columns. JSON has fewer digits than a double may need, so readings are compared rounded.
_DOUBLES = [f.name for f in RAW_SCHEMA.fields if f.dataType.typeName() == "double"]
_READING = ", ".join(f"round({c}, 9) as {c}" if c in _DOUBLES else c for c in RAW_SCHEMA.fieldNames())
_READING_COLUMNS = RAW_SCHEMA.fieldNames()
_TYPED_READING = _READING.replace("last_updated", "cast(last_updated as timestamp) as last_updated")

# Messages in a landed file, and files in a micro-batch, at least and for each core at most: bounds that do
# not grow with the data.
FILE_MESSAGES, BATCH_FILES = 20_000, 8


def publish_raw(d: Data, flawed: bool = False) -> str:
    """Land the observations as messages; returns the folder.

    With ``flawed`` there is one more body per event of the kinds that go wrong: empty bodies,
    cut-off text, missing fields, a time that is none.
    """
    events = d.table("events")
    path = scratch_path(d.spark, "topic")
    msg.publish(msg.nest_message(raw_rows(events)), path=path, maxRecordsPerFile=str(FILE_MESSAGES))
    if flawed:
        number = F.col("event_id").cast("string")
        poison = msg.nest_message(raw_rows(events.where("event_id % 4 = 1")).withColumn("last_updated", F.lit("yesterday")))
        flaw = (
            F.when(F.col("event_id") % 4 == 0, "null")
            .when(F.col("event_id") % 4 == 1, "{ }")
            .when(F.col("event_id") % 4 == 2, F.concat(F.lit('{"province_name": "cut off '), number))
            .otherwise(F.concat(F.lit('{"province_name": "P'), number, F.lit('", "temp_c": 1.5}')))
        )
        msg.publish(events.select(flaw.alias("value")), path=path, maxRecordsPerFile=str(FILE_MESSAGES))
        msg.publish(poison, path=path, maxRecordsPerFile=str(FILE_MESSAGES))
    return path


def landed(d: Data, flawed: bool = False) -> DataFrame:
    return msg.read_messages(d.spark, publish_raw(d, flawed))


@query("flatten_message", sql(f"select {_READING} from raw", "raw"))
def flatten_message(d: Data) -> DataFrame:
    return rounded(msg.flatten_message(msg.decode(landed(d))).select(*_READING_COLUMNS))


@query(
    "drop_empty",
    """select 'message' as kind, count(*) + count(*) filter (where event_id % 4 = 1) as bodies from events
    union all select 'cut off', count(*) from events where event_id % 4 = 2
    union all select 'incomplete', count(*) from events where event_id % 4 = 3""",
)
def drop_empty(d: Data) -> DataFrame:
    kind = (
        F.when(F.col("value").contains("cut off"), "cut off")
        .when(F.col("value").contains("last_updated"), "message")
        .otherwise("incomplete")
    )
    return msg.drop_empty(landed(d, flawed=True)).groupBy(kind.alias("kind")).agg(F.count("*").alias("bodies"))


@query(
    "sink_dead_letter",
    """select case when event_id % 4 = 2 then 'malformed' else 'last_updated,condition_text,humidity' end as reason,
    case when event_id % 4 = 2 then '{"province_name": "cut off ' || event_id
    else '{"province_name": "P' || event_id || '", "temp_c": 1.5}' end as value from events where event_id % 4 >= 2
    union all select 'unreadable last_updated', 'NATION_' || event_id % 26 from events where event_id % 4 = 1""",
)
def sink_dead_letter(d: Data) -> DataFrame:
    path = scratch_path(d.spark, "rejects")
    dead_letter(msg.rejected(msg.judge(landed(d, flawed=True))), path, "all")
    schema = T.StructType([*RAW_SCHEMA.fields, T.StructField("value", T.StringType()), T.StructField("_reason", T.StringType())])
    stored = d.spark.read.schema(schema).option("header", True).option("escape", '"').csv(f"{path}/batch=all")
    unread = F.col("_reason") == "unreadable last_updated"  # of these bodies, which are long, the place will do
    return stored.select(F.col("_reason").alias("reason"), F.when(unread, F.col("province_name")).otherwise(F.col("value")).alias("value"))


@query(
    "ingest_landed_payloads",
    sql(
        f"""select {_READING.replace("province_name", "p.province_name", 1)}
        from raw r left join provinces p on r.province_name = p.province_name""",
        "raw",
        "provinces",
    ),
)
def ingest_landed_payloads(d: Data) -> DataFrame:
    """Payloads as the API returns them are landed as JSON under the station that was asked for, then
    named by it; those of a station that the dimension lacks stay, without a name."""
    path = scratch_path(d.spark, "payloads")
    current = [f for f in MESSAGE_SCHEMA.fields if f.name != "province_name"]
    number = F.regexp_extract("province_name", r"(\d+)$", 1).cast("int").alias("province_id")
    parsed = msg.decode(landed(d)).drop("value", "_corrupt")
    parsed.select(number, F.struct(*[f.name for f in current]).alias("current")).write.json(path)
    schema = T.StructType([T.StructField("province_id", T.IntegerType()), T.StructField("current", T.StructType(current))])
    named = msg.ingest_payloads(d.spark.read.schema(schema).json(path), d.provinces)
    return rounded(msg.flatten_message(named).select(*_READING_COLUMNS))


_NESTED = [f.name for f in MESSAGE_SCHEMA.fields if isinstance(f.dataType, T.StructType)]
# As in _READING, what JSON has fewer digits of is compared rounded, the rest as the text it is.
_TEXTS = ", ".join(f"round({c}, 9) as {c}" if c in _DOUBLES else f"cast({c} as varchar) as {c}" for c in _READING_COLUMNS)


@query("publish_stream", sql(f"select {_TEXTS} from raw", "raw"))
def publish_stream(d: Data) -> DataFrame:
    """All fields of what was published, as text, read back without the message schema: one pass over
    a body's top fields and one over each nested object."""
    top = [f.name for f in MESSAGE_SCHEMA.fields]
    fields = landed(d).select(F.json_tuple("value", *top).alias(*top))
    for parent in _NESTED:
        inner = [f.name for f in MESSAGE_SCHEMA[parent].dataType.fields]
        fields = fields.select("*", F.json_tuple(parent, *inner).alias(*[f"{parent}_{c}" for c in inner])).drop(parent)
    return rounded(fields.select(*[F.col(c).cast("double").alias(c) if c in _DOUBLES else F.col(c) for c in _READING_COLUMNS]))


@query(
    "sink_append",
    sql(f"select {_TYPED_READING}, cast(cast(last_updated as timestamp) as date) as event_day from raw", "raw"),
)
def sink_append(d: Data) -> DataFrame:
    """Two batches, the first delivered twice: the replay leaves no duplicates, and all fields are kept."""
    path = scratch_path(d.spark, "raw")
    rows = typed_rows(d.table("events"))
    first, second = rows.where("is_day = 1"), rows.where("is_day = 0")
    for name, batch in (("0", first), ("1", second), ("0", first)):
        tables.append_batch(batch, path, name, [EVENT_DAY])
    return rounded(tables.read_batches(d.spark, path, RAW_TABLE_SCHEMA))


@query(
    "row_counters",
    "select count(*) as processed, count(*) filter (where event_id % 4 = 2) as malformed from events",
)
def row_counters(d: Data) -> DataFrame:
    """Counts taken while the rows are written, without a second pass."""
    counts = Observation("row-counters")
    judged = msg.judge(landed(d, flawed=True)).observe(
        counts,
        F.count_if(F.col("_reason").isNull()).alias("processed"),
        F.count_if(F.col("_reason") == "malformed").alias("malformed"),
    )
    judged.write.parquet(scratch_path(d.spark, "counted"))
    seen = counts.get
    return d.spark.createDataFrame([(seen["processed"], seen["malformed"])], "processed long, malformed long")


@query(
    "named_sources",
    """select n_name as nation, count(*) as customers, round(sum(c_acctbal), 2) as balance from customer
    join nation on c_nationkey = n_nationkey group by n_name""",
)
def named_sources(d: Data) -> DataFrame:
    nation = T.StructType(
        [T.StructField("n_nationkey", T.IntegerType()), T.StructField("n_name", T.StringType()), T.StructField("n_regionkey", T.IntegerType())]
    )
    declared = {("crm", "customer"): Source(d.path("customer")), ("geo", "nation"): Source(d.path("nation"), schema=nation)}
    Sources(d.spark, declared).register_views()
    return d.spark.sql(
        """SELECT n_name AS nation, count(*) AS customers, round(sum(c_acctbal), 2) AS balance
        FROM crm_customer JOIN geo_nation ON c_nationkey = n_nationkey GROUP BY n_name"""
    )


@query(
    "materialize_table",
    sql(f"select province_id, weather_date, chance_rain, {rounded_sql('avg_temperature', 'sum_precipitation')} from daily", "daily"),
)
def materialize_table(d: Data) -> DataFrame:
    """A view over the rollup, rebuilt as a table partitioned by day."""
    view = tables.materialize_view(d.daily, f"daily_view_{uuid.uuid4().hex}")  # a name of its own
    rows = view.select("province_id", "weather_date", "chance_rain", "avg_temperature", "sum_precipitation")
    return rounded(tables.materialize_table(rows, scratch_path(d.spark, "daily"), ["weather_date"]))


@query(
    "overwrite_reload",
    sql(f"select province_id, region, predicted_date, predicted_condition, {rounded_sql(*OUTPUTS)} from predictions", "predictions"),
)
def overwrite_reload(d: Data) -> DataFrame:
    """The forecast table, loaded twice: the second load replaces the first."""
    path = scratch_path(d.spark, "predictions")
    tables.overwrite_reload(d.predictions.withColumn("region", F.lit("stale")), path, FORECAST_SCHEMA)
    return rounded(tables.overwrite_reload(d.predictions, path, FORECAST_SCHEMA))


@query(
    "vector_upsert",
    """select e.vec_id, 'label_' || label as namespace, case when label < 5 then 'new ' else 'old ' end || source as file_name,
    array_to_string(list_transform(embedding, lambda x: cast(cast(round(cast(x as double) * 1000000) as bigint) as varchar)), ' ') as components,
    len(embedding) as dimensions, round(list_sum(list_transform(embedding, lambda x: cast(x as double))), 6) as total,
    round(embedding[1], 6) as first, round(embedding[64], 6) as last from embeddings e join documents d on e.vec_id = d.doc_id""",
)
def vector_upsert(d: Data) -> DataFrame:
    """Vectors with metadata under a namespace; half of the namespaces are ingested again."""
    named = d.table("embeddings").join(d.table("documents").select(F.col("doc_id").alias("vec_id"), "source"), "vec_id")
    space = F.concat(F.lit("label_"), F.col("label").cast("string")).alias("namespace")

    def records(prefix: str) -> DataFrame:
        file_name = F.concat(F.lit(prefix), F.col("source")).alias("file_name")
        return tables.bucketed(named.select("vec_id", space, "embedding", file_name, "label"), ["vec_id"])

    schema = "vec_id long, namespace string, embedding array<float>, file_name string, bucket int"
    table = tables.PartitionedTable(d.spark, scratch_path(d.spark, "vectors"), ["namespace", "bucket"], schema)
    table.overwrite(records("old "))
    out = table.upsert(records("new ").where("label < 5"), ["namespace", "bucket", "vec_id"])
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x)
    millionths = F.transform("embedding", lambda x: F.round(x.cast("double") * 1000000).cast("long").cast("string"))
    return out.select(
        "vec_id", "namespace", "file_name", F.array_join(millionths, " ").alias("components"), F.size("embedding").cast("long").alias("dimensions"), F.round(total, 6).alias("total"),
        F.round(F.get("embedding", F.lit(0)), 6).alias("first"), F.round(F.get("embedding", F.lit(63)), 6).alias("last"),
    )
