"""JSON messages: decode, flatten, set rejects apart, publish."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from stationflow.schemas import EVENT_DAY, MESSAGE_SCHEMA, RAW_REQUIRED

# JSON values that count as empty. Anchored, so a long body is left at its first
# character that does not fit.
EMPTY_BODY = r"""^\s*(null|\{\s*\}|\[\s*\]|""|0|false)?\s*$"""


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Files of one JSON message per line, as a ``value`` column."""
    return spark.read.text(path)


def stream_messages(spark: SparkSession, fmt: str = "text", path: str | None = None, **options: str) -> DataFrame:
    """A stream of message bodies as a ``value`` column.

    ``fmt="kafka"`` takes the connector's options (``subscribe="data-weather"``,
    ``startingOffsets="earliest"``, ``maxOffsetsPerTrigger``); ``fmt="text"`` reads landed files
    from ``path`` (``maxFilesPerTrigger`` bounds a batch).
    """
    reader = spark.readStream.format(fmt).options(**options)
    stream = reader.load(path) if path else reader.load()
    return stream.select(F.col("value").cast("string").alias("value"))


def drop_empty(df: DataFrame) -> DataFrame:
    """Skip messages without content: no body at all, or an empty JSON value."""
    return df.where(F.col("value").isNotNull() & ~F.col("value").rlike(EMPTY_BODY))


def decode(df: DataFrame, schema: T.StructType = MESSAGE_SCHEMA) -> DataFrame:
    """Add the message's fields as columns; malformed text ends up in ``_corrupt``.

    The parsed message comes out of a generator, so that a filter on its fields is not pushed
    below it. Spark would otherwise parse the text again for every field the filter names.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    return df.select("*", F.inline_outer(F.array(F.from_json("value", with_corrupt, options))))


def flatten_message(df: DataFrame, schema: T.StructType = MESSAGE_SCHEMA, keep: Sequence[str] = ()) -> DataFrame:
    """The message's fields, nested ones as ``<parent>_<field>``."""
    columns = []
    for field in schema.fields:
        if isinstance(field.dataType, T.StructType):
            columns += [f"{field.name}.{f.name} as {field.name}_{f.name}" for f in field.dataType]
        else:
            columns.append(field.name)
    return df.selectExpr(*columns, *keep)


def judge(df: DataFrame, required: Sequence[str] = RAW_REQUIRED, time: str = "last_updated") -> DataFrame:
    """Flattened messages with ``_time``, the message's time, and ``_reason``: NULL for a good row,
    else why it is rejected. A time that cannot be read is rejected here, so that nothing that is
    accepted fails a later cast."""
    flat = flatten_message(decode(drop_empty(df)), keep=["value", "_corrupt"])
    flat = flat.withColumn("_time", F.col(time).try_cast("timestamp_ntz"))
    missing = [F.when(F.col(c).isNull(), F.lit(c)) for c in required]
    unread = F.when(F.col(time).isNotNull() & F.col("_time").isNull(), F.lit(f"unreadable {time}"))
    reason = F.when(F.col("_corrupt").isNotNull(), F.lit("malformed")).otherwise(
        F.nullif(F.concat_ws(",", *missing, unread), F.lit(""))
    )
    return flat.withColumn("_reason", reason).drop("_corrupt")


def accepted(judged: DataFrame, time: str = "last_updated") -> DataFrame:
    """Good rows as the raw table holds them: the time typed, and its day."""
    return typed(judged.where(F.col("_reason").isNull()).drop("_reason", "value").withColumn(time, F.col("_time")).drop("_time"), time)


def typed(raw: DataFrame, time: str = "last_updated") -> DataFrame:
    """Add the day that the raw table is partitioned by to rows whose time is a timestamp."""
    return raw.withColumn(EVENT_DAY, F.to_date(time))


def rejected(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("_reason").isNotNull()).drop("_time")


def nest_message(raw: DataFrame, schema: T.StructType = MESSAGE_SCHEMA) -> DataFrame:
    """Raw flat rows as message bodies, the reverse of ``flatten_message``."""
    fields = []
    for field in schema.fields:
        if isinstance(field.dataType, T.StructType):
            parts = [F.col(f"{field.name}_{f.name}").alias(f.name) for f in field.dataType]
            fields.append(F.struct(*parts).alias(field.name))
        else:
            fields.append(F.col(field.name))
    return raw.select(F.to_json(F.struct(*fields)).alias("value"))


def publish(messages: DataFrame, fmt: str = "text", path: str | None = None, **options: str) -> None:
    """Write message bodies: gzip text files, or a topic with the connector's options."""
    defaults: Mapping[str, str] = {"compression": "gzip"} if fmt == "text" else {"kafka.acks": "all", "kafka.compression.type": "gzip"}
    writer = messages.select("value").write.format(fmt).options(**{**defaults, **options})
    if path:
        writer.mode("append").save(path)
    else:
        writer.save()


def ingest_payloads(payloads: DataFrame, stations: DataFrame, key: str = "province_id") -> DataFrame:
    """Landed API payloads to messages: the ``current`` object with the name of the station that was
    asked for, found by its key. ``province_name`` is NULL where no station has the key, so such a
    payload ends up among the rejects instead of vanishing."""
    named = payloads.join(stations.select(key, "province_name"), key, "left")
    return named.select("province_name", "current.*")
