"""Continuous ingest of messages into the raw table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from stationflow.functions.scalar import event_time
from stationflow.schemas import EVENT_DAY, RAW_REQUIRED
from stationflow.sources.messages import accepted, judge, rejected
from stationflow.sources.tables import append_batch


#: Keyed state and state that grows with the stream need the RocksDB store: it keeps rows on disk and
#: its commits upload what changed only.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for what is started inside; a stream keeps those it was started with."""
    before = {k: spark.conf.get(k, None) for k in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def start(
    stream: DataFrame,
    on_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    continuous: str | None = None,
    output_mode: str = "append",
    partitions: int | None = None,
) -> StreamingQuery:
    """Run ``on_batch`` per micro-batch.

    By default all available input is processed in bounded batches and the query stops, like a
    consumer that ends when idle; ``continuous="15 minutes"`` keeps it running. Restarting with
    the same checkpoint resumes after the last committed batch.

    ``partitions`` deals out the rows of a batch and the state; a checkpoint keeps its first number.
    Every one of them is a task and a commit in each trigger, whatever it holds, so the number meant
    for whole tables is lowered to that of the cores unless it is given.
    """
    spark = stream.sparkSession
    if partitions is None:
        partitions = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint).outputMode(output_mode)
    writer = writer.trigger(processingTime=continuous) if continuous else writer.trigger(availableNow=True)
    with settings(spark, {"spark.sql.shuffle.partitions": str(partitions)}):
        return writer.start()


def run_to_end(query: StreamingQuery) -> StreamingQuery:
    query.awaitTermination()
    return query


def batch_name(checkpoint: str, batch_id: int) -> str:
    """Identifies a batch across replays, and apart from batches of other checkpoints."""
    return f"{hashlib.md5(checkpoint.encode()).hexdigest()[:12]}-{batch_id:010d}"


def stream_ingest(
    messages: DataFrame,
    raw_path: str,
    reject_path: str,
    checkpoint: str,
    required: Sequence[str] = RAW_REQUIRED,
    continuous: str | None = None,
    on_counts: Callable[[int, dict[str, int]], None] | None = None,
) -> StreamingQuery:
    """Messages -> flattened rows -> raw table by day, bad messages -> headered CSV.

    A replayed batch overwrites its own folder in both places, so a restart adds no duplicates.
    One bad message is set apart alone and the rest of its batch is loaded.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        name = batch_name(checkpoint, batch_id)
        counts = Observation(f"ingest-{name}")
        judged = judge(batch, required).observe(
            counts,
            F.count("*").alias("processed"),
            F.count_if(F.col("_reason").isNotNull()).alias("rejected"),
        )
        judged.persist()
        try:
            append_batch(accepted(judged), raw_path, name, [EVENT_DAY])
            bad = rejected(judged)
            if not bad.isEmpty():
                dead_letter(bad, reject_path, name)
            if on_counts:
                on_counts(batch_id, counts.get)
        finally:
            judged.unpersist()

    return start(messages, load, checkpoint, continuous)


def dead_letter(rows: DataFrame, path: str, batch: str) -> None:
    rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{path}/batch={batch}")


def dedup(stream: DataFrame, keys: Sequence[str], ts: str, delay: str = "1 day") -> DataFrame:
    """Drop repeats of ``keys`` within the watermark delay; ``ts`` is a zone-less timestamp."""
    stamped = stream.withColumn("_event_time", event_time(F.col(ts))).withWatermark("_event_time", delay)
    return stamped.dropDuplicatesWithinWatermark(list(keys)).drop("_event_time")
