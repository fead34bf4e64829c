"""The daily rollup, kept up to date from the stream."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from stationflow.functions.scalar import event_time, utc_day
from stationflow.sources.tables import PartitionedTable
from stationflow.streaming.ingest import start


def stream_daily(
    rows: DataFrame,
    table: PartitionedTable,
    keys: Sequence[str],
    ts: str,
    measures: Mapping[str, Column],
    checkpoint: str,
    delay: str = "1 day",
    day: str = "weather_date",
    continuous: str | None = None,
) -> StreamingQuery:
    """Maintain the rollup by key and day.

    The state holds the open days only: rows later than ``delay`` are dropped. Every trigger
    merges the days that changed, each as its full aggregate, so replays are harmless.
    """
    stamped = rows.withColumn("_event_time", event_time(F.col(ts))).withWatermark("_event_time", delay)
    daily = (
        stamped.groupBy(*keys, F.window("_event_time", "1 day").alias("_window"))
        .agg(*[m.alias(name) for name, m in measures.items()])
        .withColumn(day, utc_day(F.col("_window.start")))
        .drop("_window")
    )

    def merge(batch: DataFrame, batch_id: int) -> None:
        changed = batch.persist()  # each action on a batch would run the state update again
        try:
            if not changed.isEmpty():
                table.upsert(changed, [*keys, day])
        finally:
            changed.unpersist()

    return start(daily, merge, checkpoint, continuous, output_mode="update")
