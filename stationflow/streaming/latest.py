"""The latest row per key of a stream, kept in Spark's state store."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from stationflow.functions.scalar import event_time
from stationflow.sources.changelog import GONE, ChangeLog
from stationflow.streaming.ingest import STATE_STORE, settings, start

#: A column and whether its largest value comes first. As in SQL, NULL is the smallest value and
#: NaN the largest.
Order = Sequence[tuple[str, bool]]


def ahead(row: tuple, other: tuple, order: Sequence[tuple[int, bool]]) -> bool:
    """Whether ``row`` comes before ``other``; places and directions as in ``Order``."""
    for place, descending in order:
        a, b = ((v is not None, v != v, 0 if v is None or v != v else v) for v in (row[place], other[place]))
        if a != b:
            return (a > b) == descending
    return False


class Newest(StatefulProcessor):
    """One value a key: its first row by ``order``. Puts out a key when its value changed, and once
    more, as gone, when event time has moved ``silence`` milliseconds past the value's ``_ms``."""

    def __init__(self, schema: T.StructType, order: Order, silence: int | None):
        names = schema.fieldNames()
        self.schema, self.names, self.silence = schema, names, silence
        self.order = [(names.index(c), descending) for c, descending in order]
        self.clock = names.index("_ms")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.kept = handle, handle.getValueState("newest", self.schema)

    def put_out(self, value: tuple, gone: bool) -> Row:
        return Row(**dict(zip(self.names, value)), **{GONE: gone})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = tuple(self.kept.get()) if self.kept.exists() else None
        best = known
        for row in map(tuple, rows):
            if best is None or ahead(row, best, self.order):
                best = row
        if best is known:
            return
        self.kept.update(best)
        if self.silence is not None and best[self.clock] is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(best[self.clock] + self.silence)
        yield self.put_out(best, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.kept.exists():
            yield self.put_out(tuple(self.kept.get()), True)
            self.kept.clear()

    def close(self) -> None:
        pass


def first_per_key(rows: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    """Of each key the first row of every Arrow batch: what a busy key sends on is bounded by the
    number of batches, not of its rows."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns, by = {}, []
            for column, descending in order:
                values, way = batch.column(batch.schema.get_field_index(column)), "descending" if descending else "ascending"
                odd = pc.is_nan(values) if pa.types.is_floating(values.type) else pa.nulls(len(values), pa.bool_())
                for part in (pc.is_valid(values), pc.fill_null(odd, False), values):
                    by.append((f"{len(columns)}", way))
                    columns[f"{len(columns)}"] = part
            sorted_rows = batch.take(pc.sort_indices(pa.table(columns), sort_keys=by))
            places = pa.table({**{k: sorted_rows.column(k) for k in keys}, "_place": pa.array(range(len(batch)), pa.int64())})
            firsts = places.group_by(list(keys), use_threads=False).aggregate([("_place", "min")])
            yield sorted_rows.take(firsts["_place_min"].combine_chunks())

    return rows.mapInArrow(pick, rows.schema)


def stream_latest(
    rows: DataFrame,
    log: ChangeLog,
    order: Order,
    checkpoint: str,
    continuous: str | None = None,
    ts: str | None = None,
    silent_after_ms: int | None = None,
    delay: str = "1 day",
    compact_every: int = 96,
) -> StreamingQuery:
    """Keep one row per key of ``log``, replaced only by one that comes before it in ``order``.

    The newest row of each key is its value in the state store. A trigger reads and writes the values
    of the keys it has rows for, and adds to the log the keys whose value changed; the snapshot is
    neither read nor rewritten. A replayed batch finds the state it started from and writes the same
    folder again. Every ``compact_every`` triggers the log is folded into a new base.

    With ``silent_after_ms`` a key leaves table and state when event time, the watermark of ``ts``
    with its ``delay``, has passed its newest row by so much; rows later than the watermark are
    then dropped. Rows that equal the known one in all of ``order`` change nothing."""
    names = log.schema.fieldNames()
    moment = event_time(F.col(ts)) if ts else F.lit(None).cast("timestamp")
    stamped = rows.select(*names, F.unix_millis(moment).alias("_ms"), moment.alias("_event_time"))
    if silent_after_ms is not None:
        if ts is None:
            raise ValueError("silent_after_ms needs the time column ts")
        stamped = stamped.withWatermark("_event_time", delay)
    state = T.StructType([*log.schema.fields, T.StructField("_ms", T.LongType()), T.StructField("_event_time", T.TimestampType())])
    put_out = T.StructType([*state.fields, T.StructField(GONE, T.BooleanType())])
    mode = "none" if silent_after_ms is None else "EventTime"
    changed = (
        first_per_key(stamped, log.keys, order)
        .groupBy(*log.keys)
        .transformWithState(Newest(state, order, silent_after_ms), put_out, "Update", mode)
    )

    def add(batch: DataFrame, batch_id: int) -> None:
        log.append(batch, batch_id)
        if (batch_id + 1) % compact_every == 0:
            log.compact()

    with settings(rows.sparkSession, STATE_STORE):
        return start(changed, add, checkpoint, continuous, output_mode="update")
