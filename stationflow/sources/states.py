"""A table of partial states by key and day, that batches are added to in any order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from stationflow.operators.partials import Kept, finish_states, merge_states, partial_states
from stationflow.session import durable
from stationflow.sources.tables import PartitionedTable


class StateTable:
    """What each numbered batch adds to each key and day, in partitions by day.

    ``add`` reads the batch's rows once and rewrites the states of its days only; no raw row of an
    earlier batch is read again. A batch that is added again takes the place of what it added before,
    so a replay changes nothing; it must have the same rows. Batches may come in any order. A NULL key
    or day is a key or day like others.

    A day holds one row a key and batch. ``fold`` makes one row a key of the batches below a number;
    these can't be replayed from then on, and adding one is an error, not a silent second count.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], day: str, measures: Mapping[str, Kept], rows: DataFrame):
        """``rows``: any frame with the columns of the batches, read for its schema alone."""
        self.keys, self.day, self.measures = list(keys), day, dict(measures)
        kinds = partial_states(rows, [*self.keys, day], self.measures).schema.fields
        more = [T.StructField("batch", T.LongType()), T.StructField("folded", T.BooleanType())]
        self.table = PartitionedTable(spark, path, [day], T.StructType([*kinds, *more]))

    @property
    def _by(self) -> list[str]:
        return [*self.keys, self.day]

    def folded_before(self) -> int:
        """Batches below this number are folded."""
        if not self.table.exists():
            return 0
        last = self.table.read().where("folded").agg(F.max("batch")).first()[0]
        return 0 if last is None else last + 1

    def add(self, rows: DataFrame, batch: int) -> DataFrame:
        """Add a batch (numbered from 0); returns the finished measures of all keys of its days."""
        if batch < self.folded_before():
            raise ValueError(f"batch {batch} is among those that are folded")
        states = partial_states(rows, self._by, self.measures)
        fresh = durable(states.withColumns({"batch": F.lit(batch).cast("long"), "folded": F.lit(False)}), "states")
        self.table.update(fresh, lambda held, new: held.where(F.col("batch") != batch).unionByName(new))
        return self.finished(self.table.touched(fresh))

    def finished(self, states: DataFrame | None = None) -> DataFrame:
        """The measures of the given stored states, or of all."""
        states = self.table.read() if states is None else states
        return finish_states(merge_states(states, self._by, self.measures), self._by, self.measures)

    def fold(self, before: int) -> None:
        """Merge the batches numbered below ``before``; only days with an unfolded one are rewritten."""
        if not self.table.exists() or before <= 0:
            return
        settled = F.col("batch") < before

        def combine(held: DataFrame, _: DataFrame) -> DataFrame:
            merged = merge_states(held.where(settled), self._by, self.measures)
            merged = merged.withColumns({"batch": F.lit(before - 1).cast("long"), "folded": F.lit(True)})
            return held.where(~settled).unionByName(merged)

        self.table.update(self.table.read().where(settled & ~F.col("folded")), combine)
