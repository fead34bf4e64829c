"""A keyed table kept as its changes: each batch adds the rows that changed and rewrites nothing."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from stationflow.operators.windows import latest_per_key
from stationflow.sources.tables import _Files

GONE = "gone"


class ChangeLog:
    """Changed rows by batch; of each key the row of the last batch counts, unless it says ``gone``.

    A batch is a folder, so a replayed batch replaces itself. ``compact`` folds all batches so far
    into one base, which readers use from the moment it is complete; what it replaced stays until
    ``expire``. One stream writes a log: batch numbers are its checkpoint's.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], schema: T.StructType | str):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        self.stored = T.StructType([*self.schema.fields, T.StructField(GONE, T.BooleanType()), T.StructField("_batch", T.LongType())])
        self._files = _Files(spark, path)

    def _committed(self, kind: str) -> list[int]:
        found = [n for n in self._files.children(self.path) if n.startswith(f"{kind}-") and self._files.exists(f"{self.path}/{n}/_SUCCESS")]
        return sorted(int(n.removeprefix(f"{kind}-")) for n in found)

    def _folder(self, kind: str, number: int) -> str:
        return f"{self.path}/{kind}-{number:012d}"

    def append(self, changes: DataFrame, batch_id: int) -> None:
        """Add one batch of at most one row a key, with the column ``gone``."""
        rows = changes.select(*self.schema.fieldNames(), GONE, F.lit(batch_id).cast("long").alias("_batch"))
        rows.write.mode("overwrite").parquet(self._folder("batch", batch_id))

    def _live(self) -> list[str]:
        bases = self._committed("base")
        after = bases[-1] if bases else -1
        return [self._folder("base", b) for b in bases[-1:]] + [self._folder("batch", b) for b in self._committed("batch") if b > after]

    def read(self) -> DataFrame:
        """The current row of each key. Reads the base and the batches after it."""
        folders = self._live()
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.stored).parquet(*folders)
        return latest_per_key(rows, self.keys, [F.desc("_batch")]).where(~F.col(GONE)).select(*self.schema.fieldNames())

    def compact(self) -> None:
        """Fold all batches into a new base; gone keys leave the table."""
        batches = self._committed("batch")
        if batches and len(self._live()) > 1:
            rows = self.read().select("*", F.lit(False).alias(GONE), F.lit(batches[-1]).cast("long").alias("_batch"))
            rows.write.mode("overwrite").parquet(self._folder("base", batches[-1]))

    def expire(self, older_than: dt.timedelta) -> int:
        """Delete bases and batches that a base replaced longer ago than ``older_than``; how many."""
        limit = dt.datetime.now().timestamp() - older_than.total_seconds()
        old = [b for b in self._committed("base") if self._files.modified(f"{self._folder('base', b)}/_SUCCESS") <= limit]
        if not old:
            return 0
        gone = [self._folder("base", b) for b in self._committed("base") if b < old[-1]]
        gone += [self._folder("batch", b) for b in self._committed("batch") if b <= old[-1]]
        for folder in gone:
            self._files.delete(folder)
        return len(gone)
