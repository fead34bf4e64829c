"""Tables on a file system: views, full rebuilds, versioned snapshots, partitioned facts.

Plain parquet has no row-level merge. Two kinds of table stand in for it:

* ``VersionedTable`` for dimensions and snapshots: each write is a complete new version folder;
  a version counts once Spark has committed it, so readers never see half a write.
* ``PartitionedTable`` for facts: only the partitions that hold changed rows are rewritten.

Both are written by one writer at a time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from stationflow.operators.incremental import merge_rows


def rebalanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Gather each partition value's rows into few files; adaptive execution splits a value that
    holds most rows over several tasks and puts small values together."""
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df


def materialize_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def materialize_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Full rebuild at ``path``; ``df`` must not read from it."""
    rebalanced(df, partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to the declared columns, in their order."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def overwrite_reload(df: DataFrame, path: str, schema: T.StructType) -> DataFrame:
    """Replace a table's whole content by ``df`` in the declared schema."""
    conform(df, schema).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def append_batch(df: DataFrame, path: str, batch: str, partition_by: Sequence[str] = ()) -> None:
    """Append one identified batch, its rows by partition. Writing the same batch again replaces it."""
    rebalanced(df, partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/batch={batch}")


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All batches; a filter on a partition column of ``schema`` prunes folders in each of them."""
    stored = T.StructType([*schema.fields, T.StructField("batch", T.StringType())])
    return spark.read.schema(stored).parquet(path).drop("batch")


class _Files:
    """The few file-system calls needed, on whatever file system the path names."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def children(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(self._path(path))]

    def modified(self, path: str) -> float:
        return self._fs.getFileStatus(self._path(path)).getModificationTime() / 1000

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


class VersionedTable:
    """A table whose every write is a new complete version. Old versions stay until ``expire``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._files = _Files(spark, path)

    def _folder(self, version: int) -> str:
        return f"{self.path}/version-{version:08d}"

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        found = [int(n.removeprefix("version-")) for n in self._files.children(self.path) if n.startswith("version-")]
        return sorted(v for v in found if self._files.exists(f"{self._folder(v)}/_SUCCESS"))

    def exists(self) -> bool:
        return bool(self.versions())

    def read(self) -> DataFrame:
        versions = self.versions()
        if not versions:
            raise FileNotFoundError(f"no committed version under {self.path}")
        return self.spark.read.parquet(self._folder(versions[-1]))

    def replace(self, df: DataFrame) -> DataFrame:
        """Write the next version; ``df`` may read the current one."""
        versions = self.versions()
        df.write.mode("overwrite").parquet(self._folder(versions[-1] + 1 if versions else 1))
        return self.read()

    def expire(self, older_than: dt.timedelta) -> list[int]:
        """Delete versions, but the last, that were replaced longer ago than ``older_than``: long
        enough for every frame that still reads them to be done."""
        limit, versions = dt.datetime.now().timestamp() - older_than.total_seconds(), self.versions()
        gone = [v for v, after in zip(versions, versions[1:]) if self._files.modified(f"{self._folder(after)}/_SUCCESS") <= limit]
        for version in gone:
            self._files.delete(self._folder(version))
        return gone

    def upsert(self, source: DataFrame, keys: Sequence[str], update_columns: Sequence[str] | None = None) -> DataFrame:
        return self.replace(merge_rows(self.read(), source, keys, update_columns) if self.exists() else source)


Combine = Callable[[DataFrame, DataFrame], DataFrame]


class PartitionedTable:
    """A fact whose merge rewrites only the partitions that ``source`` touches.

    Columns and their types are declared, so an empty table can be read and a partition value stays
    what it was (``007`` no number, NULL no text). The new content of the touched partitions is
    complete in a folder beside the table before they are replaced from it. Should a run end
    between, the next write replaces them from there first, so that no row is lost. Reading writes
    nothing: while that folder is complete, a reader takes the partitions it holds from there, and so
    never sees a half-replaced one.
    """

    def __init__(self, spark: SparkSession, path: str, partition_by: Sequence[str], schema: T.StructType | str):
        self.spark, self.path, self.partition_by = spark, path.rstrip("/"), list(partition_by)
        self.schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        self.pending = f"{self.path}-pending"
        self._files = _Files(spark, path)

    def exists(self) -> bool:
        """Whether anything was ever written, be it no row."""
        return self._is_pending() or any(not n.startswith("_temporary") for n in self._files.children(self.path))

    def read(self) -> DataFrame:
        if not self._is_pending():
            return self._stored(self.path)
        pending = self._stored(self.pending)
        if not self.partition_by or not self._files.exists(self.path):
            return pending
        replaced = pending.select(*self.partition_by).distinct()
        return self._join_partitions(self._stored(self.path), replaced, "left_anti").unionByName(pending)

    def _stored(self, path: str) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(path)

    def _is_pending(self) -> bool:
        """Whether a complete copy of partitions waits to replace them."""
        return self._files.exists(f"{self.pending}/_SUCCESS")

    def _join_partitions(self, rows: DataFrame, partitions: DataFrame, how: str) -> DataFrame:
        partitions = partitions.withColumnsRenamed({c: f"_{c}" for c in self.partition_by})
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in self.partition_by])
        return rows.join(partitions, same, how)

    def max_of(self, column: str) -> dt.date | None:
        """The high-water mark; for a partition column no data column is read."""
        return self.read().agg(F.max(column)).first()[0]

    def overwrite(self, df: DataFrame) -> DataFrame:
        self._files.delete(self.pending)
        self._write(df, self.path, "static")
        return self.read()

    def _write(self, df: DataFrame, path: str, overwrite: str) -> None:
        rows = rebalanced(conform(df, self.schema), self.partition_by)
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", overwrite)
        writer.partitionBy(*self.partition_by).parquet(path)

    def _recover(self) -> None:
        """Finish, or forget, what an earlier run left beside the table."""
        if not self._files.exists(self.pending):
            return
        if self._is_pending():
            self._write(self._stored(self.pending), self.path, "dynamic" if self.partition_by else "static")
        self._files.delete(self.pending)

    def upsert(self, source: DataFrame, keys: Sequence[str], update_columns: Sequence[str] | None = None) -> DataFrame:
        if not set(self.partition_by) <= set(keys):
            raise ValueError("the partition columns must be part of the key")
        return self.update(source, lambda target, rows: merge_rows(target, rows, keys, update_columns))

    def update(self, source: DataFrame, combine: Combine) -> DataFrame:
        """Replace the partitions that ``source`` has rows for by ``combine(their rows, source)``.

        Doing so again with the same rows gives the same table."""
        self._recover()
        if not self.exists():
            return self.overwrite(combine(source.limit(0), source))
        source = conform(source, self.schema).persist()  # read for the partitions it touches, and to be merged
        try:
            self._write(combine(self.touched(source), source), self.pending, "static")
        finally:
            source.unpersist()
        self._recover()
        return self.read()

    def touched(self, source: DataFrame) -> DataFrame:
        """The table's partitions that ``source`` has rows for.

        The smallest and largest value of each column are literals that prune the scan; the values
        themselves, of any number, are a semi join. NULL is a value like others."""
        target = self.read()
        if not self.partition_by:
            return target
        touched = source.select(*self.partition_by).distinct()
        ends = [f(c).alias(f"{n}{i}") for i, c in enumerate(self.partition_by) for n, f in (("a", F.min), ("b", F.max), ("n", lambda c: F.count_if(F.col(c).isNull())))]
        bounds = touched.agg(*ends).first()
        for i, column in enumerate(self.partition_by):
            low, high = (F.lit(bounds[f"{n}{i}"]).cast(self.schema[column].dataType) for n in "ab")
            inside = F.col(column).between(low, high)
            target = target.where(inside | F.col(column).isNull() if bounds[f"n{i}"] else inside)
        return self._join_partitions(target, touched, "left_semi")


def bucketed(df: DataFrame, keys: Sequence[str], buckets: int = 16, out: str = "bucket") -> DataFrame:
    """Add a hash bucket of the key to partition by, where the key has no day."""
    return df.withColumn(out, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
