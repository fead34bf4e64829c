"""Reversible removal of lines that many documents share: exact reference tables and, in front of
them, sharded cuckoo filters of the keys that are shared."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from stationflow.llm.common import SPACES, U64, in_small_batches, mix, wider
from stationflow.session import durable

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The seed of Spark's xxhash64, which a task repeats on the lines of a document.
SPARK_SEED = 42
SLOTS = 4  # fingerprints in a bucket
ROWS_PER_GROUP = 200_000


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACES)), UPPER, LOWER)


def _key_hash(line: bytes) -> tuple[int, int]:
    key = line.strip(SPACES.encode()).lower()
    return tuple(np.array([xxhash.xxh64_intdigest(key, SPARK_SEED), xxhash.xxh64_intdigest(key + b"\0", SPARK_SEED)], U64).view(np.int64).tolist())


def line_references(docs: DataFrame, doc_id: Column, text: Column, least: int = 20) -> DataFrame:
    """``doc_id, k1, k2``: a row for each document and different key of at least ``least`` code
    points that it holds; k1 and k2 are 128 bits of hash of the key."""
    keys = F.filter(F.transform(F.split(text, "\n", -1), line_key), lambda k: F.length(k) >= least)
    hashes = F.array_distinct(F.transform(keys, lambda k: F.struct(F.xxhash64(k).alias("k1"), F.xxhash64(F.concat(k, F.lit("\0"))).alias("k2"))))
    return docs.select(doc_id.alias("doc_id"), F.inline(hashes))


class CuckooFilter:
    """Approximate set of 64-bit hashes with deletion: a 16-bit fingerprint sits in one of two
    buckets of four. It never misses a member; a stranger passes about once in 8,000 times."""

    def __init__(self, table: np.ndarray):
        self.table, self.mask = table, U64(len(table) - 1)

    @classmethod
    def of_size(cls, members: int) -> CuckooFilter:
        buckets = 1 << max(2, int(np.ceil(np.log2(max(1, members) / SLOTS / 0.8))))
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mixed = mix(hashes)
        prints = ((mixed >> U64(48)) % U64(65535) + U64(1)).astype(np.uint16)
        one = mixed & self.mask
        return prints, one, self._other(prints, one)

    def _other(self, prints: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        return bucket ^ (mix(prints.astype(U64) * U64(0x5BD1E995)) & self.mask)

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        prints, one, two = self._places(hashes)
        return ((self.table[one] == prints[:, None]) | (self.table[two] == prints[:, None])).any(axis=1)

    def insert(self, hashes: np.ndarray) -> bool:
        """False if no place was found for some; the filter is then to be built anew, larger."""
        prints, at, _ = self._places(hashes)
        for turn in range(500):
            if not len(prints):
                return True
            # One a bucket in each turn; the others wait, as two must not take the same slot.
            _, first = np.unique(at, return_index=True)
            waits = np.ones(len(at), bool)
            waits[first] = False
            buckets, mine = at[first], prints[first]
            empty = self.table[buckets] == 0
            slot = np.where(empty.any(axis=1), empty.argmax(axis=1), turn % SLOTS)
            evicted = self.table[buckets, slot]
            self.table[buckets, slot] = mine
            gone = evicted > 0
            moved = self._other(evicted[gone], buckets[gone])
            prints, at = np.concatenate([prints[waits], evicted[gone]]), np.concatenate([at[waits], moved])
        return False

    def delete(self, hashes: np.ndarray) -> None:
        """Of members only: takes one copy of each fingerprint away."""
        for fingerprint, one, two in zip(*self._places(hashes)):
            for bucket in (one, two):
                slot = np.flatnonzero(self.table[bucket] == fingerprint)
                if len(slot):
                    self.table[bucket, slot[0]] = 0
                    break

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        return cls(np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy())

    @classmethod
    def holding(cls, hashes: np.ndarray) -> CuckooFilter:
        members = len(hashes)
        while True:
            made = cls.of_size(members)
            if made.insert(hashes):
                return made
            members = max(8, 2 * members)


def _hashes(rows: pa.Table) -> np.ndarray:
    return rows["k1"].to_numpy().view(U64)


def _updated_filter(key: tuple, changes: pa.Table, before: pa.Table) -> pa.Table:
    """One shard's filter after its keys have come in or gone out of the shared ones."""
    hashes, change = _hashes(changes), changes["change"].to_numpy()
    filter_ = CuckooFilter.from_bytes(before["filter"][0].as_py()) if len(before) else None
    if filter_ is not None and (change >= 0).sum() <= 0.85 * filter_.table.size:
        filter_.delete(hashes[change < 0])
        if not filter_.insert(hashes[change > 0]):
            filter_ = None
    else:
        filter_ = None
    filter_ = filter_ or CuckooFilter.holding(hashes[change >= 0])
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "filter": pa.array([filter_.to_bytes()], pa.binary())})


def _probed(key: tuple, rows: pa.Table, filters: pa.Table) -> pa.Table:
    found = CuckooFilter.from_bytes(filters["filter"][0].as_py()).contains(_hashes(rows)) if len(filters) else np.zeros(len(rows), bool)
    return rows.select(["doc_id", "k1", "k2"]).filter(pa.array(found))


@dataclass(frozen=True)
class LineIndex:
    """Which documents hold which line. All tables lie in the shared folder.

    ``references`` (doc_id, k1, k2) is exact and is what insertion and deletion change; ``counts``
    (k1, k2, shard, n_docs, last_doc) are the exact reference counts; ``filters`` (shard, filter)
    hold the keys that at least ``min_docs`` documents share, and screen lines before the exact
    table is asked. Deleting documents that were inserted gives the former tables back.

    A document is a doc_id; rows that share one are one document. Rows without a doc_id are cleaned
    but aren't counted, so they keep no shared line. Key groups are counted with partial sums and
    probed in salted groups, so a line that a third of all documents hold does no harm."""

    references: DataFrame
    counts: DataFrame
    filters: DataFrame
    min_docs: int
    shards: int
    least: int

    @classmethod
    def build(cls, docs: DataFrame, doc_id: Column, text: Column, min_docs: int = 3, least: int = 20, shards: int = 64) -> LineIndex:
        """``shards``: so many that a shard's shared keys fit in a task (some millions)."""
        spark = docs.sparkSession
        references = durable(line_references(docs, doc_id, text, least), "line-references")
        # Rows that createDataFrame makes, even none, would start Python workers of another kind.
        none = references.limit(0)
        counts = none.selectExpr("k1", "k2", "cast(0 as long) as n_docs", "doc_id as last_doc", "0 as shard")
        filters = spark.range(0).selectExpr("cast(id as int) as shard", "cast(null as binary) as filter")
        return cls(none, counts, filters, min_docs, shards, least)._with(references, None)

    def insert(self, docs: DataFrame, doc_id: Column, text: Column) -> LineIndex:
        """With more documents; what the index has of them already is not counted again."""
        new = line_references(docs, doc_id, text, self.least).dropDuplicates()
        new = durable(new.join(self.references, ["doc_id", "k1", "k2"], "left_anti"), "line-references")
        return self._with(self.references.unionByName(new), new)

    def delete(self, ids: DataFrame, doc_id: str = "doc_id") -> LineIndex:
        """Without the documents whose ids are given."""
        ids = ids.select(F.col(doc_id).alias("doc_id")).dropDuplicates()
        gone = durable(self.references.join(ids, "doc_id", "left_semi"), "line-gone")
        kept = durable(self.references.join(ids, "doc_id", "left_anti"), "line-references")
        return self._with(kept, gone)

    def _with(self, references: DataFrame, changed: DataFrame | None) -> LineIndex:
        """Count the keys of ``changed`` anew (all, if None) and carry the filters along."""
        fresh, old = references, self.counts
        if changed is not None:
            touched = changed.select("k1", "k2").dropDuplicates()
            fresh, old = references.join(touched, ["k1", "k2"], "left_semi"), self.counts.join(touched, ["k1", "k2"], "left_anti")
        fresh = fresh.groupBy("k1", "k2").agg(F.countDistinct("doc_id").alias("n_docs"), F.max("doc_id").alias("last_doc"))
        fresh = fresh.withColumn("shard", F.pmod("k1", F.lit(self.shards)).cast("int"))
        counts = durable(fresh if changed is None else old.unionByName(fresh), "line-counts")
        was, now = (c.where(F.col("n_docs") >= self.min_docs).select("shard", "k1", "k2") for c in (self.counts, counts))
        if changed is None:
            changes, before = now.withColumn("change", F.lit(1)), self.filters
        else:
            both = was.withColumn("a", F.lit(1)).join(now.withColumn("b", F.lit(1)), ["shard", "k1", "k2"], "full")
            changes, before = both.withColumn("change", F.coalesce("b", F.lit(0)) - F.coalesce("a", F.lit(0))), self.filters
        filters = changes.groupBy("shard").cogroup(before.groupBy("shard")).applyInArrow(_updated_filter, "shard int, filter binary")
        return replace(self, references=references, counts=counts, filters=durable(filters, "line-filters"))

    def shared_lines(self, references: DataFrame) -> DataFrame:
        """``doc_id, k1, k2``: the references that clean() takes away. The filters screen them in
        groups of about ROWS_PER_GROUP rows (a shard, split by salt); the exact counts decide."""
        kind = references.schema["doc_id"].dataType.simpleString()
        rows = references.withColumn("shard", F.pmod("k1", F.lit(self.shards)).cast("int"))
        salts = rows.groupBy("shard").agg(F.ceil(F.count("*") / ROWS_PER_GROUP).cast("int").alias("salts"))  # a row a shard
        rows = rows.join(F.broadcast(salts), "shard").withColumn("salt", F.pmod(F.xxhash64("doc_id", "k2"), F.col("salts")).cast("int"))
        copies = self.filters.join(F.broadcast(salts), "shard").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
        screened = rows.drop("salts").groupBy("shard", "salt").cogroup(copies.select("shard", "salt", "filter").groupBy("shard", "salt"))
        screened = screened.applyInArrow(_probed, f"doc_id {kind}, k1 long, k2 long")
        exact = self.counts.where(F.col("n_docs") >= self.min_docs).select("k1", "k2", "last_doc")
        return screened.join(exact, ["k1", "k2"]).where(~F.col("doc_id").eqNullSafe(F.col("last_doc"))).select("doc_id", "k1", "k2")

    def clean(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", references: DataFrame | None = None) -> DataFrame:
        """All columns of ``docs`` with the kept lines as ``text`` (null counts as one empty line),
        and ``n_lines, n_dropped``. ``references``: those of docs, if they are at hand."""
        if references is None:
            references = line_references(docs, F.col(doc_id), F.col(text), self.least)
        gone = self.shared_lines(references).groupBy("doc_id").agg(F.collect_set(F.struct("k1", "k2")).alias("_gone"))
        gone = gone.withColumnRenamed("doc_id", "_of")
        rows = docs.drop("n_lines", "n_dropped").join(gone, F.col(doc_id).eqNullSafe(F.col("_of")), "left").drop("_of")
        columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
        rows = rows.select(*[F.col(f"`{c}`") for c in columns], "_gone")
        schema = wider(rows.drop("_gone").schema, n_lines="long", n_dropped="long")
        place = columns.index(text)

        def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts, n_lines, n_dropped = [], [], []
                for value, shared in zip(batch.column(place).to_pylist(), batch.column(len(columns)).to_pylist()):
                    value = value or ""
                    n, k = value.count("\n") + 1, 0
                    if shared:
                        shared = {(x["k1"], x["k2"]) for x in shared}
                        kept = [x for x in value.encode().split(b"\n") if _key_hash(x) not in shared]
                        value, k = b"\n".join(kept).decode(), n - len(kept)
                    texts.append(value)
                    n_lines.append(n)
                    n_dropped.append(k)
                out = batch.columns[: len(columns)]
                out[place] = pa.array(texts, batch.schema.field(place).type)
                arrays = out + [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, [*columns, "n_lines", "n_dropped"])

        return in_small_batches(rows).mapInArrow(cleaned, schema)
