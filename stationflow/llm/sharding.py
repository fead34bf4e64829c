"""Shards of nearly equal bytes by sampled splitters, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from stationflow.llm.common import unit
from stationflow.session import durable


def range_of(key: Column, splitters: list) -> Column:
    """How many of the ascending ``splitters`` are at most ``key``, by binary search; null is 0."""
    if not splitters:
        return F.lit(0)
    points, reach = F.array(*[F.lit(s) for s in splitters]), 1 << (len(splitters).bit_length() - 1)
    jumps = F.array(*[F.lit(reach >> i) for i in range(reach.bit_length())])
    past = lambda at, jump: (at + jump <= len(splitters)) & (F.get(points, at + jump - 1) <= key)
    return F.aggregate(jumps, F.lit(0), lambda at, jump: F.when(past(at, jump), at + jump).otherwise(at))


def balanced_shards(
    docs: DataFrame,
    doc_id: Column,
    size: Column,
    key: Column,
    shards: int = 8,
    ranges: int = 256,
    draws: int = 16,
    slices: int = 64,
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """Range-partition rows by ``key`` into ``shards`` whose sums of ``size`` are nearly equal.

    ``ranges`` x ``draws`` keys are drawn, each row with a chance in proportion to its size; their
    quantiles are the splitters. All rows are then measured by range. A range that holds more than
    twice its share (a hot key, say) is subdivided by a hash of the row into ``slices``. Ranges in
    key order, and rows in key order inside them, make one line of bytes that is cut at every
    1/``shards`` of the total, so a shard's bytes differ from its share by less than one row at
    each end. Nothing is dropped or capped, and the number of rows that one task sorts is that of
    a range or slice: raise ``ranges`` with the data.

    Returns ``doc_id, size, <carry>, shard, slot``: shards from 0, slots gapless from 0 in each.
    ``size`` must be positive. A null key sorts first; repeated rows are rows of their own and may
    swap places; an empty table gives no rows. Only the measures of ranges x slices are broadcast.
    """
    carry = carry or {}
    rows = durable(
        docs.select(
            doc_id.alias("doc_id"), size.cast("long").alias("size"), key.alias("_key"),
            *[c.alias(n) for n, c in carry.items()],
        ).withColumn("_tie", F.xxhash64(F.lit(1), "doc_id", "size", "_key")),
        "shard-rows",
    )
    race = -F.log(unit(F.lit(2), F.col("_tie"))) / F.col("size")
    # A row is among the first with a chance in proportion to its size; by the total, only about four
    # times as many rows as are wanted leave their tasks.
    total = rows.agg(F.sum("size")).first()[0] or 1
    drawn = rows.select("_key", race.alias("race")).where(F.col("race") * float(total) < 4 * ranges * draws)
    drawn = drawn.orderBy("race").limit(ranges * draws)
    keys = sorted(r[0] for r in drawn.where("_key is not null").select("_key").collect())
    splitters = sorted(set(keys[draws::draws]))

    at = rows.withColumn("_range", range_of(F.col("_key"), splitters)).withColumn("_slice", F.pmod("_tie", F.lit(slices)).cast("int"))
    cells = at.groupBy("_range", "_slice").agg(F.sum("size").alias("bytes"))
    in_range, in_all = Window.partitionBy("_range"), Window.partitionBy()
    overfull = F.sum("bytes").over(in_range) > 2 * F.col("total") / ranges
    cells = cells.withColumn("total", F.sum("bytes").over(in_all))
    cells = cells.withColumn("_piece", F.col("_range") * slices + F.when(overfull, F.col("_slice")).otherwise(0))
    earlier = F.sum("bytes").over(Window.orderBy("_piece").rangeBetween(Window.unboundedPreceding, -1))
    cells = cells.select("_range", "_slice", "_piece", "total", F.coalesce(earlier, F.lit(0)).alias("before"))

    line = Window.partitionBy("_piece").orderBy("_key", "_tie", "doc_id")
    start = F.col("before") + F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    middle = F.floor((2 * F.col("start") + F.col("size")) * shards / (2 * F.col("total")))
    placed = at.join(F.broadcast(cells), ["_range", "_slice"]).withColumn("start", start)
    placed = placed.withColumn("shard", F.least(middle, F.lit(shards - 1)).cast("int"))

    counts = placed.groupBy("_piece", "shard").agg(F.count("*").alias("n"))
    ahead = F.sum("n").over(Window.partitionBy("shard").orderBy("_piece")) - F.col("n")
    counts = counts.select("_piece", "shard", ahead.alias("ahead"))
    place = F.row_number().over(Window.partitionBy("_piece", "shard").orderBy("_key", "_tie", "doc_id"))
    numbered = placed.withColumn("place", place).join(F.broadcast(counts), ["_piece", "shard"])
    return numbered.select("doc_id", "size", *carry, "shard", (F.col("ahead") + F.col("place") - 1).cast("long").alias("slot"))
