"""Mixing sources to target weights by fixed-length blocks, in DataFrame operations only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from stationflow.session import durable

#: Rounds of the permutation; each moves a place to its partner by one pseudorandom bit.
ROUNDS = 12
#: About how many draws a task makes, draws to a row of a guide, shards to a group of prefix sums.
DRAWS_PER_TASK, GUIDE, SHARDS_PER_GROUP = 1 << 17, 1 << 8, 1 << 12


def permuted(place: Column, n: Column, *key: Column, inverse: bool = False) -> Column:
    """A pseudorandom permutation of 0..n-1 that depends on ``key`` alone (swap-or-not shuffle):
    in each round a place and its mirror image swap or stay by a hash of the larger of the two."""

    def swap(at: Column, r: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(F.lit("mirror"), *key, r), n) - at, n)
        stays = F.xxhash64(F.lit("swap"), *key, r, F.greatest(at, mirror)).bitwiseAND(F.lit(1)) == 0
        return F.when(stays, at).otherwise(mirror)

    order = range(ROUNDS - 1, -1, -1) if inverse else range(ROUNDS)
    return F.aggregate(F.array(*[F.lit(r) for r in order]), place, swap)


def capped_targets(sources: DataFrame, total: float, cap: float) -> DataFrame:
    """Add ``target`` to rows of ``_size, _weight``: shares of ``total`` by weight, none above
    ``cap`` times its size, the excess reshared by weight among the others.

    One row a source. In order of cap to weight, sources fill up one after the other; the first
    that the level of the rest doesn't fill fixes the level."""
    full = F.col("_size") * cap
    line = Window.orderBy(full / F.col("_weight"), "_src")
    past = line.rowsBetween(Window.unboundedPreceding, -1)
    filled, used = F.coalesce(F.sum(full).over(past), F.lit(0.0)), F.coalesce(F.sum("_weight").over(past), F.lit(0.0))
    level = (F.lit(float(total)) - filled) / (F.sum("_weight").over(Window.partitionBy()) - used)
    leveled = sources.select("*", level.alias("_level"), F.row_number().over(line).alias("_place"))
    fits = F.col("_level") * F.col("_weight") <= full
    first = F.min(F.when(fits, F.struct("_place", "_level"))).over(Window.partitionBy())["_level"]
    out = leveled.withColumn("target", F.least(full, F.coalesce(first, F.lit(float("inf"))) * F.col("_weight")).cast("double"))
    return out.drop("_level", "_place")


def located(rows: DataFrame, at: str, line: DataFrame, out: str, first: str) -> DataFrame:
    """Add to ``rows`` the source ``out`` on whose stretch of ``line`` (_src, _from, _n) the place
    ``at`` lies, and where that stretch begins.

    The line is cut into pieces of GUIDE places, one row each, that list the stretches they touch:
    at most GUIDE, as none is empty. A place joins its piece by number."""
    pieces = F.sequence(F.floor(F.col("_from") / GUIDE), F.floor((F.col("_from") + F.col("_n") - 1) / GUIDE))
    guide = line.where("_n > 0").withColumn("_piece", F.explode(pieces)).groupBy("_piece")
    guide = guide.agg(F.sort_array(F.collect_list(F.struct(F.col("_from").alias("begin"), F.col("_src").alias("source")))).alias("_held"))
    joined = rows.withColumn("_piece", F.floor(F.col(at) / GUIDE)).join(guide.hint("merge"), "_piece")
    found = F.element_at(F.filter("_held", lambda h: h["begin"] <= F.col(at)), -1)
    return joined.withColumn("_found", found).select(*rows.columns, F.col("_found.source").alias(out), F.col("_found.begin").alias(first))


def drawn_counts(spark: SparkSession, sources: DataFrame, total: int, slots_per_shard: int, seed: int) -> DataFrame:
    """Multinomial source counts by output shard: shard, _src, _n (at least 1).

    Each of a shard's slots draws a source, with replacement and with the sources' numbers of
    draws as odds, independently of all other slots; a shard's counts are the sums."""
    tasks = max(1, -(-total // DRAWS_PER_TASK))
    slots = spark.range(0, total, 1, tasks).select(
        F.floor(F.col("id") / slots_per_shard).cast("int").alias("shard"),
        F.pmod(F.xxhash64(F.lit(seed), F.lit("draw"), "id"), F.lit(max(1, total))).alias("_at"),
    )
    line = sources.select("_src", F.col("_before").alias("_from"), F.col("_draws").alias("_n"))
    return located(slots, "_at", line, "_src", "_first").groupBy("shard", "_src").agg(F.count("*").alias("_n"))


def numbered_draws(counts: DataFrame, sources: DataFrame, total: int, seed: int) -> DataFrame:
    """One row a slot: shard, slot, _src and _draw, the number of the source's draw that fills it.

    A source's slots, counted over all shards, are put in a pseudorandom order. The first _draws of
    them take its draws. Sources with more slots than draws leave the rest to those with fewer,
    spread over all shards by the same order; so each source is drawn as often as it should, and
    the counts follow the multinomial but for these few slots (of the order of a root of all)."""
    group = F.floor(F.col("shard") / SHARDS_PER_GROUP)
    rows = counts.withColumn("_group", group)
    sums = rows.groupBy("_src", "_group").agg(F.sum("_n").alias("_m"))
    sums = sums.withColumn("_ahead", F.sum("_m").over(Window.partitionBy("_src").orderBy("_group")) - F.col("_m"))
    line = Window.partitionBy("_src", "_group").orderBy("shard")
    rows = rows.join(sums.select("_src", "_group", "_ahead"), ["_src", "_group"])
    rows = rows.withColumn("_ahead", F.col("_ahead") + F.sum("_n").over(line) - F.col("_n"))
    inside = Window.partitionBy("shard")
    rows = rows.withColumn("_within", F.sum("_n").over(inside.orderBy("_src")) - F.col("_n")).withColumn("_filled", F.sum("_n").over(inside))

    # Per source: its slots, and where its spare slots and its missing ones lie on the lines of all such.
    kept = sources.where("_draws > 0").select("_src", "_draws").join(counts.groupBy("_src").agg(F.sum("_n").alias("_got")), "_src", "left")
    kept = kept.withColumn("_got", F.coalesce("_got", F.lit(0)))
    spare, short = F.greatest(F.col("_got") - F.col("_draws"), F.lit(0)), F.greatest(F.col("_draws") - F.col("_got"), F.lit(0))
    by_source = Window.orderBy("_src")
    kept = kept.withColumns({
        "_spare_from": F.sum(spare).over(by_source) - spare, "_short_from": F.sum(short).over(by_source) - short, "_short_n": short,
    })
    kept = durable(kept.withColumn("_moved", F.sum(spare).over(Window.partitionBy())), "mix-kept")

    tasks = max(1, -(-total // DRAWS_PER_TASK))
    # So many partitions as the rows to come need: what Spark sees are the few rows they expand from.
    rows = rows.join(kept, "_src").repartition(tasks, F.col("shard"), F.col("_src"))
    rows = rows.withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
    rows = rows.withColumn("_draw", permuted(F.col("_ahead") + F.col("_i"), F.col("_got"), F.lit(seed), F.lit("order"), F.col("_src")))
    slot = permuted(F.col("_within") + F.col("_i"), F.col("_filled"), F.lit(seed), F.lit("slots"), F.col("shard"))
    rows = rows.withColumn("slot", slot)
    own = rows.where("_draw < _draws").select("shard", "slot", "_src", "_draw")
    number = F.col("_spare_from") + F.col("_draw") - F.col("_draws")
    moved = rows.where("_draw >= _draws").withColumn("_at", permuted(number, F.col("_moved"), F.lit(seed), F.lit("moved")))
    line = kept.select("_src", F.col("_short_from").alias("_from"), F.col("_short_n").alias("_n"))
    moved = located(moved.select("shard", "slot", "_at"), "_at", line, "_src", "_first")
    moved = moved.join(kept.select("_src", "_got"), "_src")
    return own.unionByName(moved.select("shard", "slot", "_src", (F.col("_got") + F.col("_at") - F.col("_first")).alias("_draw")))


@dataclass(frozen=True)
class Mix:
    """``documents``: doc_id, source, size, source_size, target, taken, _src, _start. ``spans``:
    one row for each stretch of words that the mix takes: shard, slot, epoch, block, _src, _start,
    first (word of the document), length. ``sources``: one row a source. ``counts``: the drawn
    source counts: shard, _src, _n. ``placed``: documents, with what is carried, without taken: for
    those who count the spans themselves."""

    documents: DataFrame
    spans: DataFrame
    sources: DataFrame
    counts: DataFrame
    placed: DataFrame


def mix_sources(
    docs: DataFrame,
    doc_id: Column,
    source: Column,
    size: Column,
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    cap: float = 2.0,
    block: int = 256,
    slots_per_shard: int = 4096,
    rows_per_bucket: int = 4_000,
    seed: int = 11,
    carry: dict[str, Column] | None = None,
) -> Mix:
    """Mix ``share`` times all words from sources that weigh ``weights`` (repeating, by code point,
    null last), no source above ``cap`` (at most 2 are meant) times its own words.

    The documents of a source, in a pseudorandom order, are one stream of words that is packed into
    blocks of ``block`` words. The mix is a line of block slots, ``slots_per_shard`` to an output
    shard. Each shard draws multinomial source counts (``drawn_counts``); the few slots that a source
    has beyond the draws its target needs pass to sources that have too few (``numbered_draws``), so
    that each source meets its target to the word. A source's n-th draw takes block permutation(n), a new permutation each time it has
    been through; its last draw takes only the words that are still due. Slots and blocks join on
    (source, index). A block is drawn at most ``cap`` times, hence so is each document's word.

    Offsets in a stream are prefix sums in two levels (buckets by hash, then rows of a bucket), so
    a source with a third of all rows is not gathered in one task. Sources are one row each. Equal
    inputs give equal mixes; repeated rows are rows of their own. A size of 0 or null is never
    taken; an empty table gives no rows."""
    carry = carry or {}
    rows = docs.select(
        doc_id.alias("doc_id"), source.alias("source"), F.coalesce(size, F.lit(0)).cast("long").alias("size"),
        *[c.alias(n) for n, c in carry.items()],
    ).withColumn("_h", F.xxhash64(F.lit(seed), "doc_id", "source", "size"))
    rows = durable(rows, "mix-rows")
    count = rows.count()
    buckets = max(1, -(-count // rows_per_bucket))

    by_code = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("_src"), F.lit(len(weights))))
    sources = rows.groupBy("source").agg(F.sum("size").alias("_size"))
    sources = sources.withColumn("_src", F.row_number().over(by_code) - 1).withColumn("_weight", weight)
    total = share * (rows.agg(F.sum("size")).first()[0] or 0)
    sources = capped_targets(sources, total, cap)
    sources = sources.withColumn("_blocks", F.ceil(F.col("_size") / block).cast("long"))
    sources = sources.withColumn("_short", F.col("_size") - (F.col("_blocks") - 1) * block)
    due = F.least(F.round("target"), F.floor(F.col("_size") * cap)).cast("long")
    sources = sources.withColumn("_epochs", F.when(F.col("_size") > 0, F.floor(due / F.col("_size"))).otherwise(0).cast("long"))
    sources = sources.withColumn("_due", due - F.col("_epochs") * F.col("_size"))
    # Where the last, shorter block stands in the round of draws that isn't complete.
    short_at = permuted(F.col("_blocks") - 1, F.col("_blocks"), F.lit(seed), F.col("_src"), F.col("_epochs"), inverse=True)
    sources = sources.withColumn("_short_at", F.when(F.col("_blocks") > 0, short_at))
    gap = F.when(F.col("_due") > F.col("_short_at") * block, block - F.col("_short")).otherwise(0)
    more = F.when(F.col("_due") > 0, F.ceil((F.col("_due") + gap) / block)).otherwise(0).cast("long")
    sources = sources.withColumn("_draws", F.col("_epochs") * F.col("_blocks") + more)
    before = F.sum("_draws").over(Window.orderBy("_src")) - F.col("_draws")
    sources = durable(sources.withColumn("_before", before).withColumn("_all", F.sum("_draws").over(Window.partitionBy())), "mix-sources")

    # Each document's place in its source's stream.
    placed = rows.withColumn("_bucket", F.pmod("_h", F.lit(buckets)))
    sums = placed.groupBy("source", "_bucket").agg(F.sum("size").alias("_n"))
    ahead = F.sum("_n").over(Window.partitionBy("source").orderBy("_bucket")) - F.col("_n")
    sums = sums.select(F.col("source").alias("_s"), F.col("_bucket").alias("_b"), ahead.alias("_ahead"))
    line = Window.partitionBy("source", "_bucket").orderBy("_h", "doc_id", *carry).rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumn("_to", F.sum("size").over(line))
    placed = placed.join(sums, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b")))
    placed = placed.withColumn("_start", F.col("_ahead") + F.col("_to") - F.col("size"))
    known = sources.select(F.col("source").alias("_s2"), "_src", F.col("_size").alias("source_size"), "target")
    placed = placed.select("doc_id", "source", "size", *carry, "_start").join(known, F.col("source").eqNullSafe(F.col("_s2")))
    placed = durable(placed.drop("_s2"), "mix-placed")

    # Slots of the mix: which block of which source, and how many of its words.
    drawn = sources.agg(F.max("_all")).first()[0] or 0
    counts = durable(drawn_counts(docs.sparkSession, sources, drawn, slots_per_shard, seed), "mix-counts")
    draws = numbered_draws(counts, sources, drawn, seed).join(sources.where("_draws > 0").drop("source", "_weight"), "_src")
    draws = draws.withColumn("epoch", F.floor(F.col("_draw") / F.col("_blocks"))).withColumn("_at", F.col("_draw") % F.col("_blocks"))
    draws = draws.withColumn("block", permuted(F.col("_at"), F.col("_blocks"), F.lit(seed), F.col("_src"), F.col("epoch")))
    had = F.col("_at") * block - F.when(F.col("_at") > F.col("_short_at"), block - F.col("_short")).otherwise(0)
    whole = F.when(F.col("block") == F.col("_blocks") - 1, F.col("_short")).otherwise(F.lit(block))
    use = F.when(F.col("epoch") < F.col("_epochs"), whole).otherwise(F.least(whole, F.col("_due") - had))
    slots = draws.select("shard", "slot", "_src", "epoch", "block", use.cast("long").alias("_use"))

    # Blocks: the stretches of documents that they are made of.
    first, last = F.floor(F.col("_start") / block), F.floor((F.col("_start") + F.col("size") - 1) / block)
    parts = placed.where("size > 0").select("_src", "_start", "size", F.explode(F.sequence(first, last)).alias("block"))
    begin = F.greatest(F.col("_start"), F.col("block") * block)
    end = F.least(F.col("_start") + F.col("size"), F.col("block") * block + F.col("_use"))
    # The slots are many more rows than Spark can tell beforehand: neither side is to be broadcast.
    spans = slots.join(parts.hint("merge"), ["_src", "block"]).withColumn("length", end - begin).where("length > 0")
    spans = spans.select("shard", "slot", "epoch", "block", "_src", "_start", (begin - F.col("_start")).alias("first"), "length")

    taken = spans.groupBy("_src", "_start").agg(F.sum("length").alias("_taken"))
    taken = taken.select(F.col("_src").alias("_a"), F.col("_start").alias("_b"), "_taken")
    same = (F.col("_src") == F.col("_a")) & (F.col("_start") == F.col("_b")) & (F.col("size") > 0)
    documents = placed.join(taken, same, "left").withColumn("taken", F.coalesce("_taken", F.lit(0)).cast("long"))
    return Mix(documents.drop("_a", "_b", "_taken"), spans, sources, counts, placed)
