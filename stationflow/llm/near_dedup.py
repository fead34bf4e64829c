"""Near-duplicate documents: ProbMinHash signatures, banding, exact verification, classes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from stationflow.llm.common import U64, hashed_words, in_small_batches, mix, powers, steps, utf8
from stationflow.llm.components import components
from stationflow.session import durable

BANDS, ROWS = 24, 4
REGISTERS = BANDS * ROWS
#: 64-bit words of the odd sketch: bit h of it says whether an odd number of the text's shingles hash
#: to h. Two sketches differ in at most as many bits as the sets differ in shingles, so it never
#: rules out a pair that is similar enough.
SKETCH = [f"o{i}" for i in range(16)]
#: What is known of a text beside its bands.
BITS = ["n", "s1", "s2", *SKETCH]
#: Bytes of text that a task takes the shingles of at once; their arrays take many times as much.
SIGNED_BYTES = 1 << 19
_STEP = U64(0x9E3779B97F4A7C15)


def shingles(data: np.ndarray, bounds: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all windows of ``width`` words, the text that each belongs to, and two 64-bit keys
    of each text's word sequence. A text of fewer words has one shingle, of none no shingle."""
    found, before = hashed_words(data, bounds)
    texts, counts = len(bounds) - 1, np.diff(before)
    owner = np.repeat(np.arange(texts), counts)
    place = np.arange(len(found)) - before[owner]
    with np.errstate(over="ignore"):
        length = np.minimum(counts, width)[owner]
        starts = place <= counts[owner] - length
        starts[(counts[owner] < width) & (place > 0)] = False
        at = np.flatnonzero(starts)
        total = length[at].astype(U64) * _STEP
        padded = np.concatenate([found, np.zeros(width, U64)])
        for k in range(width):
            total += np.where(k < length[at], padded[at + k], U64(0)) * powers(width + 2)[k + 1]
        keys = np.zeros((2, texts), U64)
        if len(found):
            full = np.flatnonzero(counts)
            scale = powers(int(counts.max()) + 1)[place]
            for i, terms in enumerate((found * scale, mix(found ^ _STEP) * scale)):
                keys[i, full] = mix(np.add.reduceat(terms, before[full]) + counts[full].astype(U64))
    return mix(total), owner[at], keys


def weighted(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's different shingles and their weights, 1 + ln(count): repeats weigh more, but one
    line that a text repeats doesn't outweigh the rest of it."""
    with np.errstate(over="ignore"):
        _, first, count = np.unique(hashes + mix(owner.astype(U64) + U64(1)), return_index=True, return_counts=True)
    return hashes[first], owner[first], 1.0 + np.log(count)


def prob_minhash(hashes: np.ndarray, owner: np.ndarray, weight: np.ndarray, texts: int, registers: int = REGISTERS) -> np.ndarray:
    """For each text and register the shingle that arrives there first.

    Each shingle is a Poisson process whose rate is its weight and whose arrivals go to
    pseudorandom registers; times and registers depend on the shingle alone. A shingle stops as
    soon as its next arrival comes after the text's last open register was taken. Two texts agree
    in a register with the probability of their probability Jaccard similarity."""
    first = np.full(texts * registers, np.inf)
    winner = np.zeros(texts * registers, U64)
    live = np.arange(len(hashes))
    state, time = hashes.copy(), np.zeros(len(hashes))
    while len(live):
        with np.errstate(over="ignore"):
            state = state + _STEP
        drawn = mix(state)
        time = time - np.log(((drawn >> U64(11)).astype(np.float64) + 0.5) / (1 << 53)) / weight[live]
        register = ((drawn & U64(0x7FF)) * U64(registers) >> U64(11)).astype(np.int64) + owner[live] * registers
        np.minimum.at(first, register, time)
        won = first[register] == time
        winner[register[won]] = hashes[live[won]]
        last = first.reshape(texts, registers).max(axis=1)
        goes_on = time < last[owner[live]]
        live, state, time = live[goes_on], state[goes_on], time[goes_on]
    return winner.reshape(texts, registers)


def _bands(signature: np.ndarray) -> np.ndarray:
    """A hash of each band of each text."""
    with np.errstate(over="ignore"):
        sums = (signature.reshape(-1, BANDS, ROWS) * powers(ROWS + 1)[1:]).sum(axis=2, dtype=U64)
        return mix(sums + np.arange(1, BANDS + 1, dtype=U64) * _STEP).view(np.int64)


def _words_of(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return utf8(pc.utf8_lower(part.column(1).cast(pa.large_string())))


def signatures(docs: DataFrame, doc_id: Column, text: Column) -> DataFrame:
    """A row for each row of docs: ``doc_id, k1, k2`` (128 bits of the lower-cased word sequence;
    null for a null text), ``n`` (different shingles), ``s1, s2`` (a bit of each register), the odd
    sketch and ``bands`` (hashes of groups of registers).

    The registers are those of equal weights, in which two texts agree with the probability of their
    sets' Jaccard similarity, whatever either repeats. A text that repeats some shingles more than
    others also has the bands of its weights, which are the same as the others if weights are equal."""
    rows = docs.select(doc_id.alias("doc_id"), text.alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, budget=SIGNED_BYTES):
                texts, missing = part.num_rows, part.column(1).is_null()
                found, owner, keys = shingles(*_words_of(part))
                found, owner, weight = weighted(found, owner)
                signature, n = prob_minhash(found, owner, np.ones(len(found)), texts), np.bincount(owner, minlength=texts)
                heaviest = np.zeros(texts)
                np.maximum.at(heaviest, owner, weight)
                uneven = np.bincount(owner, weight < heaviest[owner], minlength=texts) > 0
                some, heavy = uneven[owner], np.flatnonzero(uneven)
                leaning = prob_minhash(found[some], (np.cumsum(uneven) - 1)[owner[some]], weight[some], len(heavy))
                bits = np.zeros((texts, 128), np.uint8)
                bits[:, :REGISTERS] = (signature & U64(1)).astype(np.uint8)
                bits = np.packbits(bits, axis=1).view(np.int64)
                places = owner * (64 * len(SKETCH)) + (found & U64(64 * len(SKETCH) - 1)).astype(np.int64)
                odd = (np.bincount(places, minlength=texts * 64 * len(SKETCH)) & 1).astype(np.uint8)
                odd = np.packbits(odd.reshape(texts, -1), axis=1).view(np.int64)
                bands, more = _bands(signature), _bands(leaning)
                new = more != bands[heavy]
                of = np.concatenate([np.repeat(np.flatnonzero(n), BANDS), np.repeat(heavy, BANDS)[new.ravel()]])
                bands = np.concatenate([bands[n > 0].ravel(), more[new]])[np.argsort(of, kind="stable")]
                ends = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=texts))])
                hidden = np.asarray(missing.cast(pa.uint8())).astype(bool)
                arrays = [part.column(0), *(pa.array(k.view(np.int64), mask=hidden) for k in keys), pa.array(n)]
                arrays += [pa.array(bits[:, 0].copy()), pa.array(bits[:, 1].copy()), *(pa.array(o.copy()) for o in odd.T)]
                arrays += [pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(bands))]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "k1", "k2", *BITS, "bands"])

    return in_small_batches(rows).mapInArrow(signed, f"doc_id {kind}, k1 long, k2 long, {', '.join(f'{c} long' for c in BITS)}, bands array<long>")


def _told(bits: DataFrame, side: str) -> DataFrame:
    """The nodes as one side, a or b, of a pair."""
    return bits.withColumnsRenamed({"node": side} | {c: c + side for c in BITS})


def _differ(names: list[str]) -> Column:
    """In how many bits the two sides of a pair differ."""
    return sum((F.bit_count(F.col(f"{c}a").bitwiseXOR(F.col(f"{c}b"))) for c in names[1:]), F.bit_count(F.col(f"{names[0]}a").bitwiseXOR(F.col(f"{names[0]}b"))))


def _may_be_similar(least: float) -> Column:
    """False only for pairs whose similarity is less than ``least``, by the numbers of shingles and the
    odd sketches. J >= t means that the sets differ in at most (1 - t) / (1 + t) of their sizes' sum,
    and so do their sizes."""
    most = (1 - least) / (1 + least) * (F.col("na") + F.col("nb")) + 1e-9
    return (F.abs(F.col("na") - F.col("nb")) <= most) & (_differ(SKETCH) <= most)


def _similar(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, doc_id: Column, text: Column, least: float) -> DataFrame:
    """The pairs ``a, b`` whose sets of shingles have a Jaccard similarity of ``least`` or more,
    computed from the whole texts."""
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).dropDuplicates().join(nodes, "node")
    wanted = durable(wanted.select("node", "k1", "k2", "first_doc"), "near-wanted")
    rows = docs.select(doc_id.alias("doc_id"), text.alias("text"))
    rows = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("first_doc")), "left_semi")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, budget=SIGNED_BYTES):
                found, owner, keys = shingles(*_words_of(part))
                ends = np.searchsorted(owner, np.arange(part.num_rows + 1))
                each = [np.unique(found[a:b]).tobytes() for a, b in zip(ends[:-1], ends[1:])]
                arrays = [pa.array(keys[0].view(np.int64)), pa.array(keys[1].view(np.int64)), pa.array(each, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["k1", "k2", "grams"])

    grams = in_small_batches(rows).mapInArrow(sets, "k1 long, k2 long, grams binary")
    grams = wanted.select("node", "k1", "k2").join(grams, ["k1", "k2"]).dropDuplicates(["node"]).select("node", "grams")
    grams = durable(grams, "near-grams")
    both = pairs.join(grams.withColumnsRenamed({"node": "a", "grams": "x"}), "a")
    both = both.join(grams.withColumnsRenamed({"node": "b", "grams": "y"}), "b").select("a", "b", "x", "y")

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
                x, y = (x, y) if len(x) < len(y) else (y, x)
                common = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum()) if len(x) else 0
                keep.append(common + 1e-9 >= least * (len(x) + len(y) - common))
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], ["a", "b"])

    return durable(in_small_batches(both).mapInArrow(verified, "a long, b long"), "near-links")


def near_duplicates(docs: DataFrame, doc_id: Column, text: Column, least: float = 0.8) -> DataFrame:
    """``doc_id, class_id, root``: a row for each row of docs. Documents are linked when the sets of
    their five-word shingles (lower-cased, white space apart) have a Jaccard similarity of ``least``
    or more; a class is what links connect; class_id is its smallest doc_id.

    Copies with the same words are one node from the start. Nodes that agree in a band of the
    ProbMinHash signature are candidates. The bands of equal weights alone miss a pair whose sets are
    0.8 similar with a probability of 3e-6, at 0.9 of 1e-11, whatever lines either text repeats; the
    bands of the counts' weights only add candidates. In a bucket every node is first compared with the head of it, of several heads
    the likeliest, so a large group of copies costs one comparison a node. Then, in buckets whose
    nodes aren't in one class by now, every pair of different classes is taken that the odd sketch
    doesn't rule out; pairs inside a class need no look. Verification is exact, by the sets of the
    whole texts; there is no cap on buckets or partners.

    A null text is in a class of its own. Texts without words are copies of each other; texts of one
    to four words have one shingle. Rows that share a doc_id have a class by their own text. No
    rows give no rows."""
    signed = durable(signatures(docs, doc_id, text), "near-signatures")
    nodes = signed.where("k1 is not null").groupBy("k1", "k2")
    nodes = nodes.agg(F.min("doc_id").alias("first_doc"), *[F.first(c).alias(c) for c in (*BITS, "bands")])
    nodes = durable(nodes.withColumn("node", F.monotonically_increasing_id()), "near-nodes")
    bits = nodes.select("node", *BITS)

    # The head of a bucket is its node with the most company in all its buckets: among copies with
    # more and fewer edits one with few, which the others are likeliest similar to.
    members = nodes.select("node", F.explode("bands").alias("band"))
    sizes = members.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    members = durable(members.join(sizes, "band"), "near-members")
    company = members.groupBy("node").agg(F.sum("size").alias("company"))
    heads = members.join(company, "node").groupBy("band").agg(F.max(F.struct("company", "node")).alias("head"))
    members = durable(members.join(heads, "band").select("band", "node", F.col("head.node").alias("head")), "near-members")

    stars = members.where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b")).dropDuplicates()
    stars = stars.join(_told(bits, "a"), "a").join(_told(bits, "b"), "b").where(_may_be_similar(least))
    best = stars.groupBy("a").agg(F.min(F.struct(_differ([*SKETCH, "s1", "s2"]).alias("apart"), "b")).alias("best")).select("a", F.col("best.b").alias("b"))
    links = _similar(durable(best, "near-pairs"), nodes, docs, doc_id, text, least)
    roots = components(links)

    # What is left: pairs of a bucket in different classes, one of them not in the head's class. Each
    # join of its own table is written before the next, as what a query gathers at once is the driver's load.
    known = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    heads = known.where("node = head").select("band", F.col("root").alias("main"))
    minor = known.join(heads, "band").where("root <> main").select("band", F.col("node").alias("a"), F.col("root").alias("ra"))
    minor = durable(minor, "near-minor")
    mixed = known.join(minor.select("band").dropDuplicates(), "band", "left_semi")
    mixed = mixed.select("band", F.col("node").alias("b"), F.col("root").alias("rb"))
    minor, mixed = minor.join(_told(bits, "a"), "a").alias("x"), mixed.join(_told(bits, "b"), "b").alias("y")
    holds = (F.col("x.band") == F.col("y.band")) & (F.col("ra") != F.col("rb")) & _may_be_similar(least)
    pairs = minor.join(mixed, holds).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).dropDuplicates()
    tried = best.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    pairs = durable(pairs.join(tried, ["a", "b"], "left_anti"), "near-pairs")
    if not pairs.isEmpty():
        # The first links' stars stand for them.
        stars = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
        roots = components(stars.unionByName(_similar(pairs, nodes, docs, doc_id, text, least)))

    classes = nodes.select("node", "k1", "k2", "first_doc").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = classes.groupBy("root").agg(F.min("first_doc").alias("class_id"))
    classes = durable(classes.join(ids, "root").select("k1", "k2", "root", "class_id"), "near-classes")
    found = signed.select("doc_id", "k1", "k2").join(classes, ["k1", "k2"], "left")
    own = F.when(F.col("k1").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
    return found.select("doc_id", own.alias("class_id"), "root")
