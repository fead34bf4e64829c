"""Best-fit packing of tokenized documents into sequences of a fixed length."""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from stationflow.llm.common import in_small_batches, steps
from stationflow.session import durable

#: Words whose ids a task remembers until it ends. At so many it starts anew, but takes over from the last so many
#: what it meets again, so frequent words stay and its memory is bounded.
REMEMBERED_WORDS = 300_000

#: Words that the tokenizer's normaliser only lower-cases and that are a token run of their own,
#: apart from marks at their end, which are runs of their own too.
PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)")

_TOKENIZERS: dict = {}


def _byte_letters() -> dict[int, str]:
    """The letters by which byte-level models write bytes: printable ones are themselves, the others
    follow from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class WordTokenizer:
    """Ids of whole texts by a byte-level tokenizer that drops white space, lower-cases and never
    joins across white space: the ids of a text are those of its words one after the other, so
    frequent words are looked up. Plain words go straight to the tokenizer's model; all others go
    through the whole tokenizer."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.known: dict[bytes, bytes] = {}
        self.former = self.known
        self.marks: dict[str, bytes] = {"": b""}

    def encoded(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, words: list[bytes]) -> None:
        others = []
        for raw in words:
            if former := self.former.get(raw):
                self.known[raw] = former
                continue
            found = PLAIN.fullmatch(raw.decode())
            if not found:
                others.append(raw)
                continue
            core, mark = found[1].lower(), found[2]
            # A plain word without marks is its own core, so cores are found among the words.
            bare = core.encode()
            if not (ids := self.known.get(bare) or self.former.get(bare)):
                letters = core if core.isascii() else bare.decode("latin-1").translate(self.letters)
                ids = array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()
            self.known[bare] = ids
            if mark not in self.marks:
                self.marks[mark] = self.encoded([mark])[0]
            self.known[raw] = ids + self.marks[mark]
        self.known.update(zip(others, self.encoded([w.decode() for w in others])))

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each UTF-8 text."""
        split = [t.split() for t in texts]
        if len(self.known) > REMEMBERED_WORDS:
            self.known, self.former = {}, self.known
        if len(self.marks) > REMEMBERED_WORDS:
            self.marks = {"": b""}
        self.learn(list(set().union(*split).difference(self.known)))
        return [b"".join(map(self.known.__getitem__, found)) for found in split]

    def forget(self) -> None:
        self.known, self.marks = {}, {"": b""}
        self.former = self.known


def word_tokenizer(path: str) -> WordTokenizer:
    """One for each Python worker and path."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def token_pieces(docs: DataFrame, doc_id: Column, text: Column, tokenizer: str, length: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """The ids of each whole text and ``end_id``, cut into pieces of ``length`` where they are
    longer: ``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids``. A null text is
    empty and gives the one id ``end_id``."""
    rows = docs.select(doc_id.alias("doc_id"), text.cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    ending, width = np.array([end_id], "<u4").tobytes(), 4 * length

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_tokenizer(tokenizer)
        try:
            yield from cut(batches, encoder)
        finally:  # the worker goes on with other operators' tasks
            encoder.forget()
            pa.default_memory_pool().release_unused()

    def cut(batches: Iterator[pa.RecordBatch], encoder: WordTokenizer) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch):
                texts = [t or b"" for t in part.column(1).to_pylist()]
                out: dict[str, list] = {"of": [], "piece": [], "start": [], "length": [], "crc": [], "ids": []}
                for i, ids in enumerate(encoder.ids(texts)):
                    ids += ending
                    for k, at in enumerate(range(0, len(ids), width)):
                        own = ids[at : at + width]
                        for column, value in zip(out.values(), (i, k, at // 4, len(own) // 4, zlib.crc32(own), own)):
                            column.append(value)
                arrays = [part.column(0).take(pa.array(out["of"], pa.int32())), pa.array(out["piece"], pa.int32())]
                arrays += [pa.array(out[c], pa.int64()) for c in ("start", "length", "crc")]
                if with_ids:
                    arrays.append(pa.array([np.frombuffer(c, "<u4").astype(np.int32) for c in out["ids"]], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(arrays)])

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return in_small_batches(rows).mapInArrow(pieces, schema)


def best_two_fit(counts: np.ndarray, size: int) -> list[tuple[int, list[int]]]:
    """Bins for ``counts[n]`` documents of each length n up to ``size``, as (how many, lengths).

    A bin takes the longest document left and then, greedily, the longest that fits its gap. Then
    its smallest document is replaced by the two unpacked ones that fit the expanded gap best, as
    long as that is tighter. The same bin is made as often as the counts allow, so the work goes
    with the number of different lengths, not of documents."""
    left, bins = counts.astype(np.int64).copy(), []
    left[0] = 0

    def tightest_two(gap: int, over: int, free: np.ndarray) -> tuple[int, int] | None:
        """Two lengths with the largest sum in (over, gap]."""
        have = free > 0
        known = np.flatnonzero(have[: gap + 1])
        if len(known) < 64:
            sums = known[:, None] + known[None, :]
            alone = np.eye(len(known), dtype=bool) & (free[known] < 2)[:, None]
            sums[alone | (sums > gap)] = 0
            if not sums.size or sums.max() <= over:
                return None
            a, b = np.unravel_index(int(sums.argmax()), sums.shape)
            return int(known[a]), int(known[b])
        for total in range(gap, over, -1):
            found = np.flatnonzero(have[1:total] & have[total - 1 : 0 : -1]) + 1
            found = found[(2 * found != total) | (free[found] > 1)]
            if len(found):
                return int(found[-1]), int(total - found[-1])
        return None

    while left.any():
        longest = int(np.flatnonzero(left)[-1])
        free, inside, gap = left.copy(), [longest], size - longest
        free[longest] -= 1
        while gap and len(fits := np.flatnonzero(free[: gap + 1])):
            inside.append(int(fits[-1]))
            free[inside[-1]] -= 1
            gap -= inside[-1]
        while gap and len(inside) > 1:
            smallest = min(inside)
            free[smallest] += 1
            two = tightest_two(gap + smallest, smallest, free)
            if not two:
                free[smallest] -= 1
                break
            inside.remove(smallest)
            inside += two
            for n in two:
                free[n] -= 1
            gap += smallest - sum(two)
        used = Counter(inside)
        times = min(int(left[n]) // k for n, k in used.items())
        for n, k in used.items():
            left[n] -= times * k
        bins.append((times, inside))
    return bins


def seats(bins: list[tuple[int, list[int]]]) -> dict[str, np.ndarray]:
    """For every place in every kind of bin the ranks, among the documents of its length, that sit
    there: ``key`` (length and first rank), ``sequence`` of the first rank, ``offset``."""
    rank: Counter[int] = Counter()
    key, sequence, offset, first = [], [], [], 0
    for times, inside in bins:
        at = 0
        for n in inside:
            key.append((n << 40) + rank[n])
            sequence.append(first)
            offset.append(at)
            rank[n] += times
            at += n
        first += times
    order = np.argsort(np.array(key, np.int64), kind="stable")
    return {k: np.array(v, np.int64)[order] for k, v in (("key", key), ("sequence", sequence), ("offset", offset))}


def pack(pieces: DataFrame, length: int = 2048, rows_per_bucket: int = 20_000) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of at most ``length`` tokens: Best-two-fit.

    Only the number of pieces of each length, at most ``length`` numbers, goes to the driver, where
    the bins are planned. Each piece then finds its seat by its rank among those of its length. The
    rank is a sum over buckets by hash plus a place in the bucket, so that one length with a third
    of all pieces is not gathered in one task. Nothing is dropped; repeated rows are packed as
    often as they occur; no pieces give no rows."""
    pieces = durable(pieces, "pieces")
    counts = np.zeros(length + 1, np.int64)
    total = 0
    for n, k in pieces.groupBy("length").count().collect():
        counts[n], total = k, total + k
    plan = seats(best_two_fit(counts, length))
    buckets = max(1, -(-total // rows_per_bucket))

    identity = ["doc_id", "piece", "ids_crc32"]
    rows = pieces.withColumn("_bucket", F.pmod(F.xxhash64(*identity), F.lit(buckets)).cast("int"))
    sums = rows.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    ahead = F.sum("_n").over(Window.partitionBy("length").orderBy("_bucket")) - F.col("_n")
    sums = sums.select("length", "_bucket", ahead.alias("_ahead"))
    place = F.row_number().over(Window.partitionBy("length", "_bucket").orderBy(*identity)) - 1
    ranked = rows.withColumn("_place", place).join(sums, ["length", "_bucket"])
    ranked = ranked.select(*pieces.columns, (F.col("_ahead") + F.col("_place")).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    shared = pieces.sparkSession.sparkContext.broadcast(plan)  # at most some places for each length

    def seated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sequence, offset = shared.value["key"], shared.value["sequence"], shared.value["offset"]
        for batch in batches:
            names = batch.schema.names
            rank, n = np.asarray(batch.column(names.index("sequence_id"))), np.asarray(batch.column(names.index("length")))
            at = np.searchsorted(key, (n << 40) + rank, side="right") - 1
            columns = batch.columns[:-2] + [pa.array(sequence[at] + ((n << 40) + rank - key[at])), pa.array(offset[at])]
            yield pa.RecordBatch.from_arrays(columns, names)

    return in_small_batches(ranked).mapInArrow(seated, ranked.schema)
