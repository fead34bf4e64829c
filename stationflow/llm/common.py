"""Expressions and helpers that several corpus operators use."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

# The white space of the contracts, as regular expressions.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"

#: Bytes of text that a task looks at in one numpy step.
STEP_BYTES = 1 << 20

#: Rows and bytes that Spark hands to a Python worker at once.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": 2000, "spark.sql.execution.arrow.maxBytesPerBatch": 8 << 20}

U64 = np.uint64


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once a row, however often the body mentions it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """All words of the whole text; a null text has none."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit(*columns: Column) -> Column:
    """A pseudorandom number in (0, 1) that only depends on the columns."""
    return (F.shiftrightunsigned(F.xxhash64(*columns), 11).cast("double") + 0.5) / float(1 << 53)


def wider(schema: T.StructType, **more: str) -> T.StructType:
    """A new schema with more fields, by name and type."""
    out = T.StructType(list(schema.fields))
    for name, kind in more.items():
        out = out.add(name, kind)
    return out


def in_small_batches(df: DataFrame) -> DataFrame:
    """Lower the session's Arrow batches, which JVM and Python worker hold a copy of each, to BATCHES;
    a text that is longer is a batch of its own."""
    conf = df.sparkSession.conf
    for key, most in BATCHES.items():
        now = int(re.sub(r"\D", "", conf.get(key)) or 0)
        if now <= 0 or now > most:
            conf.set(key, str(most))
    return df


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def steps(batch: pa.RecordBatch, column: str = "text", budget: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``budget`` bytes of texts, or of lists of 32-bit numbers; a longer
    one is a slice of its own."""
    column = batch.column(batch.schema.get_field_index(column))
    sizes = pc.multiply(pc.list_value_length(column), 4) if pa.types.is_list(column.type) else pc.binary_length(column)
    sizes = np.asarray(pc.fill_null(sizes, 0), dtype=np.int64)
    start = 0
    for end in np.flatnonzero(np.diff(np.cumsum(sizes) // budget, append=-1)) + 1 if len(sizes) else []:
        yield batch.slice(start, end - start)
        start = int(end)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, each followed by one space, and where each text starts (and the
    end). A null counts as empty."""
    blank = lambda x: pa.scalar(x, pa.large_string())
    texts = pc.binary_join_element_wise(pc.fill_null(texts.cast(pa.large_string()), blank("")), blank(" "), blank(""))
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


_POWERS = [np.ones(1, U64)]


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of an odd constant, modulo 2^64."""
    if len(_POWERS[0]) < n:
        base = np.full(max(n, 2 * len(_POWERS[0])), U64(0x9E3779B97F4A7C15), U64)
        base[0] = 1
        with np.errstate(over="ignore"):
            _POWERS[0] = np.multiply.accumulate(base)
    return _POWERS[0][:n]


_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(0xD6E8FEB86659FD93))


def hashed_words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word, and how many words precede each text (and all). The bytes come
    from ``utf8``; words are what the white space of the contracts separates."""
    if not len(data):
        return np.zeros(0, U64), np.zeros(len(bounds), np.int64)
    inside = (data != 32) & ((data < 9) | (data > 13))
    starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    before = np.searchsorted(starts, bounds)
    if not len(starts):
        return np.zeros(0, U64), before
    ends = np.flatnonzero(inside & ~np.concatenate([inside[1:], [False]])) + 1
    lengths = np.diff(np.append(starts, len(data)))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, lengths)
    with np.errstate(over="ignore"):
        terms = _BYTE[data[starts[0] :]] * powers(int(lengths.max()))[place]
        terms[~inside[starts[0] :]] = 0
        found = np.add.reduceat(terms, starts - starts[0])
        return mix(found + (ends - starts).astype(U64)), before


def appended(docs: DataFrame, out: str, kind: str, compute: Callable[..., pa.Array], *inputs: Column) -> DataFrame:
    """``docs`` with a column ``out`` of type ``kind``, computed from the input columns in steps of
    about STEP_BYTES of the first one. Other columns pass through; one called ``out`` is replaced."""
    kept = [c for c in docs.columns if c != out]
    names = [f"_input{i}" for i in range(len(inputs))]
    while set(names) & set(kept):
        names = [f"_{n}" for n in names]
    rows = docs.select(*[F.col("`" + c.replace("`", "``") + "`") for c in kept], *[column.alias(n) for column, n in zip(inputs, names)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, names[0]):
                columns = part.columns
                yield pa.RecordBatch.from_arrays([*columns[: len(kept)], compute(*columns[len(kept) :])], [*kept, out])

    schema = T.StructType([*rows.schema.fields[: len(kept)], T.StructField(out, T.DataType.fromDDL(kind))])
    return in_small_batches(rows).mapInArrow(work, schema)
