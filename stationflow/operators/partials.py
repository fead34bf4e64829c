"""Measures as mergeable partial states: of any split of the rows, the parts add up to the whole."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

# How a kind of measure is kept: its parts, how rows make them and how parts merge.
_SUM, _COUNT = (F.sum, F.sum), (F.count, F.sum)
PARTS = {
    "average": {"sum": _SUM, "n": _COUNT},
    "sum": {"sum": _SUM},
    "count": {"n": _COUNT},
    "max": {"max": (F.max, F.max)},
    "min": {"min": (F.min, F.min)},
}


@dataclass(frozen=True)
class Kept:
    """A measure of a kind of PARTS over a row's value."""

    kind: str
    value: Column


def _part(name: str, part: str) -> str:
    return f"{name}__{part}"


def partial_states(rows: DataFrame, keys: Sequence[str], measures: Mapping[str, Kept]) -> DataFrame:
    """One row a key with the parts of all measures. Fixed-size buffers, combined before the shuffle."""
    made = [
        make(kept.value).alias(_part(name, part))
        for name, kept in measures.items()
        for part, (make, _) in PARTS[kept.kind].items()
    ]
    return rows.groupBy(*keys).agg(*made)


def merge_states(states: DataFrame, keys: Sequence[str], measures: Mapping[str, Kept]) -> DataFrame:
    """States of the same key, from however many batches, as one. Parts are added in no set order,
    which the last bits of a double's sum may show."""
    merged = [
        merge(_part(name, part)).alias(_part(name, part))
        for name, kept in measures.items()
        for part, (_, merge) in PARTS[kept.kind].items()
    ]
    return states.groupBy(*keys).agg(*merged)


def finish_states(states: DataFrame, keys: Sequence[str], measures: Mapping[str, Kept]) -> DataFrame:
    """The measures of merged states. Without a value an average, sum, maximum or minimum is NULL, a count 0."""

    def value(name: str, kind: str) -> Column:
        if kind == "average":
            return F.try_divide(F.col(_part(name, "sum")), F.col(_part(name, "n")))
        return F.col(_part(name, next(iter(PARTS[kind]))))

    return states.select(*keys, *[value(name, kept.kind).alias(name) for name, kept in measures.items()])
