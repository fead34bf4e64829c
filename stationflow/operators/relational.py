"""Joins, filters, ordering and previews."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from stationflow.functions.scalar import as_date
from stationflow.session import durable


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a value in every one of ``columns``.

    A conjunction of single conditions, unlike ``dropna``, whose one condition over all columns
    makes Spark derive a version for every subset of them that is renamed further up.
    """
    return df.where(" and ".join(f"`{c}` is not null" for c in columns)) if columns else df


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def attach(fact: DataFrame, dim: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join a fact to a dimension.

    No broadcast hint: Spark broadcasts the dimension when its size is known to be below
    ``autoBroadcastJoinThreshold``, and otherwise shuffles both sides, where adaptive
    execution splits the partitions of hot keys.
    """
    return fact.join(dim, list(keys), how)


def with_scalar(df: DataFrame, source: DataFrame, **aggregates: Column) -> DataFrame:
    """Attach ungrouped aggregates of ``source`` to every row. The aggregation, which gives exactly one
    row, is done here, so nothing larger can be broadcast."""
    one_row = source.agg(*[column.alias(name) for name, column in aggregates.items()])
    return df.crossJoin(F.broadcast(one_row))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child keys without a parent, with the number of child rows that carry them.

    Children are counted per key first, so the join handles one row per key and a key that
    holds most of the child rows costs nothing extra.
    """
    counted = child.where(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("key")).agg(F.count("*").alias("rows"))
    return counted.join(parent.select(F.col(parent_key).alias("key")), "key", "left_anti")


def name_matches(col: Column, pattern: str) -> Column:
    """Case-insensitive LIKE; ``%`` and ``_`` in the pattern are wildcards."""
    return F.ilike(col, F.lit(pattern))


def on_day(df: DataFrame, date_column: str, day: dt.date | str | None) -> DataFrame:
    """Filter by day only when one is given."""
    return df if day is None else df.where(F.col(date_column) == as_date(day))


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    name: str,
    day: dt.date | str | None = None,
    date_column: str | None = None,
    key: str = "province_id",
    name_column: str = "province_name",
) -> DataFrame:
    """Fact rows of the places whose dimension name matches, optionally of one day.

    The dimension's name wins over a name column of the fact. Both filters sit below the
    join; the day filter reaches the fact's scan.
    """
    places = dim.where(name_matches(F.col(name_column), name)).select(key, name_column)
    rows = fact.drop(name_column)
    if date_column is not None:
        rows = on_day(rows, date_column, day)
    return rows.join(places, key)


def preview(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 3) -> DataFrame:
    """The first ``n`` rows per key with ``row`` and how many rows were left out.

    The input is written once and read for two cheap halves instead of a count over a window: the
    top-n is cut per map task before the shuffle, the count is a partial aggregate, and their join
    has at most ``n`` rows a key.
    """
    rows = durable(df, "preview")
    window = Window.partitionBy(*keys).orderBy(*order)
    top = rows.withColumn("row", F.row_number().over(window)).where(F.col("row") <= n)
    total = rows.groupBy(*keys).agg(F.count("*").alias("total"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_t_{k}")) for k in keys])
    total = total.withColumnsRenamed({k: f"_t_{k}" for k in keys})
    joined = top.join(total, same).withColumn("remaining", F.greatest(F.col("total") - n, F.lit(0)))
    return joined.drop("total", *[f"_t_{k}" for k in keys])


def format_rows(df: DataFrame, columns: Sequence[str], out: str = "lines") -> DataFrame:
    """Each row as ``- column: value`` lines."""
    lines = [F.concat(F.lit(f"- {c}: "), F.coalesce(F.col(c).cast("string"), F.lit("None"))) for c in columns]
    return df.withColumn(out, F.concat_ws("\n", *lines))
