"""Incremental selection and merge, as plans over a source and a target."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def merge_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str] | None = None,
) -> DataFrame:
    """The target after merging ``source``, whose keys must be unique.

    A matched row takes all source columns, or only ``update_columns`` and keeps the rest. An
    unmatched source row is inserted, an unmatched target row stays. A NULL in a key equals a
    NULL, so merging the same rows again changes nothing. Both sides are unique by key, so no
    join key is hot.
    """
    keys, columns = list(keys), target.columns
    if update_columns is None:
        known = source.select(*[F.col(k).alias(f"_key_{k}") for k in keys])
        kept = target.join(known, _same(target, known, keys), "left_anti")
        return kept.unionByName(source.select(*columns))
    s = source.select(*[F.col(c).alias(f"_key_{c}" if c in keys else f"_new_{c}") for c in columns], F.lit(True).alias("_in_source"))
    joined = target.withColumn("_in_target", F.lit(True)).join(s, _same(target, s, keys), "full")
    inserted, matched = F.col("_in_target").isNull(), F.col("_in_source").isNotNull()
    out = []
    for name in columns:
        take = inserted if name in keys or name not in update_columns else matched
        new = F.col(f"_key_{name}" if name in keys else f"_new_{name}")
        out.append(F.when(take, new).otherwise(F.col(name)).alias(name))
    return joined.select(*out)


def _same(target: DataFrame, source: DataFrame, keys: Sequence[str]):
    return reduce(lambda a, b: a & b, [target[k].eqNullSafe(source[f"_key_{k}"]) for k in keys])


def detect_changes(
    source: DataFrame,
    target: DataFrame,
    key: str,
    compare: Sequence[str],
    null_safe: bool = False,
    keep_from_target: Sequence[str] = ("created_at",),
) -> DataFrame:
    """Source rows that are new or differ from the target in a compared column.

    The default comparison is ``!=``, which a NULL on either side never satisfies;
    ``null_safe=True`` also sees NULL becoming a value and back. Columns of
    ``keep_from_target`` take the target's value where there is one.
    """
    wanted = list(dict.fromkeys([*compare, *keep_from_target]))
    existing = target.select(F.col(key), *[F.col(c).alias(f"_old_{c}") for c in wanted], F.lit(True).alias("_known"))
    joined = source.join(existing, key, "left")

    def differs(column: str):
        new, old = F.col(column), F.col(f"_old_{column}")
        return ~new.eqNullSafe(old) if null_safe else new != old

    changed = reduce(lambda a, b: a | b, [differs(c) for c in compare], F.col("_known").isNull())
    return joined.where(changed).select(
        *[F.coalesce(F.col(f"_old_{c}"), F.col(c)).alias(c) if c in keep_from_target else F.col(c) for c in source.columns]
    )


def flag_new_rows(source: DataFrame, target: DataFrame | None, keys: Sequence[str], out: str = "is_new_row") -> DataFrame:
    """Mark the rows whose key the target lacks; without a target all rows are new."""
    if target is None:
        return source.withColumn(out, F.lit(True))
    known = target.select(*keys).withColumn("_known", F.lit(True))
    return source.join(known, list(keys), "left").withColumn(out, F.col("_known").isNull()).drop("_known")


def new_rows(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    return source.join(target.select(*keys), list(keys), "left_anti")


def high_water_mark(target: DataFrame, column: str) -> dt.date | None:
    return target.agg(F.max(column)).first()[0]


def after_mark(
    source: DataFrame,
    column: str,
    mark: dt.date | None,
    guard_empty: bool = True,
    reprocess_days: int = 0,
) -> DataFrame:
    """Rows strictly after the target's high-water mark.

    The mark is a literal, so the filter passes below a daily aggregate down to the parquet
    reader; a scalar subquery would not. With an empty target (``mark`` is None) everything
    passes if ``guard_empty``, else nothing, since a comparison with NULL is never true.
    ``reprocess_days`` reopens that many days up to the mark.
    """
    if mark is None:
        return source if guard_empty else source.limit(0)
    return source.where(F.col(column) > F.date_sub(F.lit(mark).cast("date"), reprocess_days))
