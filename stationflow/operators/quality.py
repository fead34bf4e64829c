"""Declarative data tests."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from stationflow.operators.relational import not_null as not_null_rows, orphans


@dataclass(frozen=True)
class Check:
    """One assertion on a table.

    ``kind`` is not_null, accepted_range (inclusive; NULL passes), unique, unique_combination
    or relationship. ``columns`` has one name except for unique_combination.
    """

    table: str
    kind: str
    columns: tuple[str, ...]
    low: float | None = None
    high: float | None = None
    parent: str | None = None
    parent_column: str | None = None

    @property
    def label(self) -> str:
        return ",".join(self.columns)


def not_null(table: str, *columns: str) -> list[Check]:
    return [Check(table, "not_null", (c,)) for c in columns]


def unique(table: str, *columns: str) -> list[Check]:
    return [Check(table, "unique", (c,)) for c in columns]


def unique_combination(table: str, *columns: str) -> list[Check]:
    return [Check(table, "unique_combination", columns)]


def accepted_range(table: str, column: str, low: float, high: float) -> list[Check]:
    return [Check(table, "accepted_range", (column,), low=low, high=high)]


def relationship(table: str, column: str, parent: str, parent_column: str) -> list[Check]:
    return [Check(table, "relationship", (column,), parent=parent, parent_column=parent_column)]


def violates(check: Check) -> str:
    """Row-level failure condition of a not_null or accepted_range check, never NULL."""
    column = check.columns[0]
    if check.kind == "not_null":
        return f"`{column}` is null"
    if check.kind == "accepted_range":
        return f"coalesce(`{column}` < {check.low} or `{column}` > {check.high}, false)"
    raise ValueError(f"{check.kind} is not a row-level check")


def _report(counts: DataFrame, failures: Mapping[Check, str]) -> DataFrame:
    """One report row per check from a single row of counts."""
    rows = [
        f"named_struct('table', '{c.table}', 'test', '{c.kind}', 'column', '{c.label}', 'failures', cast({n} as bigint))"
        for c, n in failures.items()
    ]
    return counts.selectExpr(f"inline(array({', '.join(rows)}))")


def row_level_report(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All row-level checks of one table in a single pass over the columns they name."""
    counts = df.agg(*[F.expr(f"count_if({violates(c)}) as _{i}") for i, c in enumerate(checks)])
    return _report(counts, {c: f"_{i}" for i, c in enumerate(checks)})


def repeated(df: DataFrame, columns: Sequence[str], skip_null: bool) -> DataFrame:
    """Value combinations that occur more than once, with their row counts."""
    rows = not_null_rows(df, columns) if skip_null else df
    return rows.groupBy(*columns).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


def check_report(tables: Mapping[str, DataFrame], check: Check) -> DataFrame:
    """The report row of a check that needs a grouping or a join."""
    df = tables[check.table]
    if check.kind == "relationship":
        failures = orphans(df, tables[check.parent], check.columns[0], check.parent_column)
        counted = failures.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n"))
    else:
        counted = repeated(df, check.columns, skip_null=check.kind == "unique").agg(F.count("*").alias("n"))
    return _report(counted, {check: "n"})


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """``(table, test, column, failures)`` for every check.

    Failures are rows, except that unique and unique_combination count repeated values.
    """
    reports = []
    for table in dict.fromkeys(c.table for c in checks):
        own = [c for c in checks if c.table == table]
        row_level = [c for c in own if c.kind in ("not_null", "accepted_range")]
        if row_level:
            reports.append(row_level_report(tables[table], row_level))
        reports += [check_report(tables, c) for c in own if c not in row_level]
    while len(reports) > 1:  # in pairs, so that no plan is analysed more than a few times
        reports = [a.unionByName(b) for a, b in zip(reports[::2], reports[1::2])] + reports[len(reports) // 2 * 2 :]
    return reports[0]


def failing_rows(df: DataFrame, checks: Sequence[Check], out: str = "failed", tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Rows that break a check, with the names of the checks they break.

    Row-level checks are conditions on the row. A repeated value or combination marks all rows that
    hold it, an orphan all rows of the key: both are found as one row per value (counted first, so a
    hot value is one row) and joined back. ``tables`` has the parents of relationship checks.
    """
    name = lambda c: f"{c.kind}:{c.label}"
    marks = []
    for i, check in enumerate(checks):
        if check.kind in ("not_null", "accepted_range"):
            marks.append(F.when(F.expr(violates(check)), F.lit(name(check))))
            continue
        if check.kind == "relationship":
            bad = orphans(df, tables[check.parent], check.columns[0], check.parent_column).select(F.col("key").alias(f"_{i}_0"))
        else:
            bad = repeated(df, check.columns, check.kind == "unique").select(*[F.col(c).alias(f"_{i}_{j}") for j, c in enumerate(check.columns)])
        bad = bad.withColumn(f"_{i}", F.lit(True))
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{i}_{j}")) for j, c in enumerate(check.columns)])
        df = df.join(bad, same, "left").drop(*[f"_{i}_{j}" for j in range(len(check.columns))])
        marks.append(F.when(F.col(f"_{i}"), F.lit(name(check))))
    marked = df.withColumn(out, F.array_compact(F.array(*marks))).drop(*[f"_{i}" for i in range(len(checks))])
    if all(c.kind in ("not_null", "accepted_range") for c in checks):
        return marked.where(" or ".join(violates(c) for c in checks))
    return marked.where(F.size(out) > 0)
