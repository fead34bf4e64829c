"""The 74 data tests over the tables built from the driver's data."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stationflow.operators import quality
from stationflow.operators.quality import Check
from stationflow.plans.contracts import ALL_CHECKS
from stationflow.workload.adapter import Data, sql
from stationflow.workload.registry import query


# The SQL tables behind the names; audit columns, which SQL leaves out, are constants.
_SQL_TABLES = {
    "raw_observations": "raw",
    "raw_provinces": "raw_provinces",
    "raw_districts": "raw_districts",
    "stg_provinces": "(select *, 1 as loaded_at from provinces)",
    "stg_districts": "districts",
    "stg_weather": "staged",
    "dim_districts": "districts",
    "dim_provinces": "provinces",
    "fct_current_weather_province": "current_rows",
    "fct_weather_province": "(select *, predicted_condition as condition, 1 as updated_at, true as is_new_row from classified)",
    "fct_weather_region": "(select *, 1 as updated_at from regional)",
    "forecast_7days": "forecast",
}
_SQL_CTES = ["raw", "raw_provinces", "raw_districts", "districts", "staged", "provinces", "current_rows", "classified", "regional", "forecast"]


def _failures_sql(check: Check) -> str:
    table, column = _SQL_TABLES[check.table], check.columns[0]
    if check.kind == "not_null":
        return f"select count(*) from {table} where {column} is null"
    if check.kind == "accepted_range":
        return f"select count(*) from {table} where {column} < {check.low} or {column} > {check.high}"
    if check.kind == "relationship":
        parent = _SQL_TABLES[check.parent]
        return (
            f"select count(*) from {table} c left join (select distinct {check.parent_column} as k from {parent}) p"
            f" on c.{column} = p.k where c.{column} is not null and p.k is null"
        )
    keys = ", ".join(check.columns)
    present = f" where {column} is not null" if check.kind == "unique" else ""
    return f"select count(*) from (select {keys} from {table}{present} group by {keys} having count(*) > 1)"


def _report_sql(checks: list[Check]) -> str:
    parts = [
        f"select '{c.table}' as \"table\", '{c.kind}' as test, '{c.label}' as \"column\", ({_failures_sql(c)}) as failures"
        for c in checks
    ]
    return sql(" union all ".join(parts), *_SQL_CTES)


def _report(name: str, checks: list[Check]) -> None:
    @query(name, _report_sql(checks))
    def run(d: Data) -> DataFrame:
        marts = sum(c.table.startswith(("fct_", "forecast")) for c in checks)
        return quality.run_checks((d.stored() if marts > 1 else d).tables, checks)


for _kind in ("not_null", "unique", "relationship", "accepted_range", "unique_combination"):
    _report(f"dq_{_kind}", [c for c in ALL_CHECKS if c.kind == _kind])
_report("dq_report", ALL_CHECKS)

_ROW_CHECKS = [c for c in ALL_CHECKS if c.table == "stg_weather" and c.kind in ("not_null", "accepted_range")]


def _failed_names_sql() -> str:
    names = []
    for c in _ROW_CHECKS:
        broken = f"{c.columns[0]} is null" if c.kind == "not_null" else f"{c.columns[0]} < {c.low} or {c.columns[0]} > {c.high}"
        names.append(f"case when {broken} then '{c.kind}:{c.label}' end")
    return f"concat_ws(';', {', '.join(names)})"


@query(
    "dq_failing_rows",
    sql(
        f"""select * from (select province_name, weather_updated_at, temperature_celsius, {_failed_names_sql()} as failed
        from staged) where failed <> ''""",
        "staged",
    ),
)
def failing(d: Data) -> DataFrame:
    rows = quality.failing_rows(d.staged, _ROW_CHECKS)
    return rows.select("province_name", "weather_updated_at", "temperature_celsius", F.array_join("failed", ";").alias("failed"))


_KEY_CHECKS = [
    *quality.unique("lineitem", "l_orderkey"),
    *quality.unique_combination("lineitem", "l_suppkey", "l_shipdate"),
    *quality.relationship("lineitem", "l_suppkey", "known", "s_suppkey"),
    *quality.not_null("lineitem", "l_orderkey"),
    *quality.accepted_range("lineitem", "l_quantity", 5, 45),
]


@query(
    "dq_failing_rows_by_key",
    """select l_orderkey, l_linenumber, l_suppkey, failed from (select *, concat_ws(';',
    case when count(*) over (partition by l_orderkey) > 1 then 'unique:l_orderkey' end,
    case when count(*) over (partition by l_suppkey, l_shipdate) > 1 then 'unique_combination:l_suppkey,l_shipdate' end,
    case when l_suppkey not in (select s_suppkey from supplier where s_suppkey % 3 <> 0) then 'relationship:l_suppkey' end,
    case when l_quantity < 5 or l_quantity > 45 then 'accepted_range:l_quantity' end) as failed from lineitem) where failed <> ''""",
)
def failing_by_key(d: Data) -> DataFrame:
    """Rows that break a uniqueness, a combination, a relationship, beside row-level checks."""
    known = d.table("supplier").where(F.col("s_suppkey") % 3 != 0)
    rows = quality.failing_rows(d.table("lineitem"), _KEY_CHECKS, tables={"known": known})
    return rows.select("l_orderkey", "l_linenumber", "l_suppkey", F.array_join("failed", ";").alias("failed"))


_LINE_CHECKS = [
    *quality.not_null("lineitem", "l_orderkey", "l_suppkey", "l_shipdate"),
    *quality.accepted_range("lineitem", "l_quantity", 5, 45),
    *quality.accepted_range("lineitem", "l_discount", 0, 0.05),
    *quality.relationship("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    *quality.relationship("lineitem", "l_partkey", "part", "p_partkey"),
    *quality.unique("lineitem", "l_orderkey"),
    *quality.unique_combination("lineitem", "l_orderkey", "l_linenumber"),
]


@query(
    "dq_report_shipments",
    """select 'lineitem' as "table", test, "column", failures from (
    select 'not_null' as test, 'l_orderkey' as "column", count(*) filter (where l_orderkey is null) as failures from lineitem
    union all select 'not_null', 'l_suppkey', count(*) filter (where l_suppkey is null) from lineitem
    union all select 'not_null', 'l_shipdate', count(*) filter (where l_shipdate is null) from lineitem
    union all select 'accepted_range', 'l_quantity', count(*) filter (where l_quantity < 5 or l_quantity > 45) from lineitem
    union all select 'accepted_range', 'l_discount', count(*) filter (where l_discount < 0 or l_discount > 0.05e0) from lineitem
    union all select 'relationship', 'l_suppkey', count(*) from lineitem where l_suppkey not in (select s_suppkey from supplier)
    union all select 'relationship', 'l_partkey', count(*) from lineitem where l_partkey not in (select p_partkey from part)
    union all select 'unique', 'l_orderkey', count(*) from (select 1 from lineitem group by l_orderkey having count(*) > 1)
    union all select 'unique_combination', 'l_orderkey,l_linenumber', count(*) from
    (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1))""",
)
def shipments(d: Data) -> DataFrame:
    return quality.run_checks({t: d.table(t) for t in ("lineitem", "supplier", "part")}, _LINE_CHECKS)
