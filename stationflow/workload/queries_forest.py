"""The multi-output forest and the rolling-origin backtest, with SQL that fits and applies the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stationflow.operators import forest as vf, learning as ml
from stationflow.operators.windows import LAG_FAMILIES
from stationflow.workload.adapter import Data, rounded, sql
from stationflow.workload.queries_learning import _labelled
from stationflow.workload.registry import query

TREES, DEPTH, BINS, MIN_ROWS, SHARE, SEED = 3, 3, 64, 5, 0.5, 42


def fitted(d: Data) -> vf.VectorForecaster:
    return vf.fit_multi_output(ml.training_table(_labelled(d)), d.provinces, TREES, DEPTH, SEED, bins=BINS, min_rows=MIN_ROWS, share=SHARE)


# The same in SQL. Lists of features and outputs are in the model's order.

_FIRST = {family: start for family, _, start in LAG_FAMILIES}
_LISTS = ", ".join(
    f"list_reverse(list_filter(list({m}::double) over w, lambda x: x is not null)) as a_{stem}" for stem, _, m, _ in ml.FAMILIES
)
_LAGGED = [f"a_{stem}[{_FIRST[family] + i}]" for stem, family, _, _ in ml.FAMILIES for i in (1, 2, 3)]
_MEASURE = {out: m for _, _, m, out in ml.FAMILIES}
_TARGETS = ", ".join(f"{_MEASURE[out]}::double" for out in ml.OUTPUTS)
_CODES = "(select region, cast(dense_rank() over (order by region) - 1 as double) as code from (select distinct region from provinces))"
TRAINING = f"""reported as (
  select province_name, cast(weather_updated_at as date) as weather_date, weather_condition as condition from staged
  qualify row_number() over (partition by province_name, cast(weather_updated_at as date) order by weather_updated_at desc, weather_condition) = 1),
windowed as (
  select d.*, condition, {_LISTS} from daily d join reported r using (province_name, weather_date)
  window w as (partition by province_id order by weather_date rows between 4 preceding and 1 preceding)),
lagged as (
  select province_id, region, weather_date, condition, code, [code, {', '.join(_LAGGED)}] as feats, [{_TARGETS}] as y
  from windowed join {_CODES} using (region)),
training as (
  select *, province_id || '|' || weather_date as key from lagged
  where condition is not null and len(list_filter(feats || y, lambda x: x is null)) = 0)"""


def _drawn(*parts: str) -> str:
    return f"(('0x' || substr(md5({' || chr(58) || '.join(parts)}), 1, 8))::bigint::double / 4294967296.0)"


def _unit(x: str) -> str:
    return f"floor({x} * 1e6 + 0.5)"


def forest_sql(p: str, source: str, features: int, outputs: str | int, seed: int) -> str:
    """CTEs ``{p}_splits`` and ``{p}_totals`` of a forest on ``source(key, feats, y)``. ``outputs`` is a
    number, or the number as SQL where the data say how many there are: all sums are lists then."""
    times = " + ".join(f"({_drawn(repr(str(seed)), repr('row'), 'tree', 'key')} >= {c!r}::double)::int" for c in vf.poisson_steps())
    parts = [
        f"""{p}_range as (select list(lo order by f) as lo, list(hi order by f) as hi from (select f, min({_unit('feats[f]')}) as lo,
        max({_unit('feats[f]')}) as hi from {source}, range(1, {features + 1}) r(f) group by f))""",
        f"""{p}_fixed as (select key, {_codes_sql(features)} as codes,
        list_transform(y, lambda v: floor(v * 1024 + 0.5)::bigint) as y from {source}, {p}_range)""",
        f"""{p}_weight as (select k, case when count(*) * sum(y[k] * y[k]) - sum(y[k]) * sum(y[k]) = 0 then 0 else
        (count(*) * count(*))::double / (count(*) * sum(y[k] * y[k]) - sum(y[k]) * sum(y[k]))::double end as weight
        from {p}_fixed, range(1, {outputs} + 1) r(k) group by k)""",
        f"{p}_rows as (select *, {times} as w from {p}_fixed, range({TREES}) r(tree))",
        f"{p}_n0 as (select *, 1 as node from {p}_rows where w > 0)",
    ]
    for level in range(DEPTH + 1):
        if level:
            parts.append(
                f"""{p}_n{level} as (select r.* replace (case when s.node is null then r.node else 2 * r.node + (codes[s.feature + 1] > s.bin)::int end as node)
                from {p}_n{level - 1} r left join {p}_s{level - 1} s on s.tree = r.tree and s.node = r.node)"""
            )
        parts.append(f"{p}_t{level} as (select tree, node, k, sum(w) as n, sum(w * y[k]) as s from {p}_n{level}, range(1, {outputs} + 1) r(k) where node >= {1 << level} group by all)")
        if level == DEPTH:
            break
        parts += [
            f"""{p}_h{level} as (select tree, node, f as feature, codes[f + 1] as bin, k, sum(w) as n, sum(w * y[k]) as s
            from {p}_n{level}, range({features}) q(f), range(1, {outputs} + 1) r(k) where node >= {1 << level} group by all)""",
            f"""{p}_c{level} as (select tree, node, feature, bin, k, sum(n) over l as ln, sum(s) over l as ls, sum(n) over t - sum(n) over l as rn,
            sum(s) over t - sum(s) over l as rs, sum(n) over t as tn, sum(s) over t as ts from {p}_h{level}
            window t as (partition by tree, node, feature, k), l as (partition by tree, node, feature, k order by bin rows unbounded preceding))""",
            f"""{p}_g{level} as (select tree, node, feature, bin,
            list_reduce(list(weight * (ls::double * ls::double / ln + rs::double * rs::double / rn) order by k), lambda a, b: a + b) as gain,
            list_reduce(list(weight * (ts::double * ts::double / tn) order by k), lambda a, b: a + b) as base
            from {p}_c{level} join {p}_weight using (k) where ln >= {MIN_ROWS} and rn >= {MIN_ROWS}
            and {_drawn(repr(str(seed)), repr('split'), 'tree', 'node', 'feature')} < {SHARE} group by all)""",
            f"""{p}_s{level} as (select tree, node, feature, bin from {p}_g{level} where gain > base * (1 + 1e-9)
            qualify row_number() over (partition by tree, node order by gain desc, feature, bin) = 1)""",
        ]
    parts.append(f"{p}_splits as (" + " union all ".join(f"select * from {p}_s{i}" for i in range(DEPTH)) + ")")
    parts.append(f"{p}_totals as (" + " union all ".join(f"select * from {p}_t{i}" for i in range(DEPTH + 1)) + ")")
    return ",\n".join(parts)


def _codes_sql(features: int) -> str:
    share = f"case when hi[i] > lo[i] then ({_unit('feats[i]')} - lo[i]) / (hi[i] - lo[i]) else 0e0 end"
    return f"list_transform(range(1, {features + 1}), lambda i: greatest(0, least({BINS - 1}, floor({share} * {BINS})))::int)"


def predict_sql(p: str, out: str, source: str, features: int) -> str:
    """CTEs up to ``{out}(id, k, value)``: the mean leaf of each output for ``source(id, feats)``."""
    parts = [f"{out}_0 as (select id, tree, 1 as node, {_codes_sql(features)} as codes from {source}, {p}_range, range({TREES}) r(tree))"]
    for level in range(1, DEPTH + 1):
        parts.append(
            f"""{out}_{level} as (select r.* replace (case when s.node is null then r.node else 2 * r.node + (codes[s.feature + 1] > s.bin)::int end as node)
            from {out}_{level - 1} r left join {p}_splits s on s.tree = r.tree and s.node = r.node)"""
        )
    parts.append(f"{out} as (select id, k, sum(s::double / n / 1024) / {TREES} as value from {out}_{DEPTH} join {p}_totals using (tree, node) group by id, k)")
    return ",\n".join(parts)


_REGRESSION = forest_sql("reg", "training", len(ml.FEATURES), len(ml.OUTPUTS), SEED)
_LABELS = """labels as (select list(condition order by condition) as labels from (select distinct condition from training)),
hits as (select key, y || [code] as feats, list_transform(labels, lambda l: (l = condition)::int) as y from training, labels)"""
_CLASSES = forest_sql("cls", "hits", len(ml.OUTPUTS) + 1, "(select len(labels) from labels)", SEED + 1)


def _days(horizon: int = 7) -> str:
    """CTEs ``day1`` to ``day7``: the forecast outputs, condition and next features of each station."""
    lags = {out: 1 + 3 * i for i, (_, _, _, out) in enumerate(ml.FAMILIES)}  # place before the family's first lag
    shifted = ["feats[1]"]
    for out, at in lags.items():
        shifted += [f"y[{ml.OUTPUTS.index(out) + 1}]", f"feats[{at + 1}]", f"feats[{at + 2}]"]
    served = ", ".join(f"{family}{i}" for _, family, _, _ in ml.FAMILIES for i in (1, 2, 3))
    parts = [f"day0 as (select province_id as id, region, weather_date, [code, {served}] as feats, len(list_filter([{served}], lambda x: x is null)) = 0 as whole from lags join {_CODES} using (region))"]
    parts.append("next0 as (select id, feats from day0 where whole)")
    for day in range(1, horizon + 1):
        parts.append(predict_sql("reg", f"out{day}", f"next{day - 1}", len(ml.FEATURES)))
        parts.append(f"got{day} as (select o.id, list(value order by k) as y, any_value(feats) as feats from out{day} o join next{day - 1} n on n.id = o.id group by o.id)")
        parts.append(f"given{day} as (select id, y || [feats[1]] as feats from got{day})")
        parts.append(predict_sql("cls", f"shares{day}", f"given{day}", len(ml.OUTPUTS) + 1))
        parts.append(f"label{day} as (select id, labels[(list(k order by value desc, k))[1]] as predicted_condition from shares{day}, labels group by id, labels)")
        parts.append(f"next{day} as (select id, [{', '.join(shifted)}] as feats from got{day})")
    return ",\n".join(parts)


def _with(extra: str, body: str, *tables: str) -> str:
    """``body`` after the CTEs of the tables and more CTEs."""
    return sql("\x00", *tables).replace(" \x00", f", {extra} {body}")


_SUMS = ", ".join(f"cast(max(s) filter (where k = {k + 1}) as bigint) as {out}" for k, out in enumerate(ml.OUTPUTS))


@query(
    "forest_nodes",
    _with(
        f"{TRAINING},\n{_REGRESSION}",
        f"""select cast(tree as int) as tree, cast(node as int) as node, cast(any_value(feature) as int) as feature, cast(any_value(bin) as int) as bin,
        cast(max(n) as bigint) as n, {_SUMS} from reg_totals left join reg_splits using (tree, node) group by tree, node""",
        "staged", "daily", "provinces",
    ),
)
def forest_nodes(d: Data) -> DataFrame:
    """Every node of the multi-output forest: its split, its rows, the sums of all outputs in 1024ths."""
    forest = fitted(d).regressor
    rows = [(*at, *forest.splits.get(at, (None, None)), n, *sums) for at, (n, sums) in sorted(forest.totals.items())]
    return d.spark.createDataFrame(rows, "tree int, node int, feature int, bin int, n long, " + ", ".join(f"{c} long" for c in ml.OUTPUTS))


_ALL_DAYS = " union all ".join(
    f"""select province_id, region, cast(weather_date + {day} as date) as predicted_date, predicted_condition,
    {', '.join(f'round(y[{k + 1}], 9) as {out}' for k, out in enumerate(ml.OUTPUTS))}
    from got{day} g join label{day} l on g.id = l.id join (select id as province_id, region, weather_date, id from day0) s on s.id = g.id"""
    for day in range(1, 8)
)


@query("forecast_forest", _with(f"{TRAINING},\n{_REGRESSION},\n{_LABELS},\n{_CLASSES},\n{_days()}", _ALL_DAYS, "staged", "daily", "provinces", "lags"))
def forecast_forest(d: Data) -> DataFrame:
    """Seven days of all outputs and the condition by the multi-output forest."""
    return rounded(fitted(d).forecast(ml.complete(ml.feature_table(d.lags))))


# The forest on days it has not seen, one day ahead.

CUT = "2024-01-24"
_EVALUATED = _with(
    f"""{TRAINING},
past as (select * from training where weather_date <= date '{CUT}'),
held as (select key as id, feats, y, condition, code from training where weather_date > date '{CUT}'),
{_REGRESSION.replace("from training", "from past")},
{_LABELS.replace("from training", "from past")},
{_CLASSES},
{predict_sql("reg", "outs", "held", len(ml.FEATURES))},
got as (select id, list(value order by k) as got from outs group by id),
given as (select id, got || [code] as feats from got join held using (id)),
{predict_sql("cls", "shares", "given", len(ml.OUTPUTS) + 1)},
named as (select id, labels[(list(k order by value desc, k))[1]] as label from shares, labels group by id, labels),
scored as (select got, y, label, condition from held join got using (id) join named using (id))""",
    " union all ".join(
        f"select '{out}' as target, unnest(['rmse', 'mae', 'r2']) as metric, round(unnest([sqrt(avg((got[{k}] - y[{k}]) ** 2)), avg(abs(got[{k}] - y[{k}])),"
        f" 1 - sum((got[{k}] - y[{k}]) ** 2) / nullif(var_pop(y[{k}]) * count(y[{k}]), 0)]), 9) as value from scored"
        for k, out in enumerate(ml.OUTPUTS, 1)
    )
    + " union all select 'condition', 'accuracy', round(avg((label = condition)::int), 9) from scored",
    "staged", "daily", "provinces",
)


@query("evaluate_forest", _EVALUATED)
def evaluate_forest(d: Data) -> DataFrame:
    """The multi-output forest, fitted on the days up to a cut, against the days after it."""
    table, cut = ml.training_table(_labelled(d)), F.lit(CUT).cast("date")
    model = vf.fit_multi_output(table.where(F.col("weather_date") <= cut), d.provinces, TREES, DEPTH, SEED, bins=BINS, min_rows=MIN_ROWS, share=SHARE)
    return rounded(ml.evaluate_forecaster(model, table.where(F.col("weather_date") > cut)))


# Every station-day as an origin, seven days ahead, by the linear step.

_CONDITION = """case when {precip} > 100 then 'Heavy rain' when {precip} > 0 then 'Light rain' when {humidity} > 55 then 'Cloudy'
when {temp} > 25 then 'Sunny' else 'Partly cloudy' end"""


def _backtest_sql() -> str:
    lists = _LISTS.replace("a_", "o_")
    lagged = [f"o_{stem}[{_FIRST[family] + i}] as {stem}{i}" for stem, family, _, _ in ml.FAMILIES for i in (1, 2, 3)]
    known = " and ".join(f"{stem}{i} is not null" for stem, _, _, _ in ml.FAMILIES for i in (1, 2, 3))
    parts = [
        f"""spans as (select *, {lists} from classified window w as (partition by province_id order by weather_date rows between 3 preceding and current row))""",
        f"step0 as (select * from (select province_id, weather_date as origin, {', '.join(lagged)} from spans) where {known})",
    ]
    for h in range(1, 8):
        moved = ", ".join(f"({s}1 * 4e0 + {s}2 * 2e0 + {s}3 * 1e0) / 7e0 as {s}1, {s}1 as {s}2, {s}2 as {s}3" for s, _, _, _ in ml.FAMILIES)
        parts.append(f"step{h} as (select province_id, origin, {moved} from step{h - 1})")
    stems = {stem: (m, out) for stem, _, m, out in ml.FAMILIES}
    condition = _CONDITION.format(precip="precip_lag1", humidity="avghumidity_lag1", temp="avgt_c_lag1")
    made = ", ".join(f"{stem}1 as {out}" for stem, (_, out) in stems.items())
    parts.append("made as (" + " union all ".join(f"select province_id, origin, {h} as horizon, {made}, {condition} as label from step{h}" for h in range(1, 8)) + ")")
    parts.append("""paired as (select m.*, t.predicted_condition as true_label, o.predicted_condition as naive_label, """
        + ", ".join(f"t.{m}::double as t_{out}, o.{m}::double as o_{out}" for m, out in stems.values())
        + """ from made m join classified t on t.province_id = m.province_id and t.weather_date = m.origin + m.horizon
        join classified o on o.province_id = m.province_id and o.weather_date = m.origin)""")  # fmt: skip
    figures = [
        f"select '{out}' as target, cast(horizon as int) as horizon, count(*) as pairs, round(sqrt(avg(({out} - t_{out}) ** 2)), 9) as rmse, round(avg(abs({out} - t_{out})), 9) as mae,"
        f" round(sqrt(avg((o_{out} - t_{out}) ** 2)), 9) as naive_rmse, round(avg(abs(o_{out} - t_{out})), 9) as naive_mae from paired group by horizon"
        for _, out in stems.values()
    ]
    miss, naive = "avg((label <> true_label)::int)", "avg((naive_label <> true_label)::int)"
    figures.append(
        f"select 'condition', cast(horizon as int), count(*), round(sqrt({miss}), 9), round({miss}, 9), round(sqrt({naive}), 9), round({naive}, 9) from paired group by horizon"
    )
    return _with(", ".join(parts), " union all ".join(figures), "classified")


@query("backtest", _backtest_sql())
def backtest(d: Data) -> DataFrame:
    """Seven days ahead from every station-day, beside the forecast that all stays as it was."""
    regions = ml.label_encoder(d.provinces, "region", "region_enc")
    origins = regions.transform(ml.origin_features(d.classified))
    return rounded(ml.backtest(origins, ml.weighted_mean_step(), d.classified))
