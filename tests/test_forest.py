"""The multi-output forest against brute force, and the rolling-origin backtest by hand."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from stationflow.operators import forest as vf, learning as ml

FEATURES, OUTPUTS = ["a", "b", "c"], ["x", "y"]


def rows_of(n=120, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, b = rng.choice([0.0, 1.0, 2.5]), rng.uniform(-3, 3)
        out.append((i, a, b, 7.0, (a > 1) * 10 + b + rng.uniform(0, 1), 100.0 * (b > 0.5)))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, a double, b double, c double, x double, y double")


def fit(df, **options):
    options = {"trees": 1, "depth": 2, "bins": 16, "min_rows": 4, "share": 1.0, **options}
    return vf.fit_vector_forest(df, FEATURES, [F.col(c) for c in OUTPUTS], F.col("id"), **options)


def times(spark, ids, tree, seed=42):
    u = F.expr(vf.drawn(f"'{seed}'", "'row'", f"'{tree}'", "cast(id as string)"))
    steps = vf.poisson_steps()
    return {r.id: sum(r.u >= c for c in steps) for r in spark.createDataFrame([(i,) for i in ids], "id long").withColumn("u", u).collect()}


def brute(rows, weight, bins, min_rows):
    """Every split of the weighted rows, by the variance of both outputs it takes away."""
    fixed = [[math.floor(r[4 + k] * vf.OUTPUT_UNITS + 0.5) for k in range(2)] for r in rows]
    spread = []
    for k in range(2):
        mean = sum(f[k] for f in fixed) / len(rows)
        spread.append(sum((f[k] - mean) ** 2 for f in fixed) / len(rows))
    lows, highs = [min(r[1 + j] for r in rows) for j in range(3)], [max(r[1 + j] for r in rows) for j in range(3)]
    code = lambda r, j: min(bins - 1, int((r[1 + j] - lows[j]) / (highs[j] - lows[j]) * bins)) if highs[j] > lows[j] else 0

    def error(at):
        total = 0.0
        for k in range(2):
            n = sum(weight[rows[i][0]] for i in at)
            mean = sum(weight[rows[i][0]] * fixed[i][k] for i in at) / n
            total += sum(weight[rows[i][0]] * (fixed[i][k] - mean) ** 2 for i in at) / spread[k]
        return total

    def split(at):
        best = None
        for j in range(3):
            for b in range(bins - 1):
                left, right = [i for i in at if code(rows[i], j) <= b], [i for i in at if code(rows[i], j) > b]
                if min(sum(weight[rows[i][0]] for i in side) for side in (left, right)) < min_rows:
                    continue
                loss = error(left) + error(right)
                if best is None or loss < best[0] - 1e-7:
                    best = (loss, j, b, left, right)
        return best

    return split, error


def test_splits_equal_brute_force(spark):
    rows = rows_of()
    forest = fit(frame(spark, rows))
    weight = times(spark, [r[0] for r in rows], 0)
    at = [i for i, r in enumerate(rows) if weight[r[0]]]
    split, _ = brute(rows, weight, 16, 4)
    nodes = {1: at}
    for node in range(1, 4):
        loss, feature, last, left, right = split(nodes[node])
        assert forest.splits[0, node] == (feature, last)
        nodes[2 * node], nodes[2 * node + 1] = left, right
    for node, inside in nodes.items():
        n, sums = forest.totals[0, node]
        assert n == sum(weight[rows[i][0]] for i in inside)
        assert sums == [sum(weight[rows[i][0]] * math.floor(rows[i][4 + k] * 1024 + 0.5) for i in inside) for k in range(2)]


def test_prediction_is_the_mean_of_the_leaves(spark):
    rows = rows_of()
    df = frame(spark, rows)
    forest = fit(df, trees=3, depth=3, share=0.6)
    assert fit(df.repartition(7), trees=3, depth=3, share=0.6) == forest  # whatever the order of rows

    def leaf(row, tree):
        node = 1
        while (tree, node) in forest.splits:
            j, last = forest.splits[tree, node]
            share = (math.floor(row[1 + j] * 1e6 + 0.5) - forest.low[j]) / (forest.high[j] - forest.low[j]) if forest.high[j] > forest.low[j] else 0
            node = 2 * node + (max(0, min(forest.bins - 1, math.floor(share * forest.bins))) > last)
        n, sums = forest.totals[tree, node]
        return [s / n / 1024 for s in sums]

    outside = [(1000, -50.0, 99.0, 0.0, 0.0, 0.0), (1001, 99.0, -99.0, 8.0, 0.0, 0.0)]
    predicted = forest.predict(frame(spark, rows + outside), "p")
    plan = predicted._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    for row, found in zip(rows + outside, predicted.orderBy("id").collect()):
        expected = [sum(v) / 3 for v in zip(*[leaf(row, t) for t in range(3)])]
        assert found["p"] == pytest.approx(expected, abs=1e-12)


def test_what_cannot_be_split_is_a_leaf(spark):
    rows = [(i, 1.0, 2.0, 3.0, 5.0, 6.0) for i in range(30)]
    forest = fit(frame(spark, rows))
    assert forest.splits == {} and list(forest.totals) == [(0, 1)]
    assert forest.predict(frame(spark, rows[:1]), "p").first()["p"] == [5.0, 6.0]
    with pytest.raises(ValueError):
        fit(frame(spark, []))


DAY = dt.date(2024, 1, 10)


def daily(spark, values, skip=()):
    rows = [(1, "N", DAY + dt.timedelta(days=i), float(v), "wet" if v > 5 else "dry") for i, v in enumerate(values) if i not in skip]
    df = spark.createDataFrame(rows, "province_id int, region string, weather_date date, v double, predicted_condition string")
    return df.withColumns({m: F.col("v") for _, _, m, _ in ml.FAMILIES})


def test_backtest_by_hand(spark):
    """A step that repeats lag 1 of each family, on a station with one missing day."""
    values, skip = [3, 4, 6, 8, 1, 9, 9, 2], (6,)

    def step(df):
        for stem, _, _, out in ml.FAMILIES:
            df = df.withColumn(out, F.col(f"{stem}_1"))
        return df.withColumn("predicted_condition", F.lit("wet"))

    days = daily(spark, values, skip)
    origins = ml.origin_features(days, aligned=True).withColumn("region_enc", F.lit(0.0))
    found = {(r.target, r.horizon): r for r in ml.backtest(origins, step, days, horizon=3).collect()}
    there = {i: float(v) for i, v in enumerate(values) if i not in skip}
    starts = sorted(there)[2:]  # three rows are needed
    for h in (1, 2, 3):
        pairs = [(o, o + h) for o in starts if o + h in there]
        row = found["maxtemp_c", h]
        errors = [there[o] - there[t] for o, t in pairs]  # the newest value stays, as the naive forecast says
        assert row.pairs == len(pairs) and row.mae == row.naive_mae == sum(map(abs, errors)) / len(errors)
        assert row.rmse == pytest.approx(math.sqrt(sum(e * e for e in errors) / len(errors)))
        assert found["condition", h].mae == sum(there[t] <= 5 for _, t in pairs) / len(pairs)


def test_origins_have_what_is_served_on_them(spark):
    from stationflow.operators.windows import lag_features

    days, places = daily(spark, range(9)), spark.createDataFrame([(1, "N")], "province_id int, region string")
    found = {r.weather_date: tuple(r[c] for c in ml.LAG_COLUMNS) for r in ml.origin_features(days).collect()}
    for i in range(3, 9):
        origin = DAY + dt.timedelta(days=i)
        served = ml.feature_table(lag_features(days.where(F.col("weather_date") <= F.lit(origin)), places, origin)).select(*ml.LAG_COLUMNS).first()
        assert (origin in found) == (None not in tuple(served)) and (origin not in found or found[origin] == tuple(served))


def test_forecaster_learns_from_the_history(spark):
    rng = random.Random(3)
    values = [20 + 5 * math.sin(i / 3) + rng.uniform(-0.1, 0.1) for i in range(80)]
    table = ml.training_table(daily(spark, values), aligned=True)
    model = vf.fit_multi_output(table, trees=5, depth=4)
    rows = {(r.target, r.metric): r.value for r in ml.evaluate_forecaster(model, table).collect()}
    assert rows["avgtemp_c", "r2"] > 0.8 and rows["condition", "accuracy"] == 1.0
    assert model.labels == ["wet"]
