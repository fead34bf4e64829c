"""Condition labels, encoders, the recursive forecast and its models."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import IndexToString, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window, functions as F

from stationflow.operators.relational import not_null
from stationflow.operators.windows import LAG_FAMILIES
from stationflow.session import durable

# Fixed values, in feature order: feature stem, lag column stem, daily measure, predicted column.
FAMILIES = [
    ("avgt_c_lag", "avgtemp", "avg_temperature", "avgtemp_c"),
    ("avghumidity_lag", "humidity", "avg_humidity", "avghumidity"),
    ("rain_chance_lag", "rainchance", "chance_rain", "daily_chance_of_rain"),
    ("maxtemp_lag", "maxtemp", "max_temperature", "maxtemp_c"),
    ("mintemp_lag", "mintemp", "min_temperature", "mintemp_c"),
    ("precip_lag", "precip", "sum_precipitation", "totalprecip_mm"),
    ("maxwind_kph_lag", "windkph", "avg_wind_kph", "maxwind_kph"),
    ("maxwind_mph_lag", "windmph", "avg_wind_mph", "maxwind_mph"),
]
LAGS = 3

# The regression outputs, in model order, which is not the feature order.
OUTPUTS = [
    "avgtemp_c",
    "maxtemp_c",
    "mintemp_c",
    "totalprecip_mm",
    "daily_chance_of_rain",
    "avghumidity",
    "maxwind_kph",
    "maxwind_mph",
]

LAG_COLUMNS = [f"{stem}_{i}" for stem, _, _, _ in FAMILIES for i in range(1, LAGS + 1)]
FEATURES = ["region_enc", *LAG_COLUMNS]

Step = Callable[[DataFrame], DataFrame]


# Condition labels


def rule_condition(frame: pd.DataFrame) -> np.ndarray:
    """A batch of daily rows to condition labels by fixed thresholds."""
    return np.select(
        [
            frame["sum_precipitation"] > 100,
            frame["sum_precipitation"] > 0,
            frame["avg_humidity"] > 55,
            frame["avg_temperature"] > 25,
        ],
        ["Heavy rain", "Light rain", "Cloudy", "Sunny"],
        default="Partly cloudy",
    )


def rule_condition_column(precipitation: Column, humidity: Column, temperature: Column) -> Column:
    """The same thresholds as a built-in expression."""
    return (
        F.when(precipitation > 100, "Heavy rain")
        .when(precipitation > 0, "Light rain")
        .when(humidity > 55, "Cloudy")
        .when(temperature > 25, "Sunny")
        .otherwise("Partly cloudy")
    )


def classify_daily(daily: DataFrame) -> DataFrame:
    condition = rule_condition_column(F.col("sum_precipitation"), F.col("avg_humidity"), F.col("avg_temperature"))
    return daily.withColumn("predicted_condition", condition)


UDF_ARGUMENTS = [
    "avg_temperature",
    "max_temperature",
    "min_temperature",
    "sum_precipitation",
    "chance_rain",
    "avg_humidity",
    "avg_wind_kph",
    "avg_wind_mph",
    "region",
]


def vectorized_condition(predict: Callable[[pd.DataFrame], Sequence[str]] = rule_condition):
    """A nine-argument column function that hands whole Arrow batches to ``predict``.

    It is deterministic, so Spark drops it from plans that do not read its column.
    """

    @F.pandas_udf("string")
    def label(
        a: pd.Series,
        b: pd.Series,
        c: pd.Series,
        d: pd.Series,
        e: pd.Series,
        f: pd.Series,
        g: pd.Series,
        h: pd.Series,
        i: pd.Series,
    ) -> pd.Series:
        frame = pd.concat([a, b, c, d, e, f, g, h, i], axis=1, keys=UDF_ARGUMENTS)
        return pd.Series(predict(frame), index=frame.index, dtype="object")

    return lambda df: label(*[df[c] for c in UDF_ARGUMENTS])


# Encoders


def label_encoder(df: DataFrame, column: str, encoded: str) -> StringIndexerModel:
    """Codes by alphabetical order; a label not seen in ``df`` is an error when used."""
    indexer = StringIndexer(inputCol=column, outputCol=encoded, stringOrderType="alphabetAsc", handleInvalid="error")
    return indexer.fit(df)


def label_decoder(model: StringIndexerModel, code: str, decoded: str) -> IndexToString:
    return IndexToString(inputCol=code, outputCol=decoded, labels=list(model.labels))


# Features


def feature_table(lags: DataFrame) -> DataFrame:
    """Lag columns under their feature names."""
    names = {f"{lag}{i}": f"{stem}_{i}" for stem, lag, _, _ in FAMILIES for i in range(1, LAGS + 1)}
    return lags.withColumnsRenamed(names)


def complete(features: DataFrame) -> DataFrame:
    """Stations with all lags, the only ones a forecast is made for."""
    return not_null(features, LAG_COLUMNS)


def skipped(features: DataFrame) -> DataFrame:
    """Stations with too short a history, named rather than forecast from missing values."""
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in LAG_COLUMNS]))
    return features.select("province_id", "region", "weather_date", missing.alias("missing")).where(F.size("missing") > 0)


def assemble_features(df: DataFrame, out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol=out, handleInvalid="error").transform(df)


def training_table(daily: DataFrame, key: str = "province_id", day: str = "weather_date", aligned: bool = False) -> DataFrame:
    """Daily rows with their own values as targets, and as features what ``lag_features`` serves on
    the day before: of the four rows before, newest first and without NULLs, the average temperature
    from the first on and the other measures from the second on (all from the first, if ``aligned``).
    """
    window = Window.partitionBy(key).orderBy(day).rowsBetween(-4, -1)
    first = {family: 0 if aligned else start for family, _, start in LAG_FAMILIES}
    arrays = [F.reverse(F.collect_list(F.col(measure).cast("double")).over(window)).alias(f"_{stem}") for stem, _, measure, _ in FAMILIES]
    targets = [F.col(measure).cast("double").alias(out) for _, _, measure, out in FAMILIES]
    rows = daily.select(key, "region", day, F.col("predicted_condition").alias("condition"), *targets, *arrays)
    lagged = [
        F.get(f"_{stem}", F.lit(first[family] + i - 1)).alias(f"{stem}_{i}") for stem, family, _, _ in FAMILIES for i in range(1, LAGS + 1)
    ]
    rows = rows.select(key, "region", day, "condition", *OUTPUTS, *lagged)
    return not_null(rows, [*LAG_COLUMNS, *OUTPUTS, "condition"])


# Forecast


def recursive_forecast(features: DataFrame, step: Step, horizon: int = 7, origins: bool = False) -> DataFrame:
    """Forecast ``horizon`` days for all stations at once, feeding each day into the next. With
    ``origins`` the rows also say from which day and how far ahead: ``origin_date, horizon``.

    ``step`` adds the eight outputs and ``predicted_condition`` to rows with ``region_enc`` and
    the lags. The loop runs over days only. A day's record goes into an array on the row and the
    array is exploded at the end, so the plan is one narrow pass over the stations: no shuffle,
    no union that would repeat earlier days, and no lineage to cut. (``inline_outer``, because
    for ``inline`` Spark infers a filter on the array's size and pushes the whole recursion
    down into it a second time. The array is never empty.)
    """
    keys = ["province_id", "region", "weather_date"]
    fields = ["day:int", *[f"{c}:double" for c in OUTPUTS], "predicted_condition:string"]
    state = features.selectExpr(
        *keys,
        "cast(region_enc as double) as region_enc",
        *[
            f"array({', '.join(f'cast({stem}_{i} as double)' for i in range(1, LAGS + 1))}) as {stem}"
            for stem, _, _, _ in FAMILIES
        ],
        f"cast(array() as array<struct<{','.join(fields)}>>) as days",
    )
    for day in range(1, horizon + 1):
        predicted = step(state.selectExpr("*", *lag_columns()))
        record = f"struct({day} as day, {', '.join(OUTPUTS)}, predicted_condition)"
        state = predicted.selectExpr(*keys, "region_enc", *shifted_lags(), f"concat(days, array({record})) as days")
    return state.selectExpr(*keys, "inline_outer(days)").selectExpr(
        "province_id",
        "region",
        *(["weather_date as origin_date", "day as horizon"] if origins else []),
        "date_add(weather_date, day) as predicted_date",
        *OUTPUTS,
        "predicted_condition",
    )


def lag_columns() -> list[str]:
    """The lag arrays as one column per lag."""
    return [f"get({stem}, {i - 1}) as {stem}_{i}" for stem, _, _, _ in FAMILIES for i in range(1, LAGS + 1)]


def shifted_lags() -> list[str]:
    """The prediction becomes lag 1, the others move back, the oldest is dropped.

    Lags are kept as arrays between days: as columns, each day would rename the columns of the
    day before, and Spark's optimizer would track all those equalities through every join.
    """
    return [f"slice(concat(array({out}), {stem}), 1, {LAGS}) as {stem}" for stem, _, _, out in FAMILIES]


def weighted_mean_step(weights: Sequence[int] = (4, 2, 1)) -> Step:
    """Predict each measure as the weighted mean of its lags, newest first."""
    total = float(sum(weights))

    def mean(stem: str) -> str:
        return " + ".join(f"{stem}_{i} * {float(w)}D" for i, w in enumerate(weights, 1))

    def step(df: DataFrame) -> DataFrame:
        means = df.selectExpr("*", *[f"({mean(stem)}) / {total}D as {out}" for stem, _, _, out in FAMILIES])
        condition = rule_condition_column(F.col("totalprecip_mm"), F.col("avghumidity"), F.col("avgtemp_c"))
        return means.withColumn("predicted_condition", condition)

    return step


@dataclass(frozen=True)
class ForestForecaster:
    """One forest per output over the lag features, and a classifier over the outputs."""

    regions: StringIndexerModel
    regressors: list
    classifier: PipelineModel

    def encode(self, df: DataFrame) -> DataFrame:
        return self.regions.transform(df)

    def regress(self, df: DataFrame) -> DataFrame:
        df = assemble_features(df, "_features")
        for model in self.regressors:
            df = model.transform(df)
        return df.drop("_features")

    def step(self, df: DataFrame) -> DataFrame:
        return self.classifier.transform(self.regress(df)).drop("_outputs", "_raw", "_probability", "_class")

    def forecast(self, features: DataFrame, horizon: int = 7) -> DataFrame:
        return recursive_forecast(self.encode(features), self.step, horizon)


def fit_forecaster(training: DataFrame, trees: int = 20, depth: int = 5, seed: int = 42) -> ForestForecaster:
    """Fit on ``training_table`` rows.

    The table is daily, so it is small beside the raw data. It is written once, since every
    forest passes over it several times.
    """
    training = durable(training, "training")
    regions = label_encoder(training, "region", "region_enc")
    rows = assemble_features(regions.transform(training), "_features")
    rows = VectorAssembler(inputCols=[*OUTPUTS, "region_enc"], outputCol="_outputs").transform(rows)
    conditions = label_encoder(rows, "condition", "_label")
    rows = conditions.transform(rows).select("_features", "_outputs", "_label", *OUTPUTS).persist()
    try:
        forests = [
            RandomForestRegressor(
                featuresCol="_features", labelCol=out, predictionCol="_fit", numTrees=trees, maxDepth=depth, seed=seed
            )
            .fit(rows)
            .setPredictionCol(out)
            for out in OUTPUTS
        ]
        classes = RandomForestClassifier(
            featuresCol="_outputs",
            labelCol="_label",
            predictionCol="_class",
            rawPredictionCol="_raw",
            probabilityCol="_probability",
            numTrees=trees,
            maxDepth=depth,
            seed=seed,
        ).fit(rows)
    finally:
        rows.unpersist()
    classifier = PipelineModel(
        [
            VectorAssembler(inputCols=[*OUTPUTS, "region_enc"], outputCol="_outputs"),
            classes,
            label_decoder(conditions, "_class", "predicted_condition"),
        ]
    )
    return ForestForecaster(regions, forests, classifier)


def _scores(scored: DataFrame) -> DataFrame:
    """``(target, metric, value)`` of predicted outputs beside ``true_`` ones, in one pass."""
    columns = []
    for out in OUTPUTS:
        true, error = F.col(f"true_{out}"), F.col(out) - F.col(f"true_{out}")
        squared = F.sum(error * error)
        spread = F.var_pop(true) * F.count(true)
        columns += [
            (out, "rmse", F.sqrt(F.avg(error * error))),
            (out, "mae", F.avg(F.abs(error))),
            (out, "r2", 1 - F.try_divide(squared, spread)),
        ]
    hit = (F.col("predicted_condition") == F.col("condition")).cast("int")
    columns.append(("condition", "accuracy", F.avg(hit)))
    totals = scored.agg(*[c.alias(f"_{i}") for i, (_, _, c) in enumerate(columns)])
    rows = [
        F.struct(F.lit(t).alias("target"), F.lit(m).alias("metric"), F.col(f"_{i}").alias("value"))
        for i, (t, m, _) in enumerate(columns)
    ]
    return totals.select(F.inline(F.array(*rows)))


def evaluate_forecaster(model: ForestForecaster, held_out: DataFrame) -> DataFrame:
    """One day ahead: ``(target, metric, value)`` on rows of ``training_table`` that the model has not
    seen."""
    truth = held_out.withColumnsRenamed({out: f"true_{out}" for out in OUTPUTS})
    return _scores(model.step(model.encode(truth)))


def evaluate_forecast(forecast: DataFrame, daily: DataFrame, day: str = "weather_date") -> DataFrame:
    """``(target, metric, value)`` of a forecast as it is served, of any step and horizon, on the days
    that have since been observed: ``daily`` with ``predicted_condition`` as the condition that was."""
    measures = [F.col(measure).cast("double").alias(f"true_{out}") for _, _, measure, out in FAMILIES]
    truth = daily.select("province_id", F.col(day).alias("predicted_date"), F.col("predicted_condition").alias("condition"), *measures)
    return _scores(forecast.join(truth, ["province_id", "predicted_date"]))


# Rolling origins


def origin_features(daily: DataFrame, key: str = "province_id", day: str = "weather_date", aligned: bool = False) -> DataFrame:
    """Every station-day that has all lags, with the features that would have been served on it."""
    window = Window.partitionBy(key).orderBy(day).rowsBetween(-3, Window.currentRow)
    first = {family: 0 if aligned else start for family, _, start in LAG_FAMILIES}
    arrays = [F.reverse(F.collect_list(F.col(measure).cast("double")).over(window)).alias(f"_{stem}") for stem, _, measure, _ in FAMILIES]
    rows = daily.select(key, "region", day, *arrays)
    lagged = [F.get(f"_{stem}", F.lit(first[family] + i - 1)).alias(f"{stem}_{i}") for stem, family, _, _ in FAMILIES for i in range(1, LAGS + 1)]
    return complete(rows.select(key, "region", day, *lagged))


def backtest(features: DataFrame, step: Step, daily: DataFrame, horizon: int = 7, day: str = "weather_date") -> DataFrame:
    """``(target, horizon, pairs, rmse, mae, naive_rmse, naive_mae)``: how far off a forecast is, by how
    far it looks ahead, beside the naive forecast that all stays as it was on the origin's day.

    ``features`` are encoded ``origin_features``: each row is an origin, and the recursion runs once
    over all of them. A forecast counts where the day it is for was observed; both forecasts are
    judged on the same pairs. A condition is off by 1 if it is another one, so its ``mae`` is the
    share of misses. Two equi-joins on station and day, one aggregation to a row per day ahead."""
    truth = [F.col(measure).cast("double").alias(f"true_{out}") for _, _, measure, out in FAMILIES]
    truth = daily.select("province_id", F.col(day).alias("_day"), F.col("predicted_condition").alias("true_condition"), *truth)
    base = truth.withColumnsRenamed({c: c.replace("true_", "naive_") for c in truth.columns if c.startswith("true_")})
    made = recursive_forecast(features, step, horizon, origins=True)
    pairs = made.join(truth.withColumnRenamed("_day", "predicted_date"), ["province_id", "predicted_date"])
    pairs = pairs.join(base.withColumnRenamed("_day", "origin_date"), ["province_id", "origin_date"])
    targets, figures = [*OUTPUTS, "condition"], []
    for target in targets:
        if target == "condition":
            off = [(F.col(c) != F.col("true_condition")).cast("double") for c in ("predicted_condition", "naive_condition")]
        else:
            off = [F.col(c) - F.col(f"true_{target}") for c in (target, f"naive_{target}")]
        figures.append((F.count(off[0]), *[f for error in off for f in (F.sqrt(F.avg(error * error)), F.avg(F.abs(error)))]))
    names = ["pairs", "rmse", "mae", "naive_rmse", "naive_mae"]
    totals = pairs.groupBy("horizon").agg(*[f.alias(f"{n}{i}") for i, fs in enumerate(figures) for n, f in zip(names, fs)])
    rows = [F.struct(F.lit(t).alias("target"), "horizon", *[F.col(f"{n}{i}").alias(n) for n in names]) for i, t in enumerate(targets)]
    return totals.select(F.inline(F.array(*rows)))
