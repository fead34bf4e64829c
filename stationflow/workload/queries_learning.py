"""Condition labels, encoders, features and forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stationflow.operators import learning as ml
from stationflow.operators.windows import lag_features, latest_per_key
from stationflow.workload.adapter import AS_OF, Data, rounded, rounded_sql, sql
from stationflow.workload.registry import query


@query(
    "vectorized_udf",
    sql("select province_id, weather_date, predicted_condition from classified", "classified"),
)
def vectorized_udf(d: Data) -> DataFrame:
    label = ml.vectorized_condition()
    return d.daily.select("province_id", "weather_date", label(d.daily).alias("predicted_condition"))


@query(
    "label_encode",
    sql(
        """select province_id, weather_date, r.region, cast(code as double) as region_enc, r.region as decoded from daily
        join (select region, dense_rank() over (order by region) - 1 as code from (select distinct region from daily)) r
        on daily.region = r.region""",
        "daily",
    ),
)
def label_encode(d: Data) -> DataFrame:
    """Region to code and back."""
    model = ml.label_encoder(d.provinces, "region", "region_enc")  # the dimension has all regions
    encoded = model.transform(d.daily.select("province_id", "weather_date", "region"))
    return ml.label_decoder(model, "region_enc", "decoded").transform(encoded)


@query(
    "assemble_features",
    sql(
        "select province_id, unnest(generate_series(0, 24)) as position, round(unnest([cast(code as double), "
        + ", ".join(
            f"{family}{i}"
            for family in ("avgtemp", "humidity", "rainchance", "maxtemp", "mintemp", "precip", "windkph", "windmph")
            for i in (1, 2, 3)
        )
        + """]), 9) as value from lags join (select region, dense_rank() over (order by region) - 1 as code from
        (select distinct region from provinces)) using (region) where avgtemp3 is not null and maxtemp3 is not null""",
        "lags",
        "provinces",
    ),
)
def assemble_features(d: Data) -> DataFrame:
    """The 25 features in model order, one row each."""
    from pyspark.ml.functions import vector_to_array

    regions = ml.label_encoder(d.provinces, "region", "region_enc")
    vectors = ml.assemble_features(regions.transform(ml.complete(ml.feature_table(d.lags))))
    rows = vectors.select("province_id", F.posexplode(vector_to_array("features")).alias("position", "value"))
    return rounded(rows.withColumn("position", F.col("position").cast("long")))


@query(
    "forecast_linear",
    sql(f"select province_id, region, predicted_date, predicted_condition, {rounded_sql(*ml.OUTPUTS)} from predictions", "predictions"),
)
def forecast_linear(d: Data) -> DataFrame:
    return rounded(d.predictions)


def _labelled(d: Data) -> DataFrame:
    """Daily rows with the condition reported last on each day, as the label to learn."""
    day = F.to_date("weather_updated_at")
    readings = d.staged.select(
        "province_name", day.alias("weather_date"), "weather_updated_at", F.col("weather_condition").alias("predicted_condition")
    )
    order = [F.desc("weather_updated_at"), F.asc("predicted_condition")]
    reported = latest_per_key(readings, ["province_name", "weather_date"], order).drop("weather_updated_at")
    return d.daily.join(reported, ["province_name", "weather_date"])


def _forest(d: Data) -> tuple[DataFrame, DataFrame]:
    """Seven days by random forests over the history of all provinces, and the rows fitted on."""
    training = ml.training_table(_labelled(d))
    model = ml.fit_forecaster(training, trees=10, depth=4)
    return model.forecast(ml.complete(ml.feature_table(d.lags))), training


@query("forecast_rf_values")
def forecast_rf_values(d: Data) -> DataFrame:
    return _forest(d)[0]


@query(
    "forecast_rf",
    sql(
        "select province_id, region, cast(weather_date + unnest(range(1, 8))::int as date) as predicted_date, 8 as within_range,"
        " true as known_condition from lags where "
        + " and ".join(f"{f}{i} is not null" for f in ("avgtemp", "humidity", "rainchance", "maxtemp", "mintemp", "precip", "windkph", "windmph") for i in (1, 2, 3)),
        "lags",
    ),
)
def forecast_rf(d: Data) -> DataFrame:
    """What must hold of a forest's forecast: seven days for each station with all lags, every output
    within the range it was fitted on (a mean of such values), every condition one that was seen."""
    forecast, training = _forest(d)
    ends = [f(c).alias(f"{n}_{c}") for c in ml.OUTPUTS for n, f in (("low", F.min), ("high", F.max))]
    ranges = training.agg(*ends, F.collect_set("condition").alias("seen")).first()  # a handful of conditions
    inside = [F.col(c).between(ranges[f"low_{c}"] - 1e-9, ranges[f"high_{c}"] + 1e-9).cast("int") for c in ml.OUTPUTS]
    return forecast.select(
        "province_id",
        "region",
        "predicted_date",
        sum(inside[1:], inside[0]).alias("within_range"),
        F.col("predicted_condition").isin(ranges["seen"]).alias("known_condition"),
    )


_METRICS = ", ".join(f"('{out}', '{metric}')" for out in ml.OUTPUTS for metric in ("rmse", "mae", "r2")) + ", ('condition', 'accuracy')"


def _evaluated(d: Data) -> DataFrame:
    """Fitted on the days up to a cut, evaluated on the days after it."""
    table = ml.training_table(_labelled(d))
    cut = F.lit("2024-01-24").cast("date")
    model = ml.fit_forecaster(table.where(F.col("weather_date") <= cut), trees=10, depth=4)
    return ml.evaluate_forecaster(model, table.where(F.col("weather_date") > cut))


@query("evaluate_forecaster_values")
def evaluate_values(d: Data) -> DataFrame:
    return _evaluated(d)


@query("evaluate_forecaster", f"select col0 as target, col1 as metric, true as plausible from (values {_METRICS})")
def evaluate(d: Data) -> DataFrame:
    """What must hold of the figures: a mean absolute error of at most the root of the mean square,
    no r2 above 1, an accuracy between 0 and 1."""
    rows = _evaluated(d)
    errors = rows.groupBy("target").agg(F.max(F.when(F.col("metric") == "rmse", F.col("value"))).alias("rmse"))
    low = F.when(F.col("metric") == "r2", F.lit(float("-inf"))).otherwise(0.0)
    high = F.when(F.col("metric") == "mae", F.col("rmse") + 1e-9).when(F.col("metric") == "rmse", F.lit(float("inf"))).otherwise(1.0)
    return rows.join(errors, "target").select("target", "metric", F.col("value").between(low, high).alias("plausible"))


CUT = "2024-01-23"
_TRUTH = {out: measure for _, _, measure, out in ml.FAMILIES}
_SCORED = sql(
    "select "
    + ", ".join(
        f"sqrt(avg(({out} - {m}) ** 2)) as rmse_{out}, avg(abs({out} - {m})) as mae_{out},"
        f" 1 - sum(({out} - {m}) ** 2) / nullif(var_pop({m}) * count({m}), 0) as r2_{out}"
        for out, m in _TRUTH.items()
    )
    + """, avg(case when p.predicted_condition = c.predicted_condition then 1 else 0 end) as accuracy_condition
    from predictions p join classified c on p.province_id = c.province_id and p.predicted_date = c.weather_date""",
    "predictions",
    "classified",
).replace(f"weather_date >= date '{AS_OF}' - 4", f"weather_date between date '{CUT}' - 4 and date '{CUT}'")


@query(
    "evaluate_forecast",
    "select * from (select unnest(["
    + ", ".join(f"{{'target': '{out}', 'metric': '{m}', 'value': round({m}_{out}, 9)}}" for out in ml.OUTPUTS for m in ("rmse", "mae", "r2"))
    + ", {'target': 'condition', 'metric': 'accuracy', 'value': round(accuracy_condition, 9)}], recursive := true) from ("
    + _SCORED
    + "))",
)
def evaluate_forecast(d: Data) -> DataFrame:
    """The served seven-day forecast, made with the days up to a cut, against the days after it."""
    past = d.daily.where(F.col("weather_date") <= F.lit(CUT).cast("date"))
    features = ml.complete(ml.feature_table(lag_features(past, d.provinces, CUT)))
    regions = ml.label_encoder(d.provinces, "region", "region_enc")
    forecast = ml.recursive_forecast(regions.transform(features), ml.weighted_mean_step())
    return rounded(ml.evaluate_forecast(forecast, d.classified))
