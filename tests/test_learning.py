import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from stationflow.operators import learning as ml
from stationflow.operators.windows import lag_features

DAY = dt.date(2024, 1, 30)


def _features(spark, value=1.0, missing=()):
    columns = {c: F.lit(None if c in missing else value).cast("double") for c in ml.LAG_COLUMNS}
    base = spark.createDataFrame([(1, "N", DAY)], "province_id int, region string, weather_date date")
    return base.withColumns({**columns, "region_enc": F.lit(0.0)})


def test_feature_and_output_orders_differ():
    assert len(ml.FEATURES) == 25 and ml.FEATURES[:5] == ["region_enc", "avgt_c_lag_1", "avgt_c_lag_2", "avgt_c_lag_3", "avghumidity_lag_1"]
    assert ml.OUTPUTS[1] == "maxtemp_c" and [f[3] for f in ml.FAMILIES][1] == "avghumidity"
    assert set(ml.OUTPUTS) == {f[3] for f in ml.FAMILIES}


def test_prediction_becomes_lag_one_of_its_own_family(spark):
    """A step that adds ten times its family's number to lag 1 shows any mix-up."""

    def step(df):
        for n, (stem, _, _, out) in enumerate(ml.FAMILIES, 1):
            df = df.withColumn(out, F.col(f"{stem}_1") + 10.0 * n + 1000 * (F.col(f"{stem}_3") - F.col(f"{stem}_3")))
        return df.withColumn("predicted_condition", F.lit("Sunny"))

    rows = ml.recursive_forecast(_features(spark), step).orderBy("predicted_date").collect()
    assert [r.predicted_date for r in rows] == [DAY + dt.timedelta(days=i) for i in range(1, 8)]
    for n, (_, _, _, out) in enumerate(ml.FAMILIES, 1):
        assert [r[out] for r in rows] == [1.0 + 10.0 * n * day for day in range(1, 8)]


def test_recursion_by_hand(spark):
    features = _features(spark).withColumns({"precip_lag_1": F.lit(7.0), "precip_lag_2": F.lit(14.0), "precip_lag_3": F.lit(0.0)})
    lags, expected = [7.0, 14.0, 0.0], []
    for _ in range(7):
        expected.append((lags[0] * 4 + lags[1] * 2 + lags[2]) / 7)
        lags = [expected[-1], *lags[:2]]
    rows = ml.recursive_forecast(features, ml.weighted_mean_step()).orderBy("predicted_date").collect()
    assert [r.totalprecip_mm for r in rows] == expected


def test_forecast_is_one_pass_without_shuffle(spark):
    plan = ml.recursive_forecast(_features(spark), ml.weighted_mean_step())._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "Exchange" not in text and "Union" not in text and len(text) < 60_000


def test_short_histories_are_named_not_forecast(spark):
    features = _features(spark, missing=("precip_lag_3", "maxtemp_lag_2"))
    assert ml.complete(features).count() == 0
    assert ml.skipped(features).first().missing == ["maxtemp_lag_2", "precip_lag_3"]


def _daily(spark, days=9, hole=None):
    """The n-th day before DAY has n in every measure; ``hole``: a day without a maximum."""
    rows = [(1, "N", DAY - dt.timedelta(days=i), float(i)) for i in range(days)]
    df = spark.createDataFrame(rows, "province_id int, region string, weather_date date, v double")
    daily = df.withColumns({m: F.col("v") for _, _, m, _ in ml.FAMILIES}).withColumn("predicted_condition", F.lit("x"))
    return daily.withColumn("max_temperature", F.when(F.col("v") != hole, F.col("v"))) if hole is not None else daily


def test_training_rows_use_the_days_before(spark):
    rows = ml.training_table(_daily(spark, 5), aligned=True).orderBy("weather_date").collect()
    assert [(r.avgtemp_c, r.avgt_c_lag_1, r.avgt_c_lag_3, r.maxtemp_lag_1) for r in rows] == [(1.0, 2.0, 4.0, 2.0), (0.0, 1.0, 3.0, 1.0)]
    (row,) = ml.training_table(_daily(spark, 5)).collect()  # the other families start a day earlier
    assert (row.avgtemp_c, row.avgt_c_lag_1, row.avgt_c_lag_3, row.maxtemp_lag_1, row.maxtemp_lag_3) == (0.0, 1.0, 3.0, 2.0, 4.0)


@pytest.mark.parametrize("aligned", [False, True])
@pytest.mark.parametrize("hole", [None, 5.0])
def test_models_are_fitted_on_the_features_they_are_served(spark, aligned, hole):
    """For a target day, the row fitted on equals what is served on the day before."""
    daily = _daily(spark, 9, hole)
    target, places = DAY - dt.timedelta(days=2), spark.createDataFrame([(1, "N")], "province_id int, region string")
    before = daily.where(F.col("weather_date") < F.lit(target))
    served = ml.feature_table(lag_features(before, places, target - dt.timedelta(days=1), aligned=aligned)).select(*ml.LAG_COLUMNS).first()
    fitted = ml.training_table(daily, aligned=aligned).where(F.col("weather_date") == F.lit(target)).select(*ml.LAG_COLUMNS).first()
    if fitted is None:  # a row that lacks a lag is neither fitted on nor served
        assert None in tuple(served)
    else:
        assert tuple(fitted) == tuple(served)


def test_forecast_is_evaluated_on_the_days_that_came(spark):
    forecast = spark.createDataFrame([(1, DAY, "x"), (1, DAY + dt.timedelta(days=1), "x")], "province_id int, predicted_date date, predicted_condition string")
    forecast = forecast.withColumns({out: F.lit(3.0) for out in ml.OUTPUTS})
    found = {(r.target, r.metric): r.value for r in ml.evaluate_forecast(forecast, _daily(spark, 2)).collect()}
    assert found["maxtemp_c", "rmse"] == found["maxtemp_c", "mae"] == 3.0 and found["condition", "accuracy"] == 1.0


def test_unseen_region_is_an_error(spark):
    model = ml.label_encoder(spark.createDataFrame([("b",), ("a",)], "r string"), "r", "code")
    assert list(model.labels) == ["a", "b"]
    with pytest.raises(Exception, match="Unseen label"):
        model.transform(spark.createDataFrame([("c",)], "r string")).collect()


def test_udf_gets_batches_and_is_dropped_when_unread(spark):
    daily = spark.range(10).select(*[F.col("id").cast("double").alias(c) for c in ml.UDF_ARGUMENTS[:-1]], F.lit("N").alias("region"))
    seen = ml.vectorized_condition(lambda frame: [f"{len(frame)}:{list(frame)[-1]}"] * len(frame))
    labelled = daily.withColumn("label", seen(daily))
    assert labelled.first().label.endswith(":region")
    assert "Python" not in labelled.select("region")._jdf.queryExecution().executedPlan().toString()


def test_rule_forms_agree():
    frame = pd.DataFrame({"sum_precipitation": [0.0, 5.0, 500.0], "avg_humidity": [60.0, 1.0, 1.0], "avg_temperature": [1.0, 1.0, 1.0]})
    assert list(ml.rule_condition(frame)) == ["Cloudy", "Light rain", "Heavy rain"]
