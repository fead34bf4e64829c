import datetime as dt

from pyspark.sql import functions as F

from stationflow.operators.windows import LAG_FAMILIES, lag_arrays, lag_features, latest_per_key

DAY = dt.date(2024, 1, 30)


def _daily(spark, rows):
    """rows: (province, days ago, rain); the other measures are 100 - days ago."""
    data = [(p, DAY - dt.timedelta(days=ago), float(100 - ago), rain) for p, ago, rain in rows]
    df = spark.createDataFrame(data, "province_id int, weather_date date, v double, sum_precipitation double")
    others = {m: F.col("v") for _, m, _ in LAG_FAMILIES if m not in ("sum_precipitation", "chance_rain")}
    return df.withColumns({**others, "chance_rain": F.lit(1)}).drop("v").withColumn("region", F.lit("old"))


def _provinces(spark):
    return spark.createDataFrame([(1, "North"), (2, "South"), (3, "East")], "province_id int, region string")


def test_average_temperature_starts_at_the_newest_day(spark):
    row = lag_features(_daily(spark, [(1, a, 0.0) for a in range(5)]), _provinces(spark), DAY).first()
    assert (row.avgtemp1, row.avgtemp2, row.avgtemp3) == (100, 99, 98)
    assert (row.maxtemp1, row.maxtemp2, row.maxtemp3) == (99, 98, 97)
    assert (row.region, row.weather_date) == ("North", DAY)
    aligned = lag_features(_daily(spark, [(1, a, 0.0) for a in range(5)]), _provinces(spark), DAY, aligned=True).first()
    assert (aligned.avgtemp1, aligned.avgtemp3, aligned.maxtemp1, aligned.maxtemp3) == (100, 98, 100, 98)


def test_null_measure_moves_later_lags_up(spark):
    row = lag_features(_daily(spark, [(1, 0, 1.0), (1, 1, None), (1, 2, 3.0), (1, 3, 4.0)]), _provinces(spark), DAY).first()
    assert (row.precip1, row.precip2, row.precip3) == (3.0, 4.0, None)
    assert row.maxtemp1 == 99


def test_only_four_newest_rows_count_even_when_one_is_null(spark):
    rows = [(1, 0, 1.0), (1, 1, None), (1, 2, 3.0), (1, 3, 4.0), (1, 4, 5.0)]
    assert lag_features(_daily(spark, rows), _provinces(spark), DAY).first().precip3 is None


def test_short_history_gap_and_lookback(spark):
    rows = [(1, 0, 1.0), (1, 1, 2.0), (2, 0, 1.0), (2, 3, 2.0), (3, 5, 9.0)]
    out = {r.province_id: r for r in lag_features(_daily(spark, rows), _provinces(spark), DAY).collect()}
    assert out[1].maxtemp1 == 99 and out[1].maxtemp2 is None and out[1].avgtemp2 == 99
    assert out[2].maxtemp1 == 97  # the gap is not filled
    assert 3 not in out  # older than the look-back


def test_lag_arrays_skip_nulls(spark):
    df = _daily(spark, [(1, 0, 1.0), (1, 1, None), (1, 2, 3.0), (1, 3, 4.0), (1, 4, 5.0)])
    rows = lag_arrays(df, "province_id", "weather_date", {"a": "sum_precipitation"}).orderBy(F.desc("weather_date")).collect()
    assert [r.a for r in rows] == [[1.0, 3.0, 4.0], [3.0, 4.0, 5.0], [3.0, 4.0, 5.0], [4.0, 5.0], [5.0]]


def test_latest_breaks_ties_by_the_order_given(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "z"), (2, None, "n")], "k int, ts int, v string")
    rows = latest_per_key(df, ["k"], [F.desc("ts"), F.desc("v")]).collect()
    assert {(r.k, r.v) for r in rows} == {(1, "b"), (2, "n")}


def test_latest_cuts_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 3)
    plan = latest_per_key(df, ["k"], [F.desc("id")])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan.split("Exchange hashpartitioning")[1]
