import datetime as dt

from pyspark.sql import functions as F

from stationflow.functions import scalar as s
from stationflow.operators.rollups import daily_rollup, region_rollup
from stationflow.plans.marts import current_mart

T0 = dt.datetime(2024, 1, 1, 10)


def _staged(spark, rows):
    schema = (
        "province_name string, weather_updated_at timestamp_ntz, temperature_celsius double, precipitation_mm double,"
        " humidity_percent int, wind_speed_kph double, cloud_cover_percent int, uv_index double, is_daytime boolean,"
        " weather_condition string"
    )
    return spark.createDataFrame([(n, t, c, p, 50, 10.0, 1, 1.0, True, w) for n, t, c, p, w in rows], schema)


def _provinces(spark):
    return spark.createDataFrame([(1, "A", "N"), (2, "B", "N")], "province_id int, province_name string, region string")


def test_rain_indicator_of_missing_zero_and_positive(spark):
    rows = [("A", T0, 1.0, None, "x"), ("B", T0, 2.0, 0.0, "x"), ("B", T0, 4.0, 0.2, "x"), ("?", T0, 9.0, 9.0, "x")]
    out = {r.province_name: r for r in daily_rollup(_staged(spark, rows), _provinces(spark)).collect()}
    assert set(out) == {"A", "B"}  # the unknown name is dropped
    assert out["A"].chance_rain == 0 and out["A"].sum_precipitation is None
    assert out["B"].chance_rain == 1 and out["B"].avg_temperature == 3.0


def test_region_average_is_not_weighted_by_readings(spark):
    rows = [("A", T0, 0.0, 0.0, "x")] + [("B", T0, 10.0, 0.0, "x")] * 9
    daily = daily_rollup(_staged(spark, rows), _provinces(spark))
    assert region_rollup(daily, _provinces(spark)).first().avg_temperature == 5.0


def test_day_filter_reaches_the_scan(spark, tmp_path):
    staged = _staged(spark, [("A", T0, 1.0, 0.0, "x")])
    staged.write.parquet(str(tmp_path / "s"))
    daily = daily_rollup(spark.read.parquet(str(tmp_path / "s")), _provinces(spark))
    plan = daily.where(s.within_lookback(F.col("weather_date"), "2024-01-30"))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(weather_updated_at,2024-01-26T00:00)" in plan
    assert "weather_condition" not in plan  # unused columns are not read


def test_rain_flag_texts(spark):
    texts = spark.createDataFrame([(None,), ("Heavy Rain",), ("drizzle",)], "t string")
    assert [r[0] for r in texts.select(s.contains_flag(F.col("t"))).collect()] == [False, True, False]


def test_current_snapshot_takes_the_newest_and_flags_rain(spark):
    rows = [("A", T0, 1.0, 0.0, "Sunny"), ("A", T0 + dt.timedelta(hours=1), 2.0, 1.0, "Light Rain"), ("B", T0, 3.0, 0.0, None)]
    out = {r.province_name: r for r in current_mart(_staged(spark, rows), _provinces(spark)).collect()}
    assert out["A"].temperature_celsius == 2.0 and out["A"].is_raining is True
    assert out["B"].is_raining is False


def test_strict_and_lenient_conversion(spark):
    import pytest

    df = spark.createDataFrame([("1.5",)], "t string")
    assert df.select(s.convert(F.col("t"), "int", strict=False)).first()[0] is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(s.convert(F.col("t"), "int")).collect()
