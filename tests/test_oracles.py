"""Every registered query against its DuckDB oracle on the smallest data."""

import pytest

import __spark_entry__ as entry_point
from oracle import connect, differences

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, con, name):
    assert differences(QUERIES[name](spark, FOLDER), con, ORACLES[name]) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_gives_rows(spark):
    assert entry_point.entry(spark).count() > 0


def test_forests_forecast_seven_days(spark):
    rows = QUERIES["forecast_rf_values"](spark, "/root/testdata/sf0.01").collect()
    days = {}
    for row in rows:
        days.setdefault(row["province_id"], set()).add(row["predicted_date"])
    assert rows and all(len(found) == 7 for found in days.values())
    assert all(0 <= row["daily_chance_of_rain"] <= 1 for row in rows)


def test_evaluation_names_every_target(spark):
    rows = QUERIES["evaluate_forecaster_values"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 25 and all(r["value"] is not None for r in rows)
