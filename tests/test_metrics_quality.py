import pytest
from pyspark.sql import functions as F

from stationflow.operators import quality as dq
from stationflow.operators.metrics import Dimension, Entity, Measure, Metric, SemanticLayer, SemanticModel, fill_days, time_spine
from stationflow.operators.relational import preview
from stationflow.plans import contracts, semantic


@pytest.fixture
def layer(spark):
    fact = spark.createDataFrame(
        [(1, "2024-01-01", 1.0, True), (1, "2024-02-01", 3.0, False), (2, "2024-01-01", 5.0, None), (3, "2024-01-01", 7.0, True)],
        "p int, d string, v double, wet boolean",
    ).selectExpr("p", "cast(d as date) as d", "v", "wet")
    dim = spark.createDataFrame([(1, "N"), (2, "S")], "p int, region string")
    models = [
        SemanticModel("dim", entities=(Entity("place", "primary", "p"),), dimensions=(Dimension("region", "categorical"),)),
        SemanticModel(
            "fact",
            entities=(Entity("place", "foreign", "p"),),
            dimensions=(Dimension("d", "time"), Dimension("p", "categorical")),
            measures=(Measure("v", "sum"), Measure("wet_days", "sum", "wet"), Measure("days", "count", "wet")),
            time_dimension="d",
        ),
    ]
    metrics = [
        Metric("total", measure="v"),
        Metric("wet_days", measure="wet_days"),
        Metric("days", measure="days"),
        Metric("share", kind="ratio", numerator="wet_days", denominator="days"),
        Metric("twice", kind="derived", inputs=("total", "days"), expr="total * 2 + days"),
        Metric("both", kind="derived", inputs=("total", "share")),
    ]
    return SemanticLayer(models, metrics, {"dim": dim, "fact": fact})


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_entity_join_keeps_unknown_places(layer):
    assert rows(layer.query(["total"], ["place__region"])) == {("N", 4.0), ("S", 5.0), (None, 7.0)}


def test_ratio_without_denominator_is_null(layer):
    assert rows(layer.query(["share"], ["p"])) == {(1, 0.5), (2, None), (3, 1.0)}


def test_derived_with_and_without_expression(layer):
    assert rows(layer.query(["twice"])) == {(35.0,)}
    assert layer.query(["both"], ["p"]).columns == ["p", "total", "share"]


def test_metrics_of_two_models_meet_on_their_dimensions(spark, layer):
    sales = spark.createDataFrame([(1, "2024-01-05", 10.0), (1, "2024-01-06", 20.0), (4, "2024-03-01", 5.0), (None, None, 2.0)], "p int, sold string, price double")
    model = SemanticModel(
        "sales",
        entities=(Entity("place", "foreign", "p"),),
        dimensions=(Dimension("day", "time", "cast(sold as date)"), Dimension("p", "categorical")),
        measures=(Measure("price", "sum"),),
        time_dimension="day",
    )
    both = SemanticLayer(
        [*layer.models.values(), model],
        [*layer.metrics.values(), Metric("revenue", measure="price"), Metric("per_v", kind="ratio", numerator="revenue", denominator="total")],
        {**layer.tables, "sales": sales},
    )
    # No fan-out: place 1 has two rows on either side. Groups that one side lacks stay.
    assert rows(both.query(["total", "revenue", "per_v"], ["p"])) == {
        (1, 4.0, 30.0, 7.5), (2, 5.0, None, None), (3, 7.0, None, None), (4, None, 5.0, None), (None, None, 2.0, None)
    }
    # An unknown place's region is NULL on both sides: one group.
    assert rows(both.query(["revenue", "total"], ["place__region"])) == {("N", 30.0, 4.0), ("S", None, 5.0), (None, 7.0, 7.0)}
    months = {(str(m), t, r) for m, t, r in rows(both.query(["total", "revenue"], ["metric_time__month"]))}
    assert months == {("2024-01-01", 13.0, 30.0), ("2024-02-01", 3.0, None), ("2024-03-01", None, 5.0), ("None", None, 2.0)}
    assert rows(both.query(["revenue", "share"])) == {(37.0, 2 / 3)}
    with pytest.raises(KeyError):
        both.query(["total", "revenue"], ["d"])  # only one of them has it


def test_grain_and_filter(layer):
    out = layer.query(["total"], ["metric_time__month"], where="p = 1")
    assert {(str(d), v) for d, v in rows(out)} == {("2024-01-01", 1.0), ("2024-02-01", 3.0)}
    with pytest.raises(KeyError):
        layer.query(["total"], ["nothing"])


def test_spine_bounds_and_fill(spark, layer):
    spine = time_spine(spark)
    assert [str(r[0]) for r in spine.agg({"date_day": "min"}).collect() + spine.agg({"date_day": "max"}).collect()] == [
        "2020-01-01", "2033-09-08"
    ]
    filled = fill_days(layer.query(["total"], ["d"]), time_spine(spark, "2024-01-01", 3), "d")
    assert {(str(d), v) for d, v in rows(filled)} == {
        ("2024-01-01", 13.0), ("2024-01-02", None), ("2024-01-03", None), ("2024-02-01", 3.0)
    }


def test_days_outside_the_spine_stay(spark, layer):
    spine = time_spine(spark, "2024-01-01", 2)
    assert {(str(d), v) for d, v in rows(fill_days(layer.query(["total"], ["d"]), spine, "d"))} == {
        ("2024-01-01", 13.0), ("2024-01-02", None), ("2024-02-01", 3.0)
    }
    metric = spark.createDataFrame([("N", None, 1.0), ("N", "2024-01-02", 2.0), ("Z", "2031-01-01", 3.0)], "k string, d string, v double")
    metric = metric.selectExpr("k", "cast(d as date) as d", "v")
    filled = fill_days(metric, spine, "d", spark.createDataFrame([("N",), (None,)], "k string"))
    assert {(k, str(d), v) for k, d, v in rows(filled)} == {
        ("N", "2024-01-01", None), ("N", "2024-01-02", 2.0), (None, "2024-01-01", None), (None, "2024-01-02", None), ("N", "None", 1.0), ("Z", "2031-01-01", 3.0)
    }


def test_sixteen_metrics_and_seventy_four_checks():
    assert len(semantic.METRICS) == 16 and len(contracts.ALL_CHECKS) == 74


def test_bounds_are_inclusive_and_null_passes(spark):
    df = spark.createDataFrame([(-20.0,), (50.0,), (None,), (50.1,), (-20.1,)], "t double")
    checks = dq.accepted_range("x", "t", -20, 50) + dq.not_null("x", "t")
    assert {(r.test, r.failures) for r in dq.run_checks({"x": df}, checks).collect()} == {("accepted_range", 2), ("not_null", 1)}
    assert {r.t: r.failed for r in dq.failing_rows(df, checks).collect()} == {
        None: ["not_null:t"], 50.1: ["accepted_range:t"], -20.1: ["accepted_range:t"]
    }


def test_unique_and_relationship_counts(spark):
    child = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (2, 2), (None, 2), (None, 2), (9, 3), (9, 4)], "k int, j int")
    parent = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    checks = dq.unique("c", "k") + dq.unique_combination("c", "k", "j") + dq.relationship("c", "k", "p", "k")
    out = {r.test: r.failures for r in dq.run_checks({"c": child, "p": parent}, checks).collect()}
    assert out == {"unique": 3, "unique_combination": 2, "relationship": 2}


def test_failing_rows_of_every_kind(spark):
    child = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (2, 2), (None, 2), (None, 2), (9, 3)], "k int, j int")
    parent = spark.createDataFrame([(1,), (2,)], "k int")
    checks = dq.unique("c", "k") + dq.unique_combination("c", "k", "j") + dq.relationship("c", "k", "p", "k") + dq.not_null("c", "k")
    out = sorted((str(r.k), r.j, r.failed) for r in dq.failing_rows(child, checks, tables={"p": parent}).collect())
    twice, combination = "unique:k", "unique_combination:k,j"
    assert out == [
        ("1", 1, [twice, combination]), ("1", 1, [twice, combination]), ("2", 1, [twice]), ("2", 2, [twice]), ("9", 3, ["relationship:k"]),
        ("None", 2, [combination, "not_null:k"]), ("None", 2, [combination, "not_null:k"]),
    ]


def test_a_preview_reads_its_input_once(spark, tmp_path):
    spark.range(10).selectExpr("id % 2 as k", "id").write.parquet(str(tmp_path / "t"))
    shown = preview(spark.read.parquet(str(tmp_path / "t")), ["k"], [F.asc("id")], 3)
    assert str(tmp_path) not in shown._jdf.queryExecution().executedPlan().toString()  # both halves read the stored rows
    assert {(r.k, r.id, r.row, r.remaining) for r in shown.collect()} == {(k, k + 2 * i, i + 1, 2) for k in (0, 1) for i in range(3)}


def test_row_checks_take_one_pass(spark, tmp_path):
    spark.range(10).selectExpr("id as a", "id as b", "id as c").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    checks = dq.not_null("t", "a", "b") + dq.accepted_range("t", "a", 0, 5)
    plan = dq.run_checks({"t": df}, checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "ReadSchema: struct<a:bigint,b:bigint>" in plan
