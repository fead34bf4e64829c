import datetime as dt

import pytest
from pyspark.sql import functions as F

from stationflow.operators import incremental as inc
from stationflow.plans import marts
from stationflow.schemas import DAILY_FACT_SCHEMA, REGION_FACT_SCHEMA
from stationflow.sources.tables import PartitionedTable, VersionedTable

D = [dt.date(2024, 1, d) for d in range(1, 10)]
DIM = "province_id int, province_name string, province_name_vn string, latitude double, longitude double, region string"


def _dim(spark, rows, stamp):
    stamped = spark.createDataFrame(rows, DIM)
    return stamped.withColumn("created_at", F.lit(stamp).cast("timestamp")).withColumn("updated_at", F.lit(stamp).cast("timestamp"))


OLD = [(1, "A", "a", 1.0, 1.0, "N"), (2, "B", "b", 1.0, 1.0, "N"), (3, "C", "c", 1.0, 1.0, "N"), (4, "D", "d", 1.0, 1.0, None), (9, "Z", "z", 1.0, 1.0, "N")]
NEW = [(1, "A", "a", 1.0, 1.0, "N"), (2, "B2", "b", 1.0, 1.0, "N"), (3, "C", "c2", 1.0, 1.0, "N"), (4, "D", "d", 1.0, 1.0, "S"), (5, "E", "e", 1.0, 1.0, "N")]


def test_changed_rows_of_a_dimension(spark):
    old, new = _dim(spark, OLD, "2024-01-01"), _dim(spark, NEW, "2024-02-01")
    as_is = inc.detect_changes(new, old, "province_id", marts.PROVINCE_COMPARE)
    assert {r.province_id for r in as_is.collect()} == {2, 5}  # neither the local name nor NULL to value
    safe = inc.detect_changes(new, old, "province_id", marts.PROVINCE_COMPARE, null_safe=True)
    assert {r.province_id for r in safe.collect()} == {2, 4, 5}
    with_local = inc.detect_changes(new, old, "province_id", [*marts.PROVINCE_COMPARE, "province_name_vn"])
    assert {r.province_id for r in with_local.collect()} == {2, 3, 5}
    assert {(r.province_id, r.created_at.month) for r in as_is.collect()} == {(2, 1), (5, 2)}


def test_dimension_refresh_keeps_creation_time_and_absent_rows(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "dim"))
    marts.refresh_dimension(_dim(spark, OLD, "2024-01-01"), table, marts.PROVINCES)
    out = marts.refresh_dimension(_dim(spark, NEW, "2024-02-01"), table, marts.PROVINCES).collect()
    rows = {r.province_id: r for r in out}
    assert set(rows) == {1, 2, 3, 4, 5, 9}
    assert rows[2].province_name == "B2" and rows[2].created_at.month == 1 and rows[2].updated_at.month == 2
    assert rows[3].province_name_vn == "c" and rows[5].created_at.month == 2 and rows[9].updated_at.month == 1


def test_versions_are_complete_and_stay_until_they_expire(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    assert not table.exists()
    first = table.replace(spark.range(1))
    for n in range(1, 4):
        assert table.replace(spark.range(n + 1)).count() == n + 1
    assert first.count() == 1  # a frame of an old version can still be read
    assert table.expire(dt.timedelta(hours=1)) == [] and table.versions() == [1, 2, 3, 4]
    assert table.expire(dt.timedelta(seconds=-5)) == [1, 2, 3] and table.versions() == [4]
    (tmp_path / "t" / "version-00000005").mkdir()  # a write that never committed
    assert table.read().count() == 4
    assert table.replace(table.read().limit(2)).count() == 2


FACT = "k int, day date, v double, note string"


def _facts(spark, rows):
    return spark.createDataFrame(rows, FACT)


def _table(spark, path, partition_by=("day",), schema=FACT):
    return PartitionedTable(spark, str(path), partition_by, schema)


def test_upsert_rewrites_touched_partitions_only(spark, tmp_path):
    table = _table(spark, tmp_path / "f")
    table.overwrite(_facts(spark, [(1, D[0], 1.0, "old"), (1, D[1], 1.0, "old"), (2, D[1], 1.0, "old")]))
    untouched = sorted(p.name for p in (tmp_path / "f" / f"day={D[0]}").iterdir())
    source = _facts(spark, [(2, D[1], 5.0, "new"), (3, D[2], 5.0, "new")])
    for _ in range(2):  # the second merge of the same rows changes nothing
        out = {(r.k, r.day, r.v, r.note) for r in table.upsert(source, ["k", "day"]).collect()}
        assert out == {(1, D[0], 1.0, "old"), (1, D[1], 1.0, "old"), (2, D[1], 5.0, "new"), (3, D[2], 5.0, "new")}
    assert untouched == sorted(p.name for p in (tmp_path / "f" / f"day={D[0]}").iterdir())
    partial = table.upsert(_facts(spark, [(1, D[0], 7.0, "x")]), ["k", "day"], update_columns=["v"])
    assert {(r.v, r.note) for r in partial.where("k = 1").collect()} == {(7.0, "old"), (1.0, "old")}


def test_upsert_needs_the_partition_in_the_key(spark, tmp_path):
    with pytest.raises(ValueError):
        _table(spark, tmp_path / "f").upsert(_facts(spark, [(1, D[0], 1.0, "a")]), ["k"])


def test_upsert_of_nothing(spark, tmp_path):
    table = _table(spark, tmp_path / "f")
    table.overwrite(_facts(spark, [(1, D[0], 1.0, "a")]))
    assert table.upsert(_facts(spark, []), ["k", "day"]).count() == 1


def test_mark_modes(spark):
    rows = _facts(spark, [(1, d, 1.0, "") for d in D[:5]])
    days = lambda df: sorted(r.day.day for r in df.collect())
    assert days(inc.after_mark(rows, "day", D[2])) == [4, 5]
    assert days(inc.after_mark(rows, "day", D[2], reprocess_days=2)) == [2, 3, 4, 5]
    assert days(inc.after_mark(rows, "day", None)) == [1, 2, 3, 4, 5]
    assert days(inc.after_mark(rows, "day", None, guard_empty=False)) == []


def test_new_row_flags(spark):
    rows = _facts(spark, [(1, D[0], 1.0, ""), (1, D[1], 1.0, "")])
    known = _facts(spark, [(1, D[0], 1.0, "")])
    assert {(r.day.day, r.is_new_row) for r in inc.flag_new_rows(rows, known, ["k", "day"]).collect()} == {(1, False), (2, True)}
    assert all(r.is_new_row for r in inc.flag_new_rows(rows, None, ["k", "day"]).collect())


def _daily(spark, days, value):
    df = spark.createDataFrame([(p, d) for p in (1, 2) for d in days], "province_id int, weather_date date")
    measures = "avg_temperature max_temperature min_temperature sum_precipitation avg_humidity avg_wind_kph avg_wind_mph"
    return df.withColumns({m: F.lit(value) for m in measures.split()}).withColumns(
        {"chance_rain": F.lit(0), "region": F.lit("N"), "predicted_condition": F.lit("Sunny")}
    )


def test_daily_fact_ignores_late_days_unless_reopened(spark, tmp_path):
    provinces = spark.createDataFrame(OLD, DIM)
    table = _table(spark, tmp_path / "f", ["weather_date"], DAILY_FACT_SCHEMA)
    marts.refresh_daily_mart(_daily(spark, D[:3], 1.0), provinces, table)
    out = marts.refresh_daily_mart(_daily(spark, D[:5], 2.0), provinces, table)
    assert {(r.weather_date.day, r.max_temperature) for r in out.collect()} == {(1, 1.0), (2, 1.0), (3, 1.0), (4, 2.0), (5, 2.0)}
    out = marts.refresh_daily_mart(_daily(spark, D[:5], 3.0), provinces, table, reprocess_days=1)
    assert {(r.weather_date.day, r.max_temperature, r.is_new_row) for r in out.collect()} == {
        (1, 1.0, True), (2, 1.0, True), (3, 1.0, True), (4, 2.0, True), (5, 3.0, False)
    }


def test_region_fact_emptied_stays_empty_unless_guarded(spark, tmp_path):
    provinces, daily = spark.createDataFrame(OLD, DIM), _daily(spark, D[:3], 1.0)
    table = _table(spark, tmp_path / "r", ["weather_date"], REGION_FACT_SCHEMA)
    table.overwrite(marts.region_mart_rows(daily, provinces).limit(0))
    assert table.exists() and table.max_of("weather_date") is None
    assert marts.refresh_region_mart(daily, provinces, table).count() == 0
    assert marts.refresh_region_mart(daily, provinces, table, guard_empty=True).count() == 3


def test_daily_fact_emptied_takes_everything(spark, tmp_path):
    provinces, daily = spark.createDataFrame(OLD, DIM), _daily(spark, D[:3], 1.0)
    table = _table(spark, tmp_path / "d", ["weather_date"], DAILY_FACT_SCHEMA)
    marts.refresh_daily_mart(daily.limit(0), provinces, table)
    out = marts.refresh_daily_mart(daily, provinces, table).collect()
    assert len(out) == 6 and all(r.is_new_row for r in out)


def test_null_partition_is_kept_and_updated(spark, tmp_path):
    table = _table(spark, tmp_path / "f")
    table.overwrite(_facts(spark, [(1, None, 1.0, "old"), (2, None, 1.0, "old"), (1, D[0], 1.0, "old")]))
    for _ in range(2):
        out = table.upsert(_facts(spark, [(1, None, 5.0, "new")]), ["k", "day"])
        assert {(r.k, r.day, r.v) for r in out.collect()} == {(1, None, 5.0), (2, None, 1.0), (1, D[0], 1.0)} and out.count() == 3
    assert table.upsert(_facts(spark, [(None, D[0], 2.0, "x")]), ["k", "day"]).count() == 4
    assert table.upsert(_facts(spark, [(None, D[0], 3.0, "x")]), ["k", "day"]).count() == 4  # a NULL key equals itself


def test_partition_values_stay_text(spark, tmp_path):
    table = _table(spark, tmp_path / "v", ["space"], "id string, space string, v int")
    rows = lambda *r: spark.createDataFrame(r, "id string, space string, v int")
    table.overwrite(rows(("a", "007", 1), ("b", "010", 1), ("c", "7", 1)))
    out = table.upsert(rows(("a", "007", 2)), ["id", "space"])
    assert {tuple(r) for r in out.select("id", "space", "v").collect()} == {("a", "007", 2), ("b", "010", 1), ("c", "7", 1)}


def test_a_table_exists_without_its_marker(spark, tmp_path):
    table = _table(spark, tmp_path / "f")
    assert not table.exists()
    table.overwrite(_facts(spark, [(1, D[0], 1.0, "a"), (2, D[1], 1.0, "a")]))
    for marker in (tmp_path / "f").glob("*_SUCCESS*"):
        marker.unlink()
    assert table.upsert(_facts(spark, [(3, D[1], 1.0, "b")]), ["k", "day"]).count() == 3


def test_a_run_that_ended_amid_the_replacement_is_finished(spark, tmp_path):
    table = _table(spark, tmp_path / "f")
    table.overwrite(_facts(spark, [(1, D[0], 1.0, "old"), (2, D[1], 1.0, "old")]))
    # The new partition is complete beside the table, the old one is gone already.
    table._write(_facts(spark, [(2, D[1], 1.0, "old"), (3, D[1], 2.0, "new")]), table.pending, "static")
    for part in (tmp_path / "f" / f"day={D[1]}").iterdir():
        part.unlink()
    out = table.upsert(_facts(spark, [(4, D[0], 4.0, "later")]), ["k", "day"])
    assert {(r.k, r.v) for r in out.collect()} == {(1, 1.0), (2, 1.0), (3, 2.0), (4, 4.0)}
    table._write(_facts(spark, [(9, D[1], 9.0, "half")]), table.pending, "static")
    (tmp_path / "f-pending" / "_SUCCESS").unlink()  # a copy that was never complete is forgotten
    assert table.upsert(_facts(spark, [(4, D[0], 4.0, "later")]), ["k", "day"]).count() == 4
    assert not (tmp_path / "f-pending").exists()


def test_merge_reads_the_touched_partitions_only(spark, tmp_path):
    table = _table(spark, tmp_path / "f")
    table.overwrite(_facts(spark, [(1, d, 1.0, "a") for d in D]))
    plan = table.touched(_facts(spark, [(1, D[3], 1.0, "a"), (1, D[4], 1.0, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert f"(day#" in plan and ">= " + str(D[3]) in plan and "<= " + str(D[4]) in plan.split("PartitionFilters")[1]


def test_districts_notice_their_local_name(spark, tmp_path):
    schema = "district_id int, province_id int, district_name string, district_name_vn string, latitude double, longitude double"
    old = [(1, 1, "A", "a", 1.0, 1.0), (2, 1, "B", "b", 1.0, 1.0), (3, 1, "C", "c", 1.0, 1.0)]
    new = [(1, 1, "A", "a", 1.0, 1.0), (2, 1, "B", "b2", 1.0, 1.0), (3, 1, "C2", "c", 1.0, 1.0), (4, 1, "D", "d", 1.0, 1.0)]
    stamped = lambda rows, at: spark.createDataFrame(rows, schema).withColumns({c: F.lit(at).cast("timestamp") for c in ("created_at", "updated_at")})
    table = VersionedTable(spark, str(tmp_path / "dim"))
    marts.refresh_dimension(stamped(old, "2024-01-01"), table, marts.DISTRICTS)
    rows = {r.district_id: r for r in marts.refresh_dimension(stamped(new, "2024-02-01"), table, marts.DISTRICTS).collect()}
    assert [rows[i].district_name_vn for i in (1, 2, 3, 4)] == ["a", "b2", "c", "d"]
    assert [(rows[i].created_at.month, rows[i].updated_at.month) for i in (1, 2, 3, 4)] == [(1, 1), (1, 2), (1, 2), (2, 2)]
