"""The latest row per key from keyed state, and the log of changes it is kept in."""

import datetime as dt
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stationflow.operators.windows import latest_per_key
from stationflow.sources.changelog import ChangeLog
from stationflow.streaming.ingest import run_to_end
from stationflow.streaming.latest import STATE_STORE, ahead, first_per_key, stream_latest

SCHEMA = "station string, at timestamp_ntz, temp double, note string"
ORDER = [("at", True), ("temp", False)]


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


class Job:
    """A folder that rows land in, and the stream over it."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.log = ChangeLog(spark, f"{root}/log", ["station"], SCHEMA)
        self.landed = 0

    def land(self, rows):
        self.landed += 1
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.root}/in")

    def run(self, **options):
        stream = self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{self.root}/in")
        query = run_to_end(stream_latest(stream, self.log, ORDER, f"{self.root}/offsets", **options))
        return {tuple(r) for r in self.log.read().collect()}, query

    def written(self, batch):
        return {r.station for r in self.spark.read.parquet(f"{self.root}/log/batch-{batch:012d}").collect()}


@pytest.fixture
def job(spark, tmp_path):
    return Job(spark, str(tmp_path))


def test_a_row_is_replaced_only_by_a_newer_one(job, spark):
    job.land([("A", at(1), 1.0, None), ("B", at(1), 5.0, "b"), (None, at(1), 2.0, "no name")])
    first = {("A", at(1), 1.0, None), ("B", at(1), 5.0, "b"), (None, at(1), 2.0, "no name")}
    assert job.run()[0] == first
    job.land([("A", at(2), 2.0, "new"), ("B", at(1), 9.0, "older by order"), ("B", None, 1.0, "no time")])
    second = first - {("A", at(1), 1.0, None)} | {("A", at(2), 2.0, "new")}
    assert job.run()[0] == second
    assert job.written(1) == {"A"}  # only what changed is written
    found, query = job.run()
    assert found == second and query.lastProgress is None or query.lastProgress["numInputRows"] == 0
    assert all(spark.conf.get(k, None) != v for k, v in STATE_STORE.items())


def test_a_replayed_batch_changes_nothing(job):
    job.land([("A", at(1), 1.0, "x"), ("B", at(1), 1.0, "y")])
    job.land([("A", at(3), 1.0, "z")])
    before, _ = job.run()
    # The last batch ran, but its commit was lost: it runs again from the state before it.
    commits = Path(job.root) / "offsets" / "commits"
    last = sorted(p.name for p in commits.iterdir() if p.name.isdigit())[-1]
    for name in (last, f".{last}.crc"):
        (commits / name).unlink(missing_ok=True)
    job.land([("B", at(2), 1.0, "w")])
    after, _ = job.run()
    assert before == {("A", at(3), 1.0, "z"), ("B", at(1), 1.0, "y")}
    assert after == {("A", at(3), 1.0, "z"), ("B", at(2), 1.0, "w")}


def test_random_batches_equal_the_batch_result(job, spark):
    rng = random.Random(4)
    rows = [(rng.choice(["A", "B", "C", None]), rng.choice([None, at(1), at(2, rng.randrange(5))]), rng.choice([None, float("nan"), -1.0, 2.0]), f"{i}") for i in range(120)]
    for i in range(0, 120, 30):
        job.land(rows[i : i + 30])
    found = {r[:2] + (repr(r[2]),) for r in job.run(compact_every=2)[0]}
    expected = latest_per_key(spark.createDataFrame(rows, SCHEMA), ["station"], [F.desc("at"), F.asc("temp")]).collect()
    assert found == {(r.station, r["at"], repr(r.temp)) for r in expected}


def test_order_of_nulls_and_nans_is_that_of_sql(spark):
    values = [None, float("nan"), float("inf"), 1.0, -1.0, float("-inf")]
    for descending in (True, False):
        df = spark.createDataFrame([(1, v) for v in values], "k int, v double")
        sql_first = [r.v for r in df.orderBy(F.desc("v") if descending else F.asc("v")).collect()]
        for i, a in enumerate(sql_first):
            assert not ahead((a,), (a,), [(0, descending)])
            for b in sql_first[i + 1 :]:
                assert ahead((a,), (b,), [(0, descending)]) and not ahead((b,), (a,), [(0, descending)])
        (picked,) = first_per_key(df.coalesce(1), ["k"], [("v", descending)]).collect()
        assert repr(picked.v) == repr(sql_first[0])


def test_a_busy_key_is_cut_before_the_shuffle(spark):
    rows = spark.range(50_000).selectExpr("if(id % 3 = 0, 'hot', concat('s', id % 50)) as k", "id as v").coalesce(2)
    cut = first_per_key(rows, ["k"], [("v", True)])
    assert cut.count() <= 51 * (50_000 // int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) + 2)
    assert cut.groupBy("k").agg(F.max("v")).count() == 51
    assert cut.agg(F.max("v")).first()[0] == 49_999


def test_silent_stations_leave(job):
    day = 86_400_000
    job.land([("A", at(1), 1.0, "a"), ("B", at(1), 1.0, "b")])
    job.land([("A", at(4), 1.0, "a4")])
    job.land([("A", at(9), 1.0, "a9")])
    job.land([("A", at(10), 1.0, "a10")])
    found, _ = job.run(ts="at", silent_after_ms=3 * day, delay="1 day")
    assert found == {("A", at(10), 1.0, "a10")}
    job.land([("B", at(10), 2.0, "back")])
    assert job.run(ts="at", silent_after_ms=3 * day, delay="1 day")[0] == {("A", at(10), 1.0, "a10"), ("B", at(10), 2.0, "back")}
    with pytest.raises(ValueError):
        job.run(silent_after_ms=1)


def test_compaction_keeps_what_counts(job, spark):
    rows = lambda *r: spark.createDataFrame(r, SCHEMA + ", gone boolean")
    log = job.log
    assert log.read().collect() == []
    log.append(rows(("A", at(1), 1.0, "a", False), ("B", at(1), 1.0, "b", False)), 0)
    log.append(rows(("A", at(2), 1.0, "a2", False), ("C", at(2), 1.0, "c", False)), 1)
    log.append(rows(("B", at(1), 1.0, "b", True)), 2)
    expected = {("A", at(2), 1.0, "a2"), ("C", at(2), 1.0, "c")}
    reader = log.read()
    log.compact()
    assert {tuple(r) for r in log.read().collect()} == expected == {tuple(r) for r in reader.collect()}
    log.append(rows(("B", at(3), 3.0, "b3", False)), 3)
    assert {tuple(r) for r in log.read().collect()} == expected | {("B", at(3), 3.0, "b3")}
    log.append(rows(("C", at(2), 1.0, "c", True)), 4)
    log.compact()
    assert log.expire(dt.timedelta(days=1)) == 0
    assert log.expire(dt.timedelta(0)) == 6  # five batches and the first base
    assert {tuple(r) for r in log.read().collect()} == {("A", at(2), 1.0, "a2"), ("B", at(3), 3.0, "b3")}
