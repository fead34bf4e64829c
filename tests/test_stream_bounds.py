"""What a trigger costs besides its rows: its number and that of the state's partitions are bounded."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stationflow.sources.tables import PartitionedTable
from stationflow.streaming.ingest import run_to_end, settings, start
from stationflow.streaming.serving import stream_daily
from stationflow.workload import QUERIES, queries_streaming, queries_tables
from stationflow.workload.queries_streaming import batch_files
from test_stream_latest import SCHEMA, Job, at


@pytest.fixture
def many_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def partitions(checkpoint):
    return sum(p.name.isdigit() for p in (Path(checkpoint) / "state" / "0").iterdir())


def test_state_has_no_more_partitions_than_cores(spark, tmp_path, many_partitions):
    job = Job(spark, str(tmp_path))
    job.land([("A", at(1), 1.0, "x"), ("B", at(1), 5.0, "y")])
    assert job.run()[0] == {("A", at(1), 1.0, "x"), ("B", at(1), 5.0, "y")}
    assert partitions(tmp_path / "offsets") == spark.sparkContext.defaultParallelism < 40
    assert spark.conf.get("spark.sql.shuffle.partitions") == "40"


def test_the_daily_merge_has_no_more_tasks_a_stage_than_cores(spark, tmp_path, many_partitions):
    """Each task of a trigger sends its metrics to the driver."""
    Job(spark, str(tmp_path)).land([("A", at(1), 1.0, "x"), ("B", at(2), 5.0, "y")])
    rows = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")
    table = PartitionedTable(spark, str(tmp_path / "t"), ["weather_date"], "station string, n long, weather_date date")
    query = stream_daily(rows, table, ["station"], "at", {"n": F.count("*")}, str(tmp_path / "o"))
    run_to_end(query)
    tracker, sizes = spark.sparkContext.statusTracker(), []
    for job in tracker.getJobIdsForGroup(query.runId):
        stages = [tracker.getStageInfo(stage) for stage in tracker.getJobInfo(job).stageIds]
        sizes += [stage.numTasks for stage in stages if stage]
    assert sizes and max(sizes) <= spark.sparkContext.defaultParallelism
    assert {(r.station, r.n) for r in table.read().collect()} == {("A", 1), ("B", 1)}


def test_a_given_number_of_partitions_is_kept(spark, tmp_path, many_partitions):
    Job(spark, str(tmp_path)).land([("A", at(1), 1.0, "x")])
    stations = spark.readStream.schema("station string").parquet(f"{tmp_path}/in").groupBy("station").count()
    run_to_end(start(stations, lambda batch, n: batch.collect(), str(tmp_path / "o"), output_mode="update", partitions=20))
    assert partitions(tmp_path / "o") == 20


def test_triggers_are_few_and_their_files_bounded(spark, tmp_path):
    most = 8 * spark.sparkContext.defaultParallelism
    found = {}
    for landed in range(10 * most + 1):
        if landed in (0, 5, 40, 4 * most, 10 * most):
            (tmp_path / "_SUCCESS").touch()
            found[landed] = batch_files(spark, str(tmp_path))
        (tmp_path / f"part-{landed:05d}.txt.gz").touch()
    assert found == {0: 8, 5: 8, 40: 8, 4 * most: most // 2, 10 * most: most}


@pytest.fixture
def small_files(spark, tmp_path, monkeypatch):
    """Landed files of 100 messages, which a reader would put together; what a query writes is in ``tmp_path``."""
    for module in (queries_tables, queries_streaming):
        monkeypatch.setattr(module, "FILE_MESSAGES", 100)
        monkeypatch.setattr(module, "scratch_path", lambda spark, label: f"{tmp_path}/{label}-0")
    with settings(spark, {"spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}):
        yield tmp_path


def files_of(spark, folder):
    topic = spark.read.text([str(p) for p in folder.glob("topic-*")])
    return [r["count"] for r in topic.groupBy(F.input_file_name()).count().collect()]


def test_repeats_land_in_bounded_files_and_their_keys_on_disk(spark, small_files):
    assert QUERIES["stream_dedup"](spark, "/root/testdata/sf0.001").count() == 1000
    assert files_of(spark, small_files) == [100] * 20
    state = {p.suffix for folder in small_files.glob("offsets-*") for p in (folder / "state").rglob("*") if p.is_file()}
    assert ".changelog" in state and ".delta" not in state


def triggers(checkpoint):
    return sum(p.name.isdigit() for p in (Path(checkpoint) / "commits").iterdir())


def test_many_files_are_ingested_in_few_triggers(spark, small_files, monkeypatch):
    monkeypatch.setattr(queries_tables, "FILE_MESSAGES", 10)
    assert QUERIES["stream_ingest"](spark, "/root/testdata/sf0.001").count() == 1000
    assert len(files_of(spark, small_files)) == 225
    assert triggers(small_files / "offsets-0") == 9  # 28 files each


def test_micro_batches_are_several_and_few(spark, small_files, monkeypatch):
    monkeypatch.setattr(queries_streaming, "FILE_MESSAGES", 10)
    assert tuple(QUERIES["micro_batch"](spark, "/root/testdata/sf0.001").first()) == (1000, True, True, 0)
    assert triggers(small_files / "offsets-0") == 9  # 100 files, 12 each


def test_two_files_are_two_batches(spark, small_files, monkeypatch):
    monkeypatch.setattr(queries_streaming, "FILE_MESSAGES", 500)
    assert tuple(QUERIES["micro_batch"](spark, "/root/testdata/sf0.001").first()) == (1000, True, True, 0)
    assert triggers(small_files / "offsets-0") == 2
