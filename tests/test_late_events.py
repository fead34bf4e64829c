"""Streams over files that are not in time order and span a long period."""

import datetime as dt
import random

import pytest

import __spark_entry__ as entry_point
from oracle import connect, differences

TABLES = "region nation customer supplier part orders lineitem documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Events of 100 days, old and new ones in each of 24 files; the other tables are the given ones."""
    root, rng = tmp_path_factory.mktemp("late"), random.Random(3)
    days = [*range(100)] * 3
    rng.shuffle(days)
    rows = [(i, dt.datetime(2024, 1, 1, 1 + i % 20, i % 60) + dt.timedelta(days=day), i % 40, "click", float(i % 90), f'{{"k": {i % 100}}}') for i, day in enumerate(days)]
    shape = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, shape).repartition(24).write.parquet(f"{root}/events.parquet")
    for table in TABLES:
        (root / f"{table}.parquet").symlink_to(f"/root/testdata/sf0.001/{table}.parquet")
    return str(root)


@pytest.mark.parametrize("name", ["stream_daily", "stream_dedup"])
def test_no_event_is_late(spark, folder, name):
    spark.conf.set("spark.sql.files.minPartitionNum", "24")
    try:
        found = entry_point.queries()[name](spark, folder)
        con = connect("/root/testdata/sf0.001")
        con.execute(f"create or replace view events as select * from read_parquet('{folder}/events.parquet/*.parquet')")
        assert differences(found, con, entry_point.oracle_sql()[name]) is None
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
