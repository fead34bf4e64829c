import datetime as dt
import itertools
import math

import pytest
from pyspark.sql import functions as F

from stationflow.operators.partials import Kept
from stationflow.sources.states import StateTable
from stationflow.sources.tables import PartitionedTable

D = [None, *(dt.date(2024, 1, d) for d in range(1, 4))]
ROWS = "place string, day date, v double"
MEASURES = {"mean": "average", "total": "sum", "top": "max", "low": "min", "n": "count"}
BATCHES = [
    [("a", D[1], 1.0), ("a", D[1], None), ("b", D[2], 4.0), (None, D[1], 9.0)],
    [("a", D[1], 6.0), ("a", D[0], 2.0), ("b", D[3], None), ("c", D[2], -1.0)],
    [("a", D[1], 0.5), ("b", D[2], 4.0), ("b", D[2], 4.0), (None, D[1], 1.0), ("c", D[0], 3.0)],
]


def expected(batches):
    groups = {}
    for place, day, v in itertools.chain(*batches):
        groups.setdefault((place, day), []).extend([] if v is None else [v])
    return {
        (*key, sum(v) / len(v) if v else None, math.fsum(v) if v else None, max(v, default=None), min(v, default=None), len(v))
        for key, v in groups.items()
    }


def frame(spark, rows):
    return spark.createDataFrame(rows, ROWS)


def states(spark, path):
    return StateTable(spark, str(path), ["place"], "day", {name: Kept(kind, F.col("v")) for name, kind in MEASURES.items()}, frame(spark, []))


def held(df):
    return {tuple(r) for r in df.select("place", "day", *MEASURES).collect()}


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1, 0)])
def test_batches_add_up_in_any_order_and_replays_change_nothing(spark, tmp_path, order):
    table = states(spark, tmp_path / "s")
    for batch in order:
        days = table.add(frame(spark, BATCHES[batch]), batch)
    assert held(table.finished()) == expected(BATCHES)
    touched = {day for _, day, _ in BATCHES[order[-1]]}
    assert held(days) == {r for r in expected(BATCHES) if r[1] in touched}  # whole days, of all places
    assert all(f"{tmp_path}/s/" in name for name in days.inputFiles() if "/states-" not in name)


def test_only_days_of_the_batch_are_rewritten(spark, tmp_path):
    table = states(spark, tmp_path / "s")
    table.add(frame(spark, BATCHES[0]), 0)
    before = sorted(p.name for p in (tmp_path / "s" / "day=2024-01-02").iterdir())
    table.add(frame(spark, [("a", D[1], 8.0)]), 1)
    assert before == sorted(p.name for p in (tmp_path / "s" / "day=2024-01-02").iterdir())


def test_fold_keeps_the_sums_and_closes_its_batches(spark, tmp_path):
    table = states(spark, tmp_path / "s")
    table.fold(3)  # nothing there yet
    for batch in (0, 1):
        table.add(frame(spark, BATCHES[batch]), batch)
    table.fold(2)
    assert table.table.read().count() == len(expected(BATCHES[:2]))
    assert held(table.finished()) == expected(BATCHES[:2])
    with pytest.raises(ValueError):
        table.add(frame(spark, BATCHES[1]), 1)
    for _ in range(2):
        table.add(frame(spark, BATCHES[2]), 2)
    assert held(table.finished()) == expected(BATCHES)
    table.fold(3)
    table.fold(3)
    assert held(table.finished()) == expected(BATCHES) and table.folded_before() == 3


def test_an_empty_batch(spark, tmp_path):
    table = states(spark, tmp_path / "s")
    assert table.add(frame(spark, []), 0).count() == 0
    table.add(frame(spark, BATCHES[0]), 1)
    assert table.add(frame(spark, []), 2).count() == 0
    assert held(table.finished()) == expected(BATCHES[:1])


def test_a_reader_sees_the_complete_copy_and_writes_nothing(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "t"), ["day"], ROWS)
    assert not table.exists()
    table.overwrite(frame(spark, [("a", D[1], 1.0), ("b", D[2], 2.0), ("c", D[0], 3.0)]))
    # A run that ended after its copy was complete, with one partition not yet replaced.
    table._write(frame(spark, [("a", D[1], 10.0), ("c", D[0], 30.0)]), table.pending, "static")
    files = sorted(tmp_path.rglob("*"))
    want = {("a", D[1], 10.0), ("b", D[2], 2.0), ("c", D[0], 30.0)}
    assert table.exists() and {tuple(r) for r in table.read().select("place", "day", "v").collect()} == want
    assert table.max_of("v") == 30.0
    assert sorted(tmp_path.rglob("*")) == files
    out = table.upsert(frame(spark, [("d", D[3], 4.0)]), ["place", "day"])
    assert {tuple(r) for r in out.select("place", "day", "v").collect()} == want | {("d", D[3], 4.0)}
    assert not (tmp_path / "t-pending").exists()
