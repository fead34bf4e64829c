"""Line dedup against brute force; the filters; reversibility."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from stationflow.llm.common import U64
from stationflow.llm.line_dedup import CuckooFilter, LineIndex, _key_hash, line_key
from stationflow.llm.queries import QUERIES

SPACES = " \t\n\x0b\x0c\r"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(SPACES).translate(UPPER)


def brute(rows, min_docs=3, least=20):
    """(doc_id, n_lines, n_dropped, kept text) of each row of (doc_id, text)."""
    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least and doc_id is not None:
                holders[key(line)].add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < min_docs or max(holders[key(x)]) == doc_id]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


SHARED = ["All rights are reserved here.", "  all RIGHTS are reserved here.\t", "short line", "Ünïcode line of twenty or more", "a line that only two documents hold"]


def shared_rows():
    rows = [(i, "\n".join([f"own line number {i} of this document", *SHARED[: i % 6], "", f"tail {i}"])) for i in range(1, 40)]
    rows += [(50, SHARED[4]), (51, SHARED[4]), (None, SHARED[0]), (52, None), (53, ""), (54, f"{SHARED[0]}\n{SHARED[1]}\n{SHARED[0]}")]
    return rows + [(60, SHARED[3]), (60, SHARED[3])]


def check(frame, rows):
    got = Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in frame.collect())
    assert got == Counter(brute(rows))


def test_keys_hash_alike_in_spark_and_python(spark):
    lines = ["  AbC dÉ\t\x0b", "", "x" * 300, "ẞ \x1c", "\xa0 y"]
    k = line_key(F.col("x"))
    rows = spark.createDataFrame([(x,) for x in lines], "x string").select(F.xxhash64(k), F.xxhash64(F.concat(k, F.lit("\0")))).collect()
    assert [tuple(r) for r in rows] == [_key_hash(x.encode()) for x in lines]


def test_equals_brute_force(spark):
    rows = shared_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    index = LineIndex.build(docs, F.col("doc_id"), F.col("text"), shards=4)
    check(index.clean(docs), rows)


@pytest.mark.parametrize("kind", ["odd", "more"])
def test_query_on_odd_documents(spark, folder, odd_rows, kind):
    rows = QUERIES["op2_line_dedup"](spark, f"{folder}/{kind}").collect()
    want = Counter((d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in brute([r[:2] for r in odd_rows]))
    assert Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in rows) == want


def test_nothing(spark, folder):
    assert QUERIES["op2_line_dedup"](spark, f"{folder}/none").count() == 0


def table(frame):
    return sorted(map(str, frame.select(*sorted(frame.columns)).collect()))


def test_deletion_takes_an_insertion_back(spark):
    rows = shared_rows()
    schema = "doc_id long, text string"
    old, new = spark.createDataFrame(rows[:20], schema), spark.createDataFrame(rows[20:], schema)
    index = LineIndex.build(old, F.col("doc_id"), F.col("text"), shards=4)
    grown = index.insert(new, F.col("doc_id"), F.col("text"))
    check(grown.clean(old.unionByName(new)), rows)
    assert table(grown.insert(new, F.col("doc_id"), F.col("text")).counts) == table(grown.counts)  # again: nothing new
    gone = grown.delete(new.join(old.select("doc_id"), "doc_id", "left_anti"))
    assert table(gone.counts) == table(index.counts)
    check(gone.clean(old), rows[:20])
    hashes = {r["k1"] for r in index.counts.where("n_docs >= 3").collect()}
    filters = {r["shard"]: CuckooFilter.from_bytes(r["filter"]) for r in gone.filters.collect()}
    for k in hashes:
        assert filters[k % 4].contains(np.array([k], np.int64).view(U64)).all()


@settings(max_examples=30, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=3000), st.integers(0, 5))
def test_filter_never_misses(members, part):
    members = np.array(sorted(members), U64)
    held = CuckooFilter.holding(members)
    assert held.contains(members).all()
    gone = members[part::6]
    held.delete(gone)
    assert held.contains(np.setdiff1d(members, gone)).all()
    assert held.insert(gone) and held.contains(members).all()


def test_filter_rarely_lets_strangers_pass():
    rng = np.random.default_rng(1)
    held = CuckooFilter.holding(rng.integers(0, 2**63, 50_000).astype(U64))
    assert held.contains(rng.integers(0, 2**63, 100_000).astype(U64) + U64(1 << 63)).mean() < 1e-3


def test_wide_ids_beside_a_missing_one(spark):
    """Ids that no double holds stay what they are, though a row of the same lines has none."""
    rows = [(2**60 + i, f"{SHARED[0]}\nmine {i}") for i in (1, 3, 5)] + [(None, SHARED[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check(LineIndex.build(docs, F.col("doc_id"), F.col("text"), shards=1).clean(docs), rows)


def test_an_index_starts_no_workers_for_what_is_empty(spark, monkeypatch):
    """Executors would hold them beside those of the operators."""
    rows = shared_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(type(spark), "createDataFrame", None)
    check(LineIndex.build(docs, F.col("doc_id"), F.col("text"), shards=4).clean(docs), rows)
