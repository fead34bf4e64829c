"""Near-duplicate classes against brute force, signatures against exact similarities."""

import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from stationflow.llm.common import U64, mix
from stationflow.llm.components import components
from stationflow.llm.near_dedup import near_duplicates, prob_minhash
from stationflow.llm.queries import QUERIES


def grams(text):
    w = (text or "").lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def classes(links, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(rows):
    """The class of each (doc_id, text); ids are unique and not null."""
    sets = {i: grams(t) for i, t in rows if t is not None}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if not sets[a] and not sets[b] or sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    return classes(links, [i for i, _ in rows])


def edited(words, rng, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def copies():
    """Groups whose members are edited little to much, a chain, exact copies, a shared passage."""
    rng, rows = random.Random(4), []
    passage = " ".join(f"shared{i}" for i in range(40))
    for g in range(6):
        base = [f"w{g}x{rng.randrange(3000)}" for _ in range(150)]
        rows += [edited(base, rng, e) for e in (0, 0, 1, 2, 3, 4, 5, 6, 8, 12, 20, 40)]
    link = [f"c{i}" for i in range(200)]
    for _ in range(12):  # each like the one before it, the last unlike the first
        rows.append(" ".join(link))
        link = link[6:] + [f"c{rng.randrange(10**6)}" for _ in range(6)]
    rows += [passage + " " + " ".join(f"p{k}x{rng.randrange(9000)}" for _ in range(60)) for k in range(40)]
    rows += ["one two", "One  Two", "one two three four five", "", "  ", None, None]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_classes_equal_brute_force(spark, copies):
    docs = spark.createDataFrame(copies, "id long, body string")
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates(docs, F.col("id"), F.col("body")).collect()}
    assert got == brute(copies)


def test_a_line_repeated_in_one_text_only(spark):
    """Sets that are 0.8 to 0.9 similar, though the weights of the counts are far apart."""
    rng, rows = random.Random(9), []
    for g in range(60):
        words, line, times = [(150, 20, 1000), (200, 30, 2000), (120, 10, 300)][g % 3]
        base = [f"r{g}x{i}" for i in range(words)]
        extra = [f"l{g}x{rng.randrange(10**6)}" for _ in range(line)]
        rows += [" ".join(base), " ".join(base + extra * times)]
    rows = list(enumerate(rows))
    similar = [len(grams(a) & grams(b)) / len(grams(a) | grams(b)) for (_, a), (_, b) in zip(rows[::2], rows[1::2])]
    assert 0.8 <= min(similar) and max(similar) < 0.9
    docs = spark.createDataFrame(rows, "id long, body string")
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates(docs, F.col("id"), F.col("body")).collect()}
    assert got == brute(rows) == {i: i - i % 2 for i, _ in rows}


def test_small_corpus_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: r["class_id"] for r in QUERIES["op5_near_dedup"](spark, folder).collect()}
    assert got == brute(rows)


@pytest.mark.parametrize("kind", ["odd", "more"])
def test_odd_documents(spark, folder, odd_rows, kind):
    rows = QUERIES["op5_near_dedup"](spark, f"{folder}/{kind}").collect()
    assert len(rows) == len(odd_rows)
    found = defaultdict(set)
    for r in rows:
        found[r["doc_id"]].add(r["class_id"])
    assert found[1] == {1}  # null text: alone
    assert found[2] == found[3] == {2}  # no words: copies
    assert found[4] == found[5] == {4}
    assert found[None] == {None}
    assert all(found[i] == {i} for i in (6, 7, 8, 9, *range(100, 125)))


def test_nothing(spark, folder):
    assert QUERIES["op5_near_dedup"](spark, f"{folder}/none").count() == 0


def test_signatures_estimate_probability_jaccard():
    rng = np.random.default_rng(3)
    ids = mix(np.arange(1, 301, dtype=U64))
    x, y = rng.integers(1, 6, 300).astype(float), rng.integers(1, 6, 300).astype(float)
    x[:60], y[240:] = 0, 0
    both = (x > 0) & (y > 0)
    exact = sum(1 / np.maximum(x / x[i], y / y[i]).sum() for i in np.flatnonzero(both))
    a, b = (prob_minhash(ids[w > 0], np.zeros((w > 0).sum(), np.int64), w[w > 0], 1, 2048) for w in (x, y))
    assert abs((a == b).mean() - exact) < 4 * np.sqrt(exact * (1 - exact) / 2048)
    same = prob_minhash(ids[x > 0], np.zeros((x > 0).sum(), np.int64), 7 * x[x > 0], 1, 2048)
    assert (a == same).all()  # only shares of the weight count


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 40)), max_size=40))
def test_components(spark_session_of, links):
    nodes = {n for pair in links for n in pair if pair[0] != pair[1]}
    want = {n: r for n, r in classes([p for p in links if p[0] != p[1]], nodes).items() if n != r}
    frame = spark_session_of.createDataFrame(links, "a long, b long")
    assert {r["node"]: r["root"] for r in components(frame).collect()} == want


@pytest.fixture(scope="module")
def spark_session_of(spark):
    return spark


def test_a_long_path_is_one_component(spark):
    links = spark.range(60).selectExpr("id as a", "id + 1 as b")
    assert {r["root"] for r in components(links).collect()} == {0}
