"""Exact vector search by tiles around pivots against brute force, and what it skips."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationflow.operators import vectors as vec

SHAPE = "{} long, embedding array<double>"


def frame(spark, key, rows):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], SHAPE.format(key))


def brute(queries, vectors, k):
    unit = lambda v: v / (np.linalg.norm(v) or 1)
    out = set()
    for query_id, q in queries:
        scored = sorted((-round(float(unit(q) @ unit(v)), 9), i) for i, v in vectors if len(v) == len(q))
        out |= {(query_id, i, rank, -score + 0.0) for rank, (score, i) in enumerate(scored[:k], 1)}
    return out


def rows_of(found):
    return {(r.query_id, r.vec_id, r["rank"], r.score + 0.0) for r in found.collect()}


def clustered(rng, n, dims=12, clusters=40):
    centres = rng.normal(size=(clusters, dims))
    return [(i, centres[rng.integers(clusters)] + 0.05 * rng.normal(size=dims)) for i in range(n)]


def near(rng, vectors, n):
    return [(i, vectors[int(rng.integers(len(vectors)))][1] + 0.05 * rng.normal(size=len(vectors[0][1]))) for i in range(n)]


def test_clustered_vectors_are_mostly_skipped(spark):
    rng = np.random.default_rng(1)
    vectors = clustered(rng, 4000)
    queries = near(rng, vectors, 60)
    v, q = frame(spark, "vec_id", vectors), frame(spark, "query_id", queries)
    tiled = vec.TiledVectors(v, len(vectors), tile=64)
    assert tiled.shells.tiles.max() >= 1 and len(tiled.shells.pivots[12]) == 62
    first = tiled.scored(tiled.visits(q), 3)
    least = first.groupBy("query_id").agg(F.min("score").alias("least"), F.count("*").alias("n")).where("n = 3").drop("n")
    visited = tiled.visits(q, least).select(F.explode("places").alias("p")).agg(F.sum(F.col("p.tiles") - F.col("p.first"))).first()[0] or 0
    everything = len(queries) * int(tiled.shells.tiles.sum())
    assert visited < everything / 5
    assert rows_of(vec.vector_topk(q, v, 3, tile=64)) == brute(queries, vectors, 3)


@pytest.mark.parametrize("k", [1, 5, 200])
def test_any_vectors_equal_brute_force(spark, k):
    rng = np.random.default_rng(2)
    vectors = [(i, rng.normal(size=6)) for i in range(500)] + [(900 + i, np.zeros(6)) for i in range(3)]
    vectors += [(1000 + i, vectors[i][1]) for i in range(40)] + [(2000, -vectors[0][1]), (2001, 1e-9 * vectors[1][1])]
    vectors += [(3000 + i, rng.normal(size=4)) for i in range(5)]
    queries = [(i, rng.normal(size=6)) for i in range(12)] + [(50, vectors[3][1]), (51, np.zeros(6)), (52, rng.normal(size=4)), (53, rng.normal(size=9))]
    v, q = frame(spark, "vec_id", vectors).repartition(4), frame(spark, "query_id", queries)
    assert rows_of(vec.vector_topk(q, v, k, tile=50)) == brute(queries, vectors, k)


def test_one_direction_with_most_vectors_is_many_tiles(spark):
    rng = np.random.default_rng(3)
    hot = rng.normal(size=5)
    vectors = [(i, hot) for i in range(600)] + [(600 + i, rng.normal(size=5)) for i in range(400)]
    v, q = frame(spark, "vec_id", vectors), frame(spark, "query_id", [(1, hot), (2, -hot)])
    tiled = vec.TiledVectors(v, len(vectors), tile=40)
    sizes = [r["count"] for r in tiled.rows.groupBy("shell", "tile").count().collect()]
    assert sum(sizes) == 1000 and max(sizes) < 120
    assert rows_of(vec.vector_topk(q, v, 4, tile=40)) == brute([(1, hot), (2, -hot)], vectors, 4)


def test_repeated_queries_and_many_queries_of_one_tile(spark, monkeypatch):
    monkeypatch.setattr(vec, "TILE_QUERIES", 4)
    rng = np.random.default_rng(4)
    vectors = clustered(rng, 300, clusters=3)
    queries = near(rng, vectors[:10], 50)
    v, q = frame(spark, "vec_id", vectors), frame(spark, "query_id", queries)
    assert rows_of(vec.vector_topk(q, v, 2, tile=32)) == brute(queries, vectors, 2)
    assert rows_of(vec.vector_topk(q, v, 2)) == brute(queries, vectors, 2)


def test_shell_bounds_hold_for_every_vector():
    rng = np.random.default_rng(5)
    for dims in (2, 3, 30):
        vectors, pivots, queries = (vec._unit(rng.normal(size=(n, dims))) for n in (200, 7, 50))
        angles = vec._angles(vectors, pivots)
        cell = angles.argmin(axis=1)
        own = [angles[cell == c, c] for c in range(7)]
        kept = [c for c in range(7) if len(own[c])]
        shells = vec.Shells({dims: pivots}, np.full(len(kept), dims), np.array(kept), np.array([own[c].min() for c in kept]), np.array([own[c].max() for c in kept]), np.ones(len(kept), int))
        held, bounds = shells.bounds(queries)
        for i, c in enumerate(kept):
            best = (queries @ vectors[cell == c].T).max(axis=1)
            assert (bounds[:, i] >= best - vec.SLACK).all()
