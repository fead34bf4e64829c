"""Exact vector top-k by cosine: tiles around pivots, skipped where no vector can reach a query's best."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from stationflow.session import durable

# Vectors and queries in a tile: one task multiplies them and holds their scores, 32 MiB.
TILE_VECTORS, TILE_QUERIES = 4096, 1024
SCORE_DIGITS = 9

#: Most pivots, and most shells around each: what every task knows of all vectors stays below
#: PIVOTS vectors and PIVOTS * SHELLS intervals, however many vectors there are.
PIVOTS, SHELLS = 256, 32

#: Angles near 0 are known to some 1e-8, so a tile is skipped only if it misses by more.
SLACK = 1e-7


def _best(scores: np.ndarray, order: np.ndarray, k: int) -> list[np.ndarray]:
    """Per query row, the positions of its ``k`` best by score, then ``order``."""
    if scores.shape[1] > 4 * k:
        cut = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        candidates = [np.flatnonzero(row >= c) for row, c in zip(scores, cut)]
    else:
        candidates = [np.arange(scores.shape[1])] * len(scores)
    return [c[np.lexsort((order[c], -scores[i, c]))[:k]] for i, c in enumerate(candidates)]


def _unit(vectors) -> np.ndarray:
    matrix = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(norms == 0, 1, norms)


def _tile(k: int):
    def score(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        found = {"query_id": [], "vec_id": [], "score": []}
        if len(queries) and len(vectors):
            ids, qids = vectors["vec_id"].to_numpy(), queries["query_id"].to_numpy()
            order = np.unique(ids, return_inverse=True)[1]
            scores = np.round(_unit(queries["embedding"]) @ _unit(vectors["embedding"]).T, SCORE_DIGITS)
            for i, best in enumerate(_best(scores, order, k)):
                found["query_id"] += [qids[i]] * len(best)
                found["vec_id"] += ids[best].tolist()
                found["score"] += scores[i, best].tolist()
        kinds = {"query_id": object, "vec_id": object, "score": float}  # ids as they are, whatever their type
        return pd.DataFrame({c: pd.Series(v, dtype=kinds[c]) for c, v in found.items()})

    return score


def _whole(vector: str) -> Column:
    """Whether a vector is there and has all its components."""
    column = F.col(vector)
    return column.isNotNull() & F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x))


def unsearchable(vectors: DataFrame, dimensions: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Vectors that a search with queries of ``dimensions`` cannot return, with the reason."""
    reason = (
        F.when(F.col(key).isNull(), "no id")
        .when(F.col(vector).isNull(), "no vector")
        .when(~_whole(vector), "missing component")
        .when(F.size(vector) != dimensions, "other dimensions")
    )
    return vectors.select(key, reason.alias("reason")).where(reason.isNotNull())


def _angles(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(vectors @ pivots.T, -1.0, 1.0))


@dataclass
class Shells:
    """What is known of the vectors around each pivot, by angle: a few numbers for each shell.

    By the triangle inequality on angles, a vector between ``low`` and ``high`` from a pivot is at
    least as far from a query as the query's own angle to the pivot lies outside of that interval.
    A vector without direction scores 0 with everything, which the bound for a right angle covers."""

    pivots: dict[int, np.ndarray]
    dims: np.ndarray
    cell: np.ndarray
    low: np.ndarray
    high: np.ndarray
    tiles: np.ndarray

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The shells of the queries' dimensions, and for each query and shell the best cosine that
        any of the shell's vectors may have."""
        held = np.flatnonzero(self.dims == queries.shape[1])
        pivots = self.pivots.get(queries.shape[1])
        if pivots is None:
            return held, np.ones((len(queries), len(held)))
        angle = _angles(queries, pivots)[:, np.maximum(self.cell[held], 0)]
        away = np.maximum(np.maximum(angle - self.high[held], self.low[held] - angle), 0.0)
        return held, np.cos(np.minimum(away, np.pi))


class TiledVectors:
    """Vectors placed by their nearest pivot and their angle to it, stored once for many searches.

    Pivots are vectors of the table itself, picked by hash; as many as there are tiles, up to
    PIVOTS. A pivot's vectors are cut into shells by angle, at quantiles over all, and a shell of
    more than a tile into tiles by hash, so that one direction with most vectors is many tasks."""

    def __init__(self, vectors: DataFrame, total: int, tile: int):
        self.kind, self.tile = vectors.schema["vec_id"].dataType.simpleString(), tile
        rows = vectors.select("vec_id", "embedding", F.size("embedding").alias("_dims"))
        wanted = max(1, min(PIVOTS, total // tile))
        shells = max(1, min(SHELLS, total // (tile * wanted)))
        picked = rows.select("embedding", F.xxhash64("vec_id", "embedding").alias("_hash")).orderBy("_hash").limit(wanted).collect()
        by_dims: dict[int, list] = {}
        for row in picked:
            by_dims.setdefault(len(row["embedding"]), []).append(row["embedding"])
        pivots = {dims: _unit(found) for dims, found in by_dims.items()}

        def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for dims, part in batch.groupby("_dims"):
                    cell, angle = np.full(len(part), -1), np.zeros(len(part))
                    if dims in pivots:
                        angles = _angles(_unit(part["embedding"]), pivots[dims])
                        cell = angles.argmin(axis=1)
                        angle = angles[np.arange(len(part)), cell]
                    yield part.assign(cell=cell.astype(np.int32), angle=angle)

        placed = durable(rows.mapInPandas(place, f"vec_id {self.kind}, embedding array<double>, _dims int, cell int, angle double"), "vectors-placed")
        edges = placed.approxQuantile("angle", [i / shells for i in range(1, shells)], 0.01) if shells > 1 else []
        ring = F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e < F.col("angle"))) if edges else F.lit(0)
        placed = placed.withColumn("ring", ring)
        key = ["_dims", "cell", "ring"]
        known = placed.groupBy(*key).agg(F.min("angle"), F.max("angle"), F.count("*")).orderBy(*key).collect()
        columns = [np.array(c) for c in zip(*known)] if known else [np.zeros(0)] * 6
        tiles = -(-columns[5].astype(np.int64) // tile)
        self.shells = Shells(pivots, columns[0], columns[1].astype(np.int64), columns[3].astype(float), columns[4].astype(float), tiles)
        # One row a shell, so of bounded size.
        table = placed.sparkSession.createDataFrame(
            [(r["_dims"], r["cell"], r["ring"], i, int(n)) for i, (r, n) in enumerate(zip(known, tiles))], "_dims int, cell int, ring int, shell int, _tiles int"
        )
        spread = F.pmod(F.xxhash64("vec_id", "embedding"), F.col("_tiles")).cast("int")
        self.rows = placed.join(F.broadcast(table), key).select("vec_id", "embedding", "shell", spread.alias("tile"))

    def visits(self, queries: DataFrame, thresholds: DataFrame | None = None) -> DataFrame:
        """``query_id, embedding, places``: where each query is to look, as shells with their first
        and number of tiles. Without thresholds that is one tile, of the shell that promises most;
        with them every other tile that may hold a vector whose score reaches the query's ``least``."""
        opening = thresholds is None
        shared = queries.sparkSession.sparkContext.broadcast(self.shells)  # PIVOTS vectors, PIVOTS * SHELLS intervals

        def chosen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            shells = shared.value
            for batch in batches:
                for _, part in batch.groupby(batch["embedding"].map(len)):
                    held, bounds = shells.bounds(_unit(part["embedding"]))
                    if not len(held):
                        continue
                    places = []
                    for best, reach, least in zip(bounds.argmax(axis=1), bounds, part["least"]):
                        if opening:
                            places.append([(int(held[best]), 0, 1)])
                            continue
                        seen = held if np.isnan(least) else held[reach >= least - SLACK]
                        found = [(int(s), int(s == held[best]), int(shells.tiles[s])) for s in seen]
                        places.append([f for f in found if f[1] < f[2]])
                    yield part.assign(places=places)[["query_id", "embedding", "places"]]

        rows = queries.select("query_id", "embedding")
        none = F.lit(None).cast("double").alias("least")
        rows = rows.select("*", none) if opening else rows.join(thresholds, "query_id", "left")
        kind = rows.schema["query_id"].dataType.simpleString()
        return rows.mapInPandas(chosen, f"query_id {kind}, embedding array<double>, places array<struct<shell: int, first: int, tiles: int>>")

    def scored(self, visits: DataFrame, k: int) -> DataFrame:
        """``query_id, vec_id, score``: each query's ``k`` best of every tile it visits. Only the
        vectors of visited tiles are moved, once for every TILE_QUERIES queries of their tile."""
        tile = ["shell", "tile"]
        visits = visits.select("query_id", "embedding", F.inline("places"))
        visits = visits.select("query_id", "embedding", "shell", F.explode(F.sequence("first", F.col("tiles") - 1)).alias("tile"))
        blocks = visits.groupBy(*tile).agg(F.ceil(F.count("*") / TILE_QUERIES).cast("int").alias("_blocks"))
        asked = visits.join(blocks, tile).withColumn("block", F.pmod(F.xxhash64("query_id", "embedding"), F.col("_blocks")).cast("int"))
        held = self.rows.join(blocks, tile).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        key = [*tile, "block"]
        kind = visits.schema["query_id"].dataType.simpleString()
        asked, held = asked.select("query_id", "embedding", *key), held.select("vec_id", "embedding", *key)
        return asked.groupBy(*key).cogroup(held.groupBy(*key)).applyInPandas(_tile(k), f"query_id {kind}, vec_id {self.kind}, score double")

    def search(self, queries: DataFrame, k: int) -> DataFrame:
        """``query_id, vec_id, score``, with each query's ``k`` best among the rows. The first round
        scores one tile a query; its k-th score is the threshold that a tile of the second round
        has to be able to reach."""
        first = durable(self.scored(self.visits(queries), k), "vectors-first")
        place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score")))
        thresholds = first.withColumn("_place", place).where(F.col("_place") == k).select("query_id", F.col("score").alias("least"))
        second = durable(self.visits(queries, thresholds), "vectors-visits")
        return first.unionByName(self.scored(second, k))


def searchable(df: DataFrame, key: str) -> DataFrame:
    """Rows with an id and a whole vector, the vector as doubles."""
    rows = df.where(F.col(key).isNotNull() & _whole("embedding"))
    return rows.select(key, F.col("embedding").cast("array<double>").alias("embedding"))


def vector_topk(queries: DataFrame, vectors: DataFrame, k: int = 2, namespace: str | None = None, tile: int | None = None) -> DataFrame:
    """The exact ``k`` nearest vectors by cosine for each query, with their rank.

    ``queries(query_id, embedding)`` against ``vectors(vec_id, embedding)``, of one namespace if
    given; ids are of any type. Vectors are placed in tiles around pivots (``TiledVectors``); each
    query looks at one tile first, and then only at the tiles that may hold something better. A task
    multiplies one tile by the queries that visit it and passes on ``k`` rows a query, so the pairs
    never exist as rows. Vectors that fill one tile are scored at once: there is nothing to skip.
    Equal scores go by id. Vectors are compared with queries of their own dimensions; those that
    are NULL or lack a component, and rows without an id, are left out, and ``unsearchable`` names
    them.
    """
    tile = tile or TILE_VECTORS
    if namespace is not None:
        vectors = vectors.where(F.col("namespace") == namespace)
    asked, held = searchable(queries, "query_id"), searchable(vectors, "vec_id")
    total = held.count()
    if total > tile:
        found = TiledVectors(held, total, tile).search(asked, k)
    else:
        kinds = [df.schema[c].dataType.simpleString() for df, c in ((asked, "query_id"), (held, "vec_id"))]
        tasks = max(1, -(-asked.count() // TILE_QUERIES))
        blocks = F.pmod(F.xxhash64("query_id", "embedding"), F.lit(tasks)).cast("int").alias("block")
        dims = F.size("embedding").alias("_dims")
        grouped = asked.select("query_id", "embedding", dims, blocks).groupBy("_dims", "block")
        copies = F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("block")
        found = grouped.cogroup(held.select("vec_id", "embedding", dims, copies).groupBy("_dims", "block"))
        found = found.applyInPandas(_tile(k), f"query_id {kinds[0]}, vec_id {kinds[1]}, score double")
    window = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)
