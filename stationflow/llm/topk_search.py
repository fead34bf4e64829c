"""Exact top-k by inner product of integer vectors: MaxScore over tiles of vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from stationflow.session import durable

#: Terms that are probed between two prunings, and rows that set the first threshold of a tile.
PROBED, SEED_ROWS = 8, 256
#: Sums of products below this are exact in double precision.
EXACT = float(1 << 53)


def quantized(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component as doubles; null if the vector takes no part, that is if it
    is null or holds a component that is null, NaN or infinite."""
    whole = F.transform(vector, lambda x: x.cast("double"))
    fine = F.forall(whole, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(vector.isNotNull() & fine, F.transform(whole, lambda x: F.floor(x * scale).cast("double")))


def max_score(query: np.ndarray, rows: np.ndarray, ids: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the k best of ``rows``; ties go to the smaller id.

    Each dimension is a term whose posting list is its column, and ``low``, ``high`` bound a row's
    component, so a term's contribution lies between two known numbers. The first rows are scored
    in full; their k-th score is the threshold. Terms whose greatest gains together, on top of all
    least contributions, stay below the threshold are non-essential: no row gets in by them
    alone. The columns of the essential terms are traversed for all rows; the others are probed,
    greatest gain first, only for rows whose best possible score still reaches the threshold."""
    ends = np.stack([query * low, query * high])
    least, most = ends.min(axis=0), ends.max(axis=0)
    seed = min(len(rows), max(k, SEED_ROWS))
    scores = rows[:seed] @ query
    places = np.arange(seed)
    if seed < len(rows):
        threshold = np.partition(scores, seed - k)[seed - k]
        order = np.argsort(least - most, kind="stable")  # greatest gain first
        gains = np.cumsum((most - least)[order][::-1])[::-1]  # of this term and those after it
        first = int(np.searchsorted(-gains, -(threshold - least.sum()), side="right"))
        essential = order[:first]
        alive = np.arange(seed, len(rows))
        partial = rows[seed:][:, essential] @ query[essential]
        for at in range(first, len(order) + PROBED, PROBED):
            reach = partial + most[order[at:]].sum() >= threshold
            alive, partial = alive[reach], partial[reach]
            if at >= len(order) or not len(alive):
                break
            terms = order[at : at + PROBED]
            partial = partial + rows[alive][:, terms] @ query[terms]
        places, scores = np.concatenate([places, alive]), np.concatenate([scores, partial])
    if len(scores) > k:
        reached = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        places, scores = places[reached], scores[reached]
    best = np.lexsort((ids[places], -scores))[:k]
    return places[best], scores[best]


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of equal width; a shorter vector lacks its last terms, which then add nothing."""
    column = column.combine_chunks()
    lengths = np.diff(np.asarray(column.offsets))
    out = np.zeros((len(column), width))
    out[np.arange(width)[None, :] < lengths[:, None]] = np.asarray(column.flatten(), dtype=np.float64)
    return out


def _width(column: pa.ChunkedArray) -> int:
    return int(np.diff(np.asarray(column.combine_chunks().offsets)).max(initial=0))


def _tile(k: int):
    def search(key: tuple, rows: pa.Table, asked: pa.Table) -> pa.Table:
        found: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if rows.num_rows and asked.num_rows:
            width = max(_width(rows["vector"]), _width(asked["vector"]))
            vectors, queries = _matrix(rows["vector"], width), _matrix(asked["vector"], width)
            ids, query_ids = np.asarray(rows["vec_id"]), np.asarray(asked["vec_id"])
            if width * np.abs(vectors).max(initial=0) * np.abs(queries).max(initial=0) >= EXACT:
                whole = np.frompyfunc(int, 1, 1)
                vectors, queries = whole(vectors), whole(queries)
            low, high = vectors.min(axis=0), vectors.max(axis=0)
            for query_id, query in zip(query_ids, queries):
                own = ids == query_id
                part, part_ids = (vectors[~own], ids[~own]) if own.any() else (vectors, ids)
                if not len(part):
                    continue
                places, scores = max_score(query, part, part_ids, low, high, min(k, len(part)))
                found["query_id"] += [query_id] * len(places)
                found["vec_id"] += part_ids[places].tolist()
                found["score"] += [int(s) for s in scores]
        return pa.table({n: pa.array(v, pa.int64()) for n, v in found.items()})

    return search


def top_k(vectors: DataFrame, vec_id: Column, vector: Column, asked: Column, k: int = 5, scale: int = 256, tile: int = 8192, asked_tile: int = 1024) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row where ``asked`` holds the ``k`` others with the
    highest inner product of the vectors floor(``scale`` * x); ties go to the smaller id.

    Rows are dealt into tiles by hash, queries into blocks, and each tile meets each block in a task
    of its own (a stated query set against all rows, in blocks); what leaves it is k rows a query.
    Those are merged by query. Nothing is pruned but what cannot be among the k.

    ``vec_id`` is a long; rows without one, and vectors that are null or hold null or non-finite
    components, take no part. A shorter vector lacks its last terms. A query's own id is never its
    candidate; other repeated rows count each; a query row that is repeated counts once. Scores
    must fit in 64 bits."""
    rows = vectors.select(vec_id.cast("long").alias("vec_id"), quantized(vector, scale).alias("vector"), F.coalesce(asked, F.lit(False)).alias("asked"))
    rows = durable(rows.where("vec_id is not null and vector is not null"), "topk-rows")
    total, queries = rows.agg(F.count("*"), F.count_if("asked")).first()
    tiles, blocks = max(1, -(-total // tile)), max(1, -(-queries // asked_tile))
    hashed = F.xxhash64("vec_id", "vector")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    held = rows.select("vec_id", "vector", F.pmod(hashed, F.lit(tiles)).cast("int").alias("tile"), every(blocks).alias("block"))
    asking = rows.where("asked").dropDuplicates(["vec_id", "vector"])
    asking = asking.select("vec_id", "vector", every(tiles).alias("tile"), F.pmod(hashed, F.lit(blocks)).cast("int").alias("block"))
    found = held.groupBy("tile", "block").cogroup(asking.groupBy("tile", "block")).applyInArrow(_tile(k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
