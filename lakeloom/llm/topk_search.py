"""Exact top-k inner products by norm-bucketed retrieval.

A shard's vectors are sorted by length and cut into buckets. For a query whose k-th best score so
far is t, a bucket with longest vector m needs a cosine of t / (|query| * m): over 1, the bucket
and all after it are skipped. Otherwise the bucket picks its pruning from that local threshold:
by length (only vectors of length t / |query| or more) or by coordinates (on the query's largest
coordinates, only the range that a unit vector so close can have). What is left is verified by
its product. Bounds have a margin over rounding, so nothing that ties is lost. Vectors with a
component too large for such bounds skip them: their products are taken with all, in whole numbers.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import parts_for

#: A task holds one shard and one block of queries. Small tables have smaller shards, for all cores.
SHARD_ROWS = 65_536
QUERY_BLOCK = 65_536
LEAST_SHARD_ROWS = 4096
BUCKET_ROWS = 1024
HEAD_ROWS = 1024
FOCUS = 4
MARGIN = 1e-9
#: Below this every sum of products is exact in doubles.
EXACT = 2.0**52
#: Whole components from here on are kept as Python's integers, and their vectors out of the buckets.
WILD = 2.0**40
LOWEST, HIGHEST = -(2**63), 2**63 - 1


def _whole(x: float, scale: int) -> int:
    return int(x) * scale if abs(x) >= 2.0**53 else math.floor(x * scale)


def quantised(embeddings: list, scale: int) -> tuple[np.ndarray, dict[int, list[int]]]:
    """floor(scale * x) of every component as whole numbers in doubles; rows too large for that, by number, as integers."""
    x = np.array(embeddings, np.float64)
    with np.errstate(over="ignore"):
        rows = np.floor(x * scale)
    wild = {int(i): [_whole(y, scale) for y in x[i].tolist()] for i in np.flatnonzero((np.abs(rows) >= WILD).any(axis=1))} if x.ndim == 2 else {}
    return rows, wild


def _exact(a: list[int], b: list[int]) -> int:
    return max(LOWEST, min(HIGHEST, sum(x * y for x, y in zip(a, b, strict=True))))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of a with b; those outside 64 bits are the nearest that isn't."""
    if not len(a) or np.abs(a).max() * np.abs(b).max() * len(b) < EXACT:
        return (a @ b).astype(np.int64)
    own = [int(x) for x in b]
    return np.array([_exact([int(x) for x in row], own) for row in a], dtype=np.int64)


class Bucket:
    """Vectors of similar length, longest first, with unit coordinates in order."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, lengths: np.ndarray):
        self.ids, self.rows, self.lengths = ids, rows, lengths
        unit = rows / np.maximum(lengths, 1e-300)[:, None]
        self.order = np.argsort(unit, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(unit.T, self.order, axis=1)

    def candidates(self, q: np.ndarray, size: float, threshold: float) -> np.ndarray | None:
        """Positions that may reach the threshold; None if neither these nor any shorter vectors can."""
        if threshold <= 0:  # any length may do
            return np.arange(len(self.ids))
        if size == 0 or threshold > size * self.lengths[0] * (1 + MARGIN):
            return None
        long = int(np.searchsorted(-self.lengths, -threshold / size * (1 - MARGIN), "right"))
        local = threshold / (size * self.lengths[0])
        unit = q / size
        best, pick = long, None
        for f in np.argsort(-np.abs(unit))[:FOCUS]:
            # The angle to the coordinate's axis differs by at most that of the threshold.
            angle, reach = np.arccos(np.clip(unit[f], -1, 1)), np.arccos(np.clip(local, -1, 1))
            low, high = np.cos(min(np.pi, angle + reach)), np.cos(max(0.0, angle - reach))
            a = np.searchsorted(self.sorted[f], low - 1e-7, "left")
            b = np.searchsorted(self.sorted[f], high + 1e-7, "right")
            if 2 * (b - a) < best:
                best, pick = 2 * (b - a), self.order[f][a:b]
        return np.arange(long) if pick is None else pick[pick < long]


def buckets_of(ids: np.ndarray, rows: np.ndarray, bucket_rows: int = BUCKET_ROWS) -> list[Bucket]:
    lengths = np.sqrt((rows**2).sum(axis=1))
    order = np.lexsort((ids, -lengths))
    return [Bucket(ids[p], rows[p], lengths[p]) for p in (order[i : i + bucket_rows] for i in range(0, len(order), bucket_rows))]


def _merge(ids, scores, own, new_scores, k):
    ids, scores = np.concatenate([ids, own]), np.concatenate([scores, new_scores])
    order = np.lexsort((ids, ~scores))[:k]  # ~x falls as x rises, at the ends of 64 bits too
    return ids[order], scores[order]


def top_of(buckets: list[Bucket], query_id: int, q: np.ndarray, k: int, floor: float = -np.inf) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k best, ties to the smaller id; floor is a score that k vectors are known to reach."""
    size = float(np.sqrt((q**2).sum()))
    ids, scores = np.empty(0, np.int64), np.empty(0, np.int64)
    for bucket in buckets:
        threshold = max(floor, float(scores[-1]) if len(scores) == k else -np.inf)
        at = bucket.candidates(q, size, threshold)
        if at is None:
            break
        at = at[bucket.ids[at] != query_id]
        if len(at):
            ids, scores = _merge(ids, scores, bucket.ids[at], _products(bucket.rows[at], q), k)
    return ids, scores


class Shard:
    """Vectors of one shard: buckets of those that bounds hold for, and the others."""

    def __init__(self, ids: np.ndarray, embeddings: list, scale: int):
        rows, wild = quantised(embeddings, scale)
        tame = np.array([i not in wild for i in range(len(ids))], bool)
        self.ids, self.rows, self.scale = ids, rows, scale
        self.wild = [(int(ids[i]), v) for i, v in wild.items()]
        self.tame = tame
        self.buckets = buckets_of(ids[tame], rows[tame])

    def top(self, query_id: int, embedding, k: int, head: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        rows, wild = quantised([embedding], self.scale)
        if wild:
            ids, scores = np.empty(0, np.int64), np.empty(0, np.int64)
            found = [(int(self.ids[i]), _exact([int(x) for x in self.rows[i]], wild[0])) for i in np.flatnonzero(self.tame)]
            own = wild[0]
        else:
            first = np.sort(_products(head[1], rows[0])[head[0] != query_id])
            floor = float(first[-k]) if len(first) >= k else -np.inf
            ids, scores = top_of(self.buckets, query_id, rows[0], k, floor)
            found, own = [], [int(x) for x in rows[0]] if self.wild else []
        found += [(i, _exact(v, own)) for i, v in self.wild]
        found = [x for x in found if x[0] != query_id]
        return _merge(ids, scores, *(np.array([x[n] for x in found], np.int64) for n in (0, 1)), k) if found else (ids, scores)


def _search_shard(k: int, scale: int, head):
    def search(own: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(own) and len(queries):
            shard = Shard(own["vec_id"].to_numpy(np.int64), own["embedding"].tolist(), scale)
            dim = shard.rows.shape[1]
            top = head.value.get(dim, (np.empty(0, np.int64), np.empty((0, dim))))
            for query, key, embedding in zip(queries["query_id"], queries["key"], queries["embedding"], strict=True):
                ids, scores = shard.top(query, embedding, k, top)
                out += [(query, key, int(i), int(s)) for i, s in zip(ids, scores, strict=True)]
        return pd.DataFrame(out, columns=["query_id", "key", "vec_id", "score"]).astype("int64")

    return search


def _heads(longest: list, scale: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By dimension, ids and whole components of the longest vectors that bounds hold for."""
    out = {}
    for d in {r["dim"] for r in longest}:
        own = [r for r in longest if r["dim"] == d]
        rows, wild = quantised([r["embedding"] for r in own], scale)
        tame = [i for i in range(len(own)) if i not in wild]
        out[d] = np.array([own[i]["vec_id"] for i in tame], np.int64), rows[tame]
    return out


def search(vectors: DataFrame, queries: DataFrame, k: int, scale: int, shard_rows: int = SHARD_ROWS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest integer products of each query, itself left out.

    vectors and queries are (vec_id, embedding as doubles, dim), as usable_vectors() gives them;
    components become floor(scale * x). All vectors, if fewer than k; none of another dimension. A
    score beyond 64 bits counts as the nearest number within. Where one vec_id has several vectors,
    each is a candidate, for other ids, and a query. The longest vectors of the table, a fixed
    number, are sent to every task: their products with a query are a first threshold for every shard.
    """
    spark = vectors.sparkSession
    total = vectors.count()
    shards = max(parts_for(total, shard_rows), min(2 * spark.sparkContext.defaultParallelism, parts_for(total, LEAST_SHARD_ROWS)))
    blocks = parts_for(queries.count(), query_block)
    length = F.aggregate("embedding", F.lit(0.0), lambda n, x: n + x * x)
    longest = vectors.orderBy(F.desc(length), "vec_id").limit(HEAD_ROWS).select("vec_id", "embedding", "dim").collect()
    head = spark.sparkContext.broadcast(_heads(longest, scale))
    every = lambda n: F.explode(F.expr(f"sequence(0L, {n - 1}L)"))
    key = F.xxhash64("vec_id", "embedding")
    left = vectors.select("vec_id", "embedding", "dim", F.pmod(key, F.lit(shards)).alias("shard"), every(blocks).alias("block"))
    right = queries.select(F.col("vec_id").alias("query_id"), key.alias("key"), "embedding", "dim", F.pmod(key, F.lit(blocks)).alias("block"), every(shards).alias("shard"))
    found = (
        left.groupBy("dim", "shard", "block")
        .cogroup(right.groupBy("dim", "shard", "block"))
        .applyInPandas(_search_shard(k, scale, head), "query_id long, key long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
