"""Exact top-k search by inner product, by aggregation without random access.

The vectors are dealt into shards.  A shard holds one list for each
dimension, sorted by the component.  For a query the lists are read from
their best end, all to the same depth at a time.  What has been read of a
vector gives a lower bound of its score (the components not yet read are at
worst the list's last) and an upper one (they are at best what comes next in
the list).  Reading stops when no vector outside a small set can reach the
k-th best lower bound; the final scores of that set are then resolved.

A shard's best k of each query go on; the best of all shards are the result.
Queries go through in blocks, so a task holds one shard and one block.

Vectors that are null, hold a null or a component that is not finite, or have
a null vec_id take no part; vectors are compared with those of as many
components only; rows with the query's vec_id are its own and no candidates,
and rows that repeat a vec_id are candidates of their own for others (as
queries, equal rows count once); further columns are ignored."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K = 5
#: Vectors of a shard and queries of a block, about.
SHARD = 8192
BLOCK = 512
#: Depths, as shares of the lists, at which the bounds are compared.
STOPS = (0.75, 0.9, 1.0)


class Lists:
    """The sorted lists of a shard."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray):
        self.vectors, self.ids = vectors, ids
        order = np.argsort(vectors, axis=0, kind="stable").T
        self.order = np.ascontiguousarray(order.astype(np.intp))
        self.sorted = np.ascontiguousarray(np.take_along_axis(vectors.T, order, axis=1))
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.arange(len(vectors))[None, :], axis=1)
        self.rank = rank.astype(np.int16 if len(vectors) < 1 << 15 else np.int32)

    def search(self, q: np.ndarray, own: int, k: int = K) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the best k of the shard, ties to smaller ids."""
        n, dims = self.vectors.shape
        up = q >= 0
        worst = q * np.where(up, self.sorted[:, 0], self.sorted[:, -1])
        low = np.full(n, worst.sum(), np.int64)
        other = self.ids != own
        keep = np.flatnonzero(other)
        read = 0
        for stop in STOPS:
            depth = int(np.ceil(n * stop))
            for d in range(dims):
                part = slice(n - depth, n - read) if up[d] else slice(read, depth)
                low[self.order[d, part]] += q[d] * self.sorted[d, part] - worst[d]
            read = depth
            if len(keep) <= k or depth == n:
                break
            # What the components that are not read can add at most (float32 holds whole numbers to 2^24).
            best = q * np.where(up, self.sorted[:, n - depth - 1], self.sorted[:, min(depth, n - 1)])
            kind = np.float32 if np.abs(best - worst).sum() < 1 << 24 else np.float64
            more = (best - worst).astype(kind)
            high = low + more[up] @ (self.rank[up] < n - depth).astype(kind) + more[~up] @ (self.rank[~up] >= depth).astype(kind)
            floor = np.partition(low[keep], len(keep) - k)[len(keep) - k]
            keep = np.flatnonzero(other & (high >= floor - 0.5))
            if len(keep) <= max(8 * k, n // 64):
                break
        scores = low[keep] if read == n else self.vectors[keep] @ q
        best = np.lexsort((self.ids[keep], -scores))[:k]
        return self.ids[keep][best], scores[best]


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """vec_id, v: floor(256 * x) of every vector that takes part."""
    x = F.col("embedding").cast("array<double>")
    bad = lambda y: y.isNull() | F.isnan(y) | (F.abs(y) == F.lit(float("inf")))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
            .filter(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & ~F.exists("x", bad))
            .select("vec_id", F.transform("x", lambda y: F.floor(y * 256)).alias("v")))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score.  Both tables: vec_id, v (array<long>)."""
    queries = queries.distinct()
    n, m = vectors.count(), queries.count()
    shards, blocks = max(1, -(-n // shard)), max(1, -(-m // block))
    # The row's own hash spreads equal ids and equal vectors.
    side = vectors.select("vec_id", "v", F.size("v").alias("dims"), F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(shards)).cast("int").alias("shard"),
                          F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    asked = queries.select("vec_id", "v", F.xxhash64("v").alias("query"), F.size("v").alias("dims"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
                           F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": [], "query": []}
        if len(left) and len(right):
            lists = Lists(np.stack(left["v"].to_numpy()).astype(np.int64).reshape(len(left), -1), left["vec_id"].to_numpy(np.int64))
            for own, q, query in zip(right["vec_id"], right["v"], right["query"], strict=True):
                ids, scores = lists.search(np.asarray(q, np.int64), own, k)
                out["query_id"].append(np.full(len(ids), own))
                out["query"].append(np.full(len(ids), query))
                out["vec_id"].append(ids)
                out["score"].append(scores)
        return pd.DataFrame({c: np.concatenate(v).astype(np.int64) if v else np.zeros(0, np.int64) for c, v in out.items()})

    keys = ["dims", "shard", "block"]
    found = side.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(search, "query_id long, vec_id long, score long, query long")
    order = Window.partitionBy("query_id", "query").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op10_top_k(spark, sf_dir: str) -> DataFrame:
    """Every row whose vec_id is divisible by 50 against all rows of ``embeddings``."""
    vectors = whole_numbers(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0))
