"""Exact top-k inner-product search: a ball tree per shard, branch and bound, a shared k-th score."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import Scratch

#: Most rows of a shard and of a query block (one task holds one of each), least rows of a shard, rows of a leaf.
SHARD, BLOCK, LEAST, LEAF = 1 << 16, 1 << 16, 4096, 256


class BallTree:
    """Median splits along the widest axis; every node keeps its centre and radius. Rows are reordered so that a node is a slice."""

    def __init__(self, x: np.ndarray, ids: np.ndarray):
        order = np.arange(len(x))
        centres, radii, self.parent, self.leaves, self.span = [], [], [], [], []
        todo = [(0, len(x), -1)]
        while todo:
            a, b, parent = todo.pop()
            part, here = x[order[a:b]], len(radii)
            centre = part.mean(0)
            centres.append(centre)
            radii.append(float(np.sqrt(((part - centre) ** 2).sum(1).max(initial=0.0))))
            self.parent.append(parent)
            if b - a > LEAF and x.shape[1]:
                half = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(part[:, int(np.argmax(part.var(0)))], half)]
                todo += [(a, a + half, here), (a + half, b, here)]
            else:
                self.leaves.append(here)
                self.span.append((a, b))
        self.x, self.ids = x[order], ids[order]
        self.centres, self.radii = np.array(centres).reshape(len(radii), -1), np.array(radii)

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """Upper bound of the inner product of each query with any row of each leaf, rounded up: the least along its path."""
        value = q @ self.centres.T + np.sqrt((q * q).sum(1))[:, None] * self.radii[None, :]
        value += 1e-9 * np.abs(value) + 1e-6
        for node, parent in enumerate(self.parent):
            if parent >= 0:
                np.minimum(value[:, node], value[:, parent], out=value[:, node])
        return value[:, self.leaves]

    def search(self, q: np.ndarray, own: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query the best k rows other than its own whose score is its floor or more, ties to the smaller id: scores (-inf where
        there are fewer) and ids. Each query visits leaves by falling bound and stops when the next one's is below its k-th score so
        far; the queries that are at the same leaf in a round share one matrix product."""
        bound = self.bounds(q)
        order = np.argsort(-bound, axis=1, kind="stable")
        score, ids = np.full((len(q), k), -np.inf), np.full((len(q), k), np.iinfo(np.int64).max)
        kth, active = floor.copy(), np.arange(len(q))
        for turn in range(len(self.leaves)):
            leaf = order[active, turn]
            on = bound[active, leaf] >= kth[active]
            active, leaf = active[on], leaf[on]
            if not len(active):
                break
            group = np.argsort(leaf, kind="stable")
            cuts = np.flatnonzero(np.r_[True, leaf[group][1:] != leaf[group][:-1], True])
            for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                who = active[group[i:j]]
                a, b = self.span[int(leaf[group[i]])]
                s = q[who] @ self.x[a:b].T
                s[self.ids[a:b][None, :] == own[who][:, None]] = -np.inf
                better = s.max(1) >= kth[who]
                if not better.any():
                    continue
                who, s = who[better], np.concatenate([score[who[better]], s[better]], axis=1)
                n = np.concatenate([ids[who], np.broadcast_to(self.ids[a:b], (len(who), b - a))], axis=1)
                by_id = np.argsort(n, axis=1, kind="stable")
                s, n = np.take_along_axis(s, by_id, 1), np.take_along_axis(n, by_id, 1)
                best = np.argsort(-s, axis=1, kind="stable")[:, :k]
                score[who], ids[who] = np.take_along_axis(s, best, 1), np.take_along_axis(n, best, 1)
                kth[who] = np.maximum(kth[who], score[who, k - 1])
        score[score < floor[:, None]] = -np.inf
        return score, ids


def _matrix(column: pd.Series) -> np.ndarray:
    flat = np.concatenate(column.to_numpy()) if len(column) else np.zeros(0)
    return flat.reshape(len(column), -1 if len(flat) else 0)


def search_shard(rows: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """The best k of one shard for one block of queries, none below a query's floor."""
    found: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
    if len(rows) and len(queries):
        x, q, ids = _matrix(rows["v"]), _matrix(queries["q"]), rows["vec_id"].to_numpy(np.int64)
        own = queries["query_id"].to_numpy(np.int64)
        if float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * x.shape[1] < 2**52:
            tree = BallTree(x.astype(float), ids)
            floor = queries["floor"].to_numpy(float)
            floor = np.where(np.isnan(floor), -np.inf, floor)
            q = q.astype(float)
            for i in range(0, len(q), 4096):  # bounds of a slice at a time
                s, n = tree.search(q[i : i + 4096], own[i : i + 4096], k, floor[i : i + 4096])
                at = np.nonzero(s > -np.inf)
                _add(found, own[i : i + 4096][at[0]], n[at], s[at].astype(np.int64))
        else:  # scores beyond 53 bits: whole shard in integers
            for one, me in zip(q, own):
                s = x @ one
                best = np.lexsort((ids, -s))
                best = best[ids[best] != me][:k]
                _add(found, np.full(len(best), me), ids[best], s[best])
    return pd.DataFrame({n: np.concatenate(v) if v else np.zeros(0, np.int64) for n, v in found.items()})


def _add(found, own, ids, scores):
    found["query_id"].append(own)
    found["vec_id"].append(ids)
    found["score"].append(scores)


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, scale: int = 64) -> DataFrame:
    """query_id, rank, vec_id, score: for each vector whose id is divisible by `every` the k other vectors with the largest inner
    product of floor(scale * x), ties to the smaller vec_id; all where there are fewer.

    Rows are dealt by a hash of their id into shards of at most about SHARD rows, queries into blocks of at most about BLOCK; each pair
    of a shard and a block is one task, so memory doesn't grow with the input, and what is copied is a row per block and a query per
    shard. A first round searches one shard (a random sample) and gives every query a k-th score; the others start from it as a floor,
    which prunes most of their trees. Floors only drop what can't be among the k best, so results are exact.

    Vectors that are null or hold null, NaN or infinite components take no part, nor do rows without an id. Rows that share an
    id are each candidates for other ids' queries if their scaled vectors differ, and count once if these are equal; a query id with
    several vectors gets the best over all of them. Only vectors of equal length meet; those of length 0 score 0 with each other. Scores
    that could exceed 63 bits raise a ValueError. Other columns are ignored. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "top_k")
    x = F.col("embedding")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == F.lit(float("inf"))))
    whole = F.transform(x, lambda c: F.lit(float(scale)) * c.cast("double"))
    rows = vectors.where(F.col("vec_id").isNotNull() & x.isNotNull() & ~bad).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("w"))
    largest = F.array_max(F.transform("w", F.abs))
    fits = F.coalesce(largest * largest * F.size("w") < F.lit(2.0**62), F.lit(True))
    scaled = F.when(fits, F.transform("w", lambda c: F.floor(c).cast("long")))
    rows = scratch.put(rows.select("vec_id", scaled.alias("v")).distinct().withColumn("dim", F.size("v")), "rows")
    n, unfit = rows.agg(F.count(F.lit(1)), F.count_if(F.col("v").isNull())).first()
    if unfit:
        raise ValueError(f"{unfit} vectors have components whose inner products may not fit into 64 bits")
    shards = max(1, -(-n // SHARD), min(n // LEAST, spark.sparkContext.defaultParallelism))
    blocks = max(1, -(-n // (BLOCK * every)))
    deal = lambda c, m: F.pmod(F.xxhash64(c), F.lit(m)).cast("int")
    rows = rows.withColumn("shard", deal("vec_id", shards))
    queries = rows.where(F.pmod("vec_id", F.lit(every)) == 0).select(
        F.col("vec_id").alias("query_id"), F.col("v").alias("q"), F.col("dim").alias("qdim"), F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int").alias("qblock")
    )

    def search(part: DataFrame, asked: DataFrame, over: list[int]) -> DataFrame:
        left = part.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        right = asked.withColumn("qshard", F.explode(F.sequence(F.lit(over[0]), F.lit(over[1]))))
        return left.groupBy("dim", "shard", "block").cogroup(right.groupBy("qdim", "qshard", "qblock")).applyInPandas(
            lambda a, b: search_shard(a, b, k), "query_id long, vec_id long, score long"
        )

    # scores at the floor stay in play, so ties still go to the smaller id
    first = scratch.put(search(rows.where("shard = 0"), queries.withColumn("floor", F.lit(float("nan"))), [0, 0]), "first")
    found = first
    if shards > 1:
        floors = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("c"), F.min("score").cast("double").alias("s"))
        floors = floors.select("query_id", F.when(F.col("c") >= k, F.col("s")).otherwise(F.lit(float("nan"))).alias("floor"))
        asked = queries.join(floors, "query_id", "left").withColumn("floor", F.coalesce("floor", F.lit(float("nan"))))
        found = first.unionAll(search(rows.where("shard > 0"), asked, [1, shards - 1]))
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
