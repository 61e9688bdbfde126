"""Exact top-k by inner product: a KD-tree per shard, best-first search, propagated bounds.

The rows are dealt by hash into shards of about ``SHARD_ROWS``; the queries into blocks of
about ``QUERY_BLOCK``. One task gets one shard and one block, both of bounded size. It
builds a KD-tree (median splits of the widest side, tight bounding boxes) and visits the
nodes of each query in the order of their box bound: the largest inner product that any
point of the box could have with the query. The search ends when the best bound left is
below the query's k-th score.

Shards are searched in waves that grow by ``WAVE`` times. After each wave the k best of
each query are merged, and their k-th score is given to the next wave, which starts with
it; so most of the rows meet a bound that a part of the rows has already made tight.

Defined results: rows with a null id or vector, or with a null or non-finite component,
take no part; only vectors of equal length are compared; rows that repeat an id or a
vector are rows of their own; ties go to the smaller id; a query with fewer than k
candidates gets them all, and none gives no row; an empty table gives an empty result.
Integer components are 64-bit, and a score beyond that range wraps.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from toxiscope.llm.common import drop_stored, spread_rows, stored

#: Production parameters of the registered query.
K = 5
SHARD_ROWS = 4096
QUERY_BLOCK = 2048
LEAF = 128
WAVE = 8


def finite_vector(vector: Column) -> Column:
    """True for a vector without null, NaN or infinite components."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return vector.isNotNull() & F.coalesce(good, F.lit(False))


def to_integers(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, computed in double precision."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))


class KDTree:
    """Points in leaf order with the tight box of every node."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(points))
        self.lo, self.hi, self.span, self.child = [], [], [], []
        todo = [(0, len(points), -1)]
        while todo:
            start, end, parent = todo.pop()
            part = points[self.order[start:end]]
            lo, hi = part.min(0), part.max(0)
            node = len(self.lo)
            self.lo.append(lo)
            self.hi.append(hi)
            self.span.append((start, end))
            self.child.append([])
            if parent >= 0:
                self.child[parent].append(node)
            wide = hi.astype(float) - lo
            if end - start <= leaf or not wide.size or not wide.max():
                continue
            axis, half = int(wide.argmax()), (end - start) // 2
            self.order[start:end] = self.order[start:end][np.argpartition(part[:, axis], half)]
            todo += [(start + half, end, node), (start, start + half, node)]
        self.points = points[self.order]
        self.lo, self.hi = np.array(self.lo), np.array(self.hi)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Largest possible inner product of each query with each node's box."""
        return np.maximum(queries, 0) @ self.hi.T + np.minimum(queries, 0) @ self.lo.T


def search(tree: KDTree, rows: np.ndarray, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, kth: np.ndarray, k: int):
    """``(query, point, score)`` of up to k points a query, none below its ``kth`` so far.

    ``rows`` tell the points apart; ``own`` is the row that a query must not find.
    """
    rows, ids = rows[tree.order], ids[tree.order]
    bounds = tree.bounds(queries)
    found = []
    for q, vector in enumerate(queries):
        limit, best = kth[q], []  # best: (score, -id, -position), the worst first
        heap = [(-bounds[q, 0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < limit:
                break
            if tree.child[node]:
                for c in tree.child[node]:
                    if bounds[q, c] >= limit:
                        heapq.heappush(heap, (-bounds[q, c], c))
                continue
            start, end = tree.span[node]
            scores = tree.points[start:end] @ vector
            for i in np.flatnonzero(scores >= limit):
                if rows[start + i] == own[q]:
                    continue
                item = (int(scores[i]), -int(ids[start + i]), -int(start + i))
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
            if len(best) == k:
                limit = max(limit, best[0][0])
        found += [(q, -p, s) for s, _, p in best]
    return found, ids


def exact_topk(
    table: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "vector", k: int = K,
    shard_rows: int = SHARD_ROWS, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``(query_id, rank, key, score)``: the k largest inner products of every query row.

    ``vector`` is an array<long> column; ``is_query`` picks the query rows.
    """
    base = table.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(
        F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("query"), F.size(vector).alias("dim"),
        F.monotonically_increasing_id().alias("row"),
    )
    base = stored(base, "kdtree-rows")
    n, n_queries = base.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("query").cast("long")), F.lit(0))).first()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-n_queries // query_block))
    hashed = F.xxhash64("row")
    points = base.withColumn("shard", F.pmod(hashed, F.lit(shards)))
    queries = base.where("query").select(
        F.col("id").alias("query_id"), F.col("row").alias("own"), F.col("vector").alias("asked"),
        F.col("dim").alias("length"), F.pmod(F.xxhash64("own", F.lit(1)), F.lit(blocks)).alias("block"),
    )

    def task(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"own": [], "query_id": [], "id": [], "score": []})
        shape = lambda s: np.array(s.tolist(), np.int64).reshape(len(s), -1)
        tree = KDTree(shape(left["vector"]))
        own, names = right["own"].to_numpy(), right["query_id"].to_numpy()
        got, ids = search(
            tree, left["row"].to_numpy(), left["id"].to_numpy(), shape(right["asked"]), own,
            right["kth"].to_numpy(), k,
        )
        return pd.DataFrame(
            [(own[q], names[q], ids[p], s) for q, p, s in got], columns=["own", "query_id", "id", "score"]
        )

    order = Window.partitionBy("own").orderBy(F.desc("score"), "id", "part")
    best, begin = None, 0
    lowest = F.lit(-(1 << 63)).cast("long")
    while begin < shards:
        end = min(shards, max(1, begin * WAVE))
        if best is None:
            asked = queries.withColumn("kth", lowest)
        else:
            kth = best.where(F.col("rank") == k).select("own", F.col("score").alias("kth"))
            asked = queries.join(kth, "own", "left").withColumn("kth", F.coalesce("kth", lowest))
        asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(begin), F.lit(end - 1)).cast("array<long>")))
        here = points.where(F.col("shard").between(begin, end - 1)).withColumn(
            "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>"))
        )
        found = here.groupBy("dim", "shard", "block").cogroup(asked.groupBy("length", "shard", "block")).applyInPandas(
            task, "own long, query_id long, id long, score long"
        ).withColumn("part", F.lit(begin))
        if best is not None:
            found = found.unionByName(best.drop("rank"))
        merged = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        last, best = best, stored(merged, "kdtree-best")
        if last is not None:
            drop_stored(last)
        begin = end
    return best.select("query_id", "rank", F.col("id").alias(key), "score")


def integer_topk(embeddings: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = K) -> DataFrame:
    """:func:`exact_topk` over floor(256 * x) of the valid vectors."""
    slim = spread_rows(embeddings.select(F.col(key).alias("id"), F.col(vector).alias("v"), is_query.alias("q")))
    valid = slim.where(finite_vector(F.col("v"))).select("id", to_integers(F.col("v")).alias("vector"), "q")
    return exact_topk(valid, F.col("q"), "id", "vector", k).withColumnRenamed("id", key)
