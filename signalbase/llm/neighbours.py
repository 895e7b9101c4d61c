"""Nearest neighbours by vantage-point trees, one per shard of the vectors.

A tree splits its points at the median distance to a vantage point and keeps, for each side, the smallest and largest
distance. By the triangle inequality a query that lies at distance d from the vantage point is at least
max(d - largest, smallest - d) from every point of a side. A leaf is skipped if its bound times ``factor`` exceeds the
query's k-th distance so far: with factor one the search is exact, a larger factor skips more and may miss some.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

LEAF = 128
SHARD_ROWS = 8192       # vectors in a tree
BLOCK_QUERIES = 4096    # queries searched in a tree at once


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of paired rows in double precision, squares added from the first component on."""
    total = np.zeros(len(a))
    for i in range(a.shape[1]):
        step = a[:, i] - b[:, i]
        total += step * step
    return np.sqrt(total)


class Tree:
    """A vantage-point tree as a list of leaves, each with the (vantage point, smallest, largest) on its path."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF, seed: int = 1):
        self.points, self.vantage, self.leaves = points, [], []
        self.norms = (points * points).sum(axis=1)
        rng = np.random.default_rng(seed)
        todo = [(np.arange(len(points)), [])] if len(points) else []
        while todo:
            members, path = todo.pop()
            if len(members) <= leaf:
                self.leaves.append((members, path))
                continue
            point = int(members[rng.integers(len(members))])
            d = distances(points[members], np.broadcast_to(points[point], (len(members), points.shape[1])))
            order, half = np.argsort(d, kind="stable"), len(members) // 2
            self.vantage.append(point)
            v = len(self.vantage) - 1
            for side in (order[:half], order[half:]):
                todo.append((members[side], [*path, (v, d[side].min(), d[side].max())]))

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """For each query and leaf, a distance that no point of the leaf falls short of."""
        found = np.zeros((len(queries), len(self.leaves)))
        far = np.stack([distances(queries, np.broadcast_to(self.points[v], queries.shape)) for v in self.vantage],
                       axis=1) if self.vantage else None
        for i, (_, path) in enumerate(self.leaves):
            for v, least, most in path:
                np.maximum(found[:, i], np.maximum(far[:, v] - most, least - far[:, v]), out=found[:, i])
        return np.maximum(found - 1e-9 * (1 + found), 0)    # rounding must not raise a bound

    def search(self, queries: np.ndarray, query_ids: np.ndarray, ids: np.ndarray, k: int, factor: float
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query position, point position, distance) of each query's k nearest points; its own id takes no part."""
        n = len(queries)
        bound = self.bounds(queries) * factor
        worst = np.full(n, np.inf)
        best = (np.array([], np.int64), np.array([], np.int64), np.array([]))
        norms = (queries * queries).sum(axis=1)

        def visit(members: np.ndarray, who: np.ndarray) -> None:
            nonlocal best
            block = self.points[members]
            rough = norms[who, None] + self.norms[members][None, :] - 2 * queries[who] @ block.T
            slack = 1e-9 * (1 + norms[who, None] + self.norms[members][None, :])
            a, b = np.nonzero((rough - slack <= (worst[who] ** 2)[:, None]) & (query_ids[who, None] != ids[members][None, :]))
            a, b = who[a], members[b]
            d = distances(queries[a], self.points[b])
            q, p, d = (np.concatenate(x) for x in zip(best, (a, b, d)))
            order = np.lexsort((ids[p], d, q))
            q, p, d = q[order], p[order], d[order]
            starts = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.array([], np.int64)
            rank = np.arange(len(q)) - np.repeat(starts, np.diff(np.r_[starts, len(q)]))
            best = q[rank < k], p[rank < k], d[rank < k]
            worst[q[rank == k - 1]] = d[rank == k - 1]

        nearest = np.argmin(bound, axis=1) if self.leaves else np.array([], np.int64)
        for i, (members, _) in enumerate(self.leaves):      # each query first sees its most promising leaf
            who = np.flatnonzero(nearest == i)
            if len(who):
                visit(members, who)
        for i, (members, _) in enumerate(self.leaves):
            who = np.flatnonzero((nearest != i) & (bound[:, i] <= worst))
            if len(who):
                visit(members, who)
        return best


def clean(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, v`` (double) of usable vectors: not null, not zero, all components finite, id not null."""
    v = F.col(vector_col).cast("array<double>")
    usable = (F.size("v") > 0) & F.exists("v", lambda x: x != 0) & ~F.exists(
        "v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & usable)


def nearest(vectors: DataFrame, queries: DataFrame | None = None, k: int = 10, factor: float = 1.0,
            id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int = SHARD_ROWS,
            block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k rows of ``vectors`` found nearest to each query, nearest first.

    Queries (default: rows of ``vectors`` whose id is divisible by 100) and vectors are searched in a grid of query blocks
    and shards, so neither side is ever whole in one task. The score is the Euclidean distance in double precision. Ties
    go to the smaller id. Rows with the query's own id are no candidates. With fewer than k candidates all are returned.

    Vectors that are null, zero, of no components or hold a null or non-finite one take no part, nor do null ids. Vectors
    are compared with those of the same length only. Repeated equal rows count once; an id with several vectors
    has the smallest of their distances. Of equal vectors only the k + 1 smallest ids are indexed: a larger one cannot be among
    the k nearest of anything. Other columns are not read. An empty table gives an empty result.
    """
    points = clean(vectors, id_col, vector_col)
    asked = points.where(F.col("id") % 100 == 0) if queries is None else clean(queries, id_col, vector_col)
    least = F.dense_rank().over(Window.partitionBy("v").orderBy("id"))
    points = points.withColumn("r", least).where(F.col("r") <= k + 1).drop("r").dropDuplicates(["v", "id"])
    asked = asked.dropDuplicates(["v", "id"])
    shards = max(1, -(-vectors.count() // shard_rows))
    blocks = max(1, -(-asked.count() // block_queries))

    def grid(rows: DataFrame, mine: str, count: int, other: str, others: int) -> DataFrame:
        return (rows.withColumn("d", F.size("v")).withColumn(mine, F.pmod(F.xxhash64("v", "id"), F.lit(count)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1)))))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        none = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                         "score": pa.array([], pa.float64())})
        if not left.num_rows or not right.num_rows:
            return none

        def read(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
            order = np.argsort(ids := table.column("id").to_numpy(), kind="stable")
            flat = table.column("v").combine_chunks().flatten().to_numpy()
            return ids[order], flat.reshape(len(ids), -1)[order]

        (ids, x), (query_ids, q) = read(left), read(right)
        a, b, d = Tree(x).search(q, query_ids, ids, k, factor)
        return pa.table({"query_id": query_ids[a], "vec_id": ids[b], "score": d})

    key = ["d", "shard", "block"]
    found = (grid(points, "shard", shards, "block", blocks).groupBy(*key)
             .cogroup(grid(asked, "block", blocks, "shard", shards).groupBy(*key))
             .applyInArrow(search, "query_id long, vec_id long, score double"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return (found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score")).withColumn("rank", rank)
            .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
