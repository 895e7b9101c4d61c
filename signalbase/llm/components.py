"""Connected components over a table of links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import stage


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, root`` for every node of ``links(a, b)``; the root is the smallest node of its component.

    Large-star and small-star rounds (Kiveris et al. 2014): each node's larger neighbours, then its smaller ones, are linked
    to its smallest one, until nothing changes; the rounds needed grow with the logarithm of the nodes. A star's
    centre has one row per leaf, and both kinds of round aggregate by key only, so no neighbour list is ever gathered.
    Each round is written to the shared folder, which cuts the lineage and survives lost executors.
    """
    edges = stage(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                  "links")
    state = _state(edges)
    for _ in range(rounds):
        if state[0] == 0:
            break
        edges = stage(_small_star(_large_star(edges)), "links")
        before, state = state, _state(edges)
        if before == state:
            break
    else:
        raise RuntimeError(f"components not found in {rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select("b", "b").distinct().toDF("node", "root"))


def _state(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges (up to a hash collision)."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a").toDF("a", "b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a")
    return (linked.select(F.col("b").alias("a"), F.col("m").alias("b")).union(linked.select("a", "m").toDF("a", "b"))
            .where("a <> b").distinct())
