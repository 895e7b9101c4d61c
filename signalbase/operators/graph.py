"""Company graph: triples and traversal by hops."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .. import fixed
from ..session import stage, stage_by
from .resolve import Catalogue, resolve_entities
from .skew import frequent_keys, repeated, salted


def triples(products: DataFrame, jobs: DataFrame, papers: DataFrame, catalogue: Catalogue) -> DataFrame:
    """(src, rel, dst) from stored tables: PRODUCES, HIRES and, for authors that are companies, AUTHORED."""
    produces = products.select(
        F.col("startup_name").alias("src"), F.lit("PRODUCES").alias("rel"), F.col("source_url").alias("dst"))
    hires = jobs.select(F.col("company").alias("src"), F.lit("HIRES").alias("rel"), F.col("source_url").alias("dst"))
    names = papers.select("paper_url", F.explode(F.from_json("authors", "array<string>")).alias("author"))
    known = resolve_entities(names, "author", catalogue).filter(
        ~F.col("method").isin(fixed.METHOD_NONE[0], fixed.METHOD_RULE[0]))
    authored = known.select(
        F.col("canonical").alias("src"), F.lit("AUTHORED").alias("rel"), F.col("paper_url").alias("dst"))
    return produces.unionByName(hires).unionByName(authored)


def along(edges: DataFrame, rel: str | None) -> DataFrame:
    """Edges of relation ``rel``, turned round if it is given as ``^rel``; all edges if it is None."""
    if rel is None:
        return edges.select("src", "dst")
    ends = ("dst", "src") if rel.startswith("^") else ("src", "dst")
    return edges.filter(F.col("rel") == rel.removeprefix("^")).select(
        F.col(ends[0]).alias("src"), F.col(ends[1]).alias("dst"))


def by_source(way: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(hot nodes, edges as they lie by source node): written once, so that no hop moves an edge to its source again."""
    hot = stage(frequent_keys(way, "src"), "hot-nodes")
    return hot, stage_by(salted(way, "src", hot, F.col("dst")), ["src", "_salt"], "edges")


def one_hop(placed: tuple[DataFrame, DataFrame], frontier: DataFrame, hop: int) -> DataFrame:
    """(label, node, hop) one edge away from ``frontier``."""
    hot, edges = placed
    heads = repeated(frontier.select("label", F.col("node").alias("src")), "src", hot)
    return edges.join(heads, ["src", "_salt"]).select("label", F.col("dst").alias("node")).withColumn("hop", F.lit(hop))


def reach(edges: DataFrame, seeds: DataFrame, hops: int, rels: Sequence[str] | None = None) -> DataFrame:
    """Nodes reached from labelled seeds along edges, with the least number of hops: (label, node, hop).

    ``rels`` names the relation that each hop follows (as in ``along``); a node met again at a later hop then goes on from
    there, as another relation follows. Without ``rels`` any edge is followed.

    The frontier of each hop holds every (label, node) once, so the work is one pass over the edges per hop and never
    a product of paths. Edges are dealt by source node once for each relation, a node with very many of them over several
    parts; only frontiers are shuffled after that. Every hop but the last is written to the shared folder, which keeps
    the plan from doubling.
    """
    steps = list(rels) if rels is not None else [None] * hops
    placed = {rel: by_source(along(edges, rel)) for rel in dict.fromkeys(steps)}
    found = frontier = seeds.select("label", "node").distinct().withColumn("hop", F.lit(0))
    for hop, rel in enumerate(steps, 1):
        stepped = one_hop(placed[rel], frontier, hop)
        if rels is not None:
            frontier = stage(stepped.distinct(), f"reach-{hop}") if hop < len(steps) else stepped
            found = found.unionByName(frontier)
            continue
        found = found.unionByName(stepped).groupBy("label", "node").agg(F.min("hop").alias("hop"))
        if hop < len(steps):
            found = stage(found, f"reach-{hop}")
        frontier = found.filter(F.col("hop") == hop)
    return found if rels is None else found.groupBy("label", "node").agg(F.min("hop").alias("hop"))
