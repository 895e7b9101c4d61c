"""Lookups of repository stars and page bodies."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.html import page_paragraphs
from ..functions.links import repo_key, repo_name, repo_owner, repo_url
from ..functions.text import first_nonempty
from .dedup import first_wins
from .skew import salted_join


def paper_stars(papers: DataFrame, repo_stats: DataFrame, summary: str = "summary") -> DataFrame:
    """Adds ``github_url`` and ``github_stars`` of the first repository named in ``summary``; 0 where unknown."""
    keyed = papers.withColumn("github_url", repo_url(summary)).withColumn(
        "_repo", F.concat(repo_owner(summary), F.lit("/"), repo_key(repo_name(summary))))
    stats = (repo_stats.select(F.concat("owner", F.lit("/"), "repo").alias("_repo"), "stars")
             .groupBy("_repo").agg(F.max("stars").alias("_stars")))
    return (salted_join(keyed, stats, "_repo")
            .withColumn("github_stars", F.coalesce("_stars", F.lit(0))).drop("_repo", "_stars"))


def page_bodies(pages: DataFrame, order: str | None = None, wanted: DataFrame | None = None, link: str = "link") -> DataFrame:
    """(url, body) of landed pages; only urls that ``wanted`` links to, if given.

    Of several pages of a url the first in ``order`` counts; where pages have no order, the one with the greatest body.
    Pages that nothing links to are dropped before they are parsed, and text is cut out before the next shuffle.
    """
    if wanted is not None:
        pages = pages.join(wanted.select(F.col(link).alias("url")).distinct(), "url", "left_semi")
    bodies = pages.select("url", page_paragraphs("html").alias("body"), *([order] if order else []))
    if order is None:
        return bodies.groupBy("url").agg(F.max("body").alias("body"))
    return first_wins(bodies, "url", order).drop(order)


def news_body(entries: DataFrame, bodies: DataFrame, link: str = "link", summary: str = "summary") -> DataFrame:
    """Adds ``full_text``: page body, else the summary, else empty."""
    looked_up = salted_join(entries, bodies.withColumnRenamed("url", link), link)
    return looked_up.withColumn("full_text", first_nonempty("body", summary)).withColumn(
        "full_text", F.coalesce("full_text", F.lit(""))).drop("body")
