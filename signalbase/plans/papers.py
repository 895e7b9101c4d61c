"""Papers: feed entries and repository numbers to paper records."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import author_names, py_strip, squash_ws, with_default
from ..operators.limits import cap_rows
from ..operators.lookups import paper_stars


_NEEDED = ["title", "summary", "published_date"]


def clean_entries(entries: DataFrame) -> DataFrame:
    return entries.select(
        squash_ws("title").alias("title"), author_names("author").alias("authors"),
        with_default(py_strip("id"), "").alias("paper_url"), py_strip("summary").alias("summary"),
        py_strip("published").alias("published_date"), "ingest_seq")


def paper_rows(entries: DataFrame, repo_stats: DataFrame, target: int | None = None) -> DataFrame:
    """The first ``target`` complete entries (default: all), with repository link and stars."""
    complete = clean_entries(entries).dropna(subset=_NEEDED)
    return paper_stars(cap_rows(complete, "ingest_seq", target), repo_stats).drop("summary")


def incomplete_papers(entries: DataFrame) -> DataFrame:
    """Entries without title, summary or date, with ``reasons``: they go to quarantine."""
    reasons = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in _NEEDED]), lambda r: r.isNotNull())
    return clean_entries(entries).withColumn("reasons", reasons).filter(F.size("reasons") > 0)
