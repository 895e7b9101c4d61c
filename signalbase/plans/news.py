"""News: feed entries and landed pages to news records."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from .. import fixed
from ..functions.dates import collected_at, fresh_only, parse_utc, py_isoformat
from ..functions.text import with_default
from ..operators.lookups import news_body, page_bodies
from ..session import stage


def news_rows(entries: DataFrame, pages: DataFrame, cutoff: datetime, run_ts: datetime,
              order: str | None = None) -> DataFrame:
    """Fresh entries with their article text, found by link (see ``page_bodies``).

    Stale entries are dropped before any page is parsed or looked up. The fresh ones are written to the shared folder: the
    lookup reads them twice, and dates of all entries should be parsed once.
    """
    fresh = fresh_only(entries.withColumn("ts", parse_utc("published")), "ts", cutoff)
    linked = stage(fresh.withColumn("link", with_default("link", "")), "fresh-news")
    return news_body(linked, page_bodies(pages, order, linked)).select(
        with_default("title", fixed.UNTITLED).alias("title"), "full_text", "source_name",
        F.col("link").alias("source_url"), py_isoformat("ts").alias("published_date"),
        collected_at(run_ts).alias("collected_at"), "ingest_seq")
