"""Job postings: four boards to job records."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed
from ..functions.dates import fresh_only, from_epoch, parse_utc, py_isoformat
from ..functions.text import any_keyword, company_from_title, keyword_or_tag, with_default
from ..operators.resolve import Catalogue, resolve_entities
from ..session import stage


def _posting(df: DataFrame, company, url, home: str, remote: Column | None = None, date: str | None = None,
             epoch: str | None = None) -> DataFrame:
    return df.select(
        with_default(company, fixed.UNKNOWN_COMPANY).alias("raw_name"),
        (F.col(date) if date else F.lit(None)).cast("string").alias("raw_date"),
        (F.col(epoch) if epoch else F.lit(None)).cast("bigint").alias("epoch"),
        (F.lit(True) if remote is None else remote).alias("is_remote"),
        with_default(url, home).alias("source_url"), "ingest_seq")


def board_a(df: DataFrame) -> DataFrame:
    return _posting(df, "company_name", "url", fixed.BOARD_A_HOME, date="publication_date")


def board_b(df: DataFrame) -> DataFrame:
    kept = df.filter(keyword_or_tag("title", "tags", fixed.BOARD_B_KEYWORDS) & (F.col("created_at") != 0))
    return _posting(
        kept, "company_name", "url", fixed.BOARD_B_HOME, remote=with_default("remote", False), epoch="created_at")


def board_c(df: DataFrame) -> DataFrame:
    kept = df.filter(any_keyword(["jobTitle"], fixed.BOARD_C_KEYWORDS))
    return _posting(kept, "companyName", "url", fixed.BOARD_C_HOME, date="pubDate")


def job_feed(df: DataFrame) -> DataFrame:
    kept = df.filter(any_keyword(["title"], fixed.JOB_FEED_KEYWORDS))
    return _posting(kept, company_from_title("title"), "link", fixed.JOB_FEED_HOME, date="pubDate")


BOARDS = {"a": board_a, "b": board_b, "c": board_c, "feed": job_feed}


def resolved_jobs(boards: dict[str, DataFrame], cutoff: datetime, catalogue: Catalogue) -> DataFrame:
    """Fresh postings of all boards with resolved companies; the parent of job records and of log rows."""
    postings = reduce(DataFrame.unionByName, [BOARDS[name](df) for name, df in boards.items()])
    dated = postings.withColumn("ts", F.coalesce(from_epoch("epoch"), parse_utc("raw_date"))).drop("epoch", "raw_date")
    return resolve_entities(stage(fresh_only(dated, "ts", cutoff), "postings"), "raw_name", catalogue)


def job_rows(resolved: DataFrame) -> DataFrame:
    """Flat job columns with ``ingest_seq``."""
    return resolved.select(
        F.col("canonical").alias("company"), py_isoformat("ts").alias("date"), "is_remote",
        F.lit(fixed.ROLE_FAMILY).alias("role_family"), "source_url", "ingest_seq")
