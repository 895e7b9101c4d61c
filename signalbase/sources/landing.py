"""A landing folder with one sub-folder per source.

    jobs_a  jobs_b  jobs_c  directory  spaces     JSON
    jobs_feed  papers  news/<feed name>           RSS or Atom
    pages  repo_stats                             Parquet
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import fixed, schemas
from ..plans.run import Landed
from ..session import stage
from . import landed as L

log = logging.getLogger(__name__)


def load_landing(spark: SparkSession, root: str, quarantine: str, lines: bool = False) -> Landed:
    """Landed rows of all sources. A source that is absent is empty and listed in ``skipped`` of the quarantine; rows that
    do not parse go to ``corrupt`` there, and files that break off are listed in ``broken``, what could be read of them stays.
    All folders under ``news`` are read, those without a known name last."""
    root, quarantine = root.rstrip("/"), quarantine.rstrip("/")

    def missing(name: str, problem: AnalysisException) -> None:
        if not L.is_missing(problem):
            raise problem
        log.warning("source %s is empty: %s", name, problem)
        spark.createDataFrame([(name, str(problem))], "source string, problem string").write.mode("append").parquet(
            f"{quarantine}/skipped")

    def broken(name: str, kind: str) -> None:
        (L.broken_files(spark, f"{root}/{name}", kind).select(F.lit(name).alias("source"), "path", "problem")
         .write.mode("append").parquet(f"{quarantine}/broken"))

    def source(name: str, read: Callable[[], DataFrame], empty: str, kind: str = "xml") -> DataFrame:
        try:
            rows = stage(read(), "landed")      # parsed once for good and bad rows
            if kind == "xml":       # JSON tells of broken files by itself
                broken(name, kind)
        except AnalysisException as problem:
            missing(name, problem)
            return spark.createDataFrame([], f"{empty}, ingest_seq {L.ARRIVAL}")
        L.corrupt_rows(rows).write.mode("append").parquet(f"{quarantine}/corrupt/{name}")
        return L.good_rows(rows)

    def table(name: str, read: Callable[[SparkSession, str], DataFrame], schema: str) -> DataFrame:
        try:
            rows = read(spark, f"{root}/{name}")
            broken(name, "parquet")
            return rows
        except AnalysisException as problem:
            missing(name, problem)
            return spark.createDataFrame([], schema)

    def json_rows(name, read, schema):
        return source(name, lambda: read(spark, f"{root}/{name}", lines=lines), schema, "json")

    feed_row = "title string, published string, link string, summary string, source_name string"
    names = [*fixed.NEWS_FEED_NAMES, *sorted(set(_folders(spark, f"{root}/news")) - set(fixed.NEWS_FEED_NAMES))]
    feeds = [source(f"news/{n}", lambda n=n, i=i: L.read_feed(spark, f"{root}/news/{n}", n, i), feed_row)
             for i, n in enumerate(names)]
    return Landed(
        boards={"a": json_rows("jobs_a", L.read_jobs_a, _row(schemas.BOARD_A)),
                "b": json_rows("jobs_b", L.read_jobs_b, _row(schemas.BOARD_B)),
                "c": json_rows("jobs_c", L.read_jobs_c, _row(schemas.BOARD_C)),
                "feed": source("jobs_feed", lambda: L.read_rss(spark, f"{root}/jobs_feed"), schemas.JOB_FEED_ITEM)},
        feeds=L.union_sources({n: lambda f=f: f for n, f in zip(names, feeds)}),
        pages=table("pages", L.read_pages, schemas.PAGES),
        papers=source("papers", lambda: L.read_atom(spark, f"{root}/papers"), schemas.PAPER_ENTRY),
        repo_stats=table("repo_stats", L.read_repo_stats, schemas.REPO_STATS).select(
            "owner", "repo", F.col("stars").cast("int").alias("stars")),
        directory=json_rows("directory", L.read_directory, schemas.DIRECTORY),
        spaces=json_rows("spaces", L.read_spaces, schemas.SPACES))


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it isn't there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return []
    return [entry.getPath().getName() for entry in files.listStatus(place) if entry.isDirectory()]


def _row(document: str) -> str:
    """Row fields of a document that holds one array of structs."""
    return document.split("array<struct<", 1)[1].removesuffix(">>")
