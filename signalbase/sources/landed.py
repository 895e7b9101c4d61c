"""Landed JSON and feed snapshots as DataFrames.

Paths may be one file, a folder or a glob, so a bulk dump is read by the same functions as one API answer.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Callable
from decimal import Decimal

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import schemas
from ..functions.text import first_nonempty
from .ranges import broken_files, json_rows  # noqa: F401

log = logging.getLogger(__name__)

CORRUPT = "_corrupt_record"
ARRIVAL = "decimal(38,0)"            # wide enough for any number of sources and files, and files of any size
SOURCE_UNIT, FILE_UNIT = Decimal(10**30), Decimal(10**19)
BROADCAST_FILES = 50_000             # file lists up to here are broadcast; longer ones are joined by a shuffle
PATIENT = {"ignoreCorruptFiles": "true", "ignoreMissingFiles": "true"}     # what can be read stays; broken_files names the rest
_SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):/+"


def is_missing(problem: AnalysisException) -> bool:
    """Whether the path of a source isn't there; any other fault must not pass for an empty source."""
    return problem.getCondition() == "PATH_NOT_FOUND"


def one_slash(path: str) -> str:
    """``file:///a`` and ``file:/a`` name one file; both become ``file:/a``."""
    return re.sub(_SCHEME, r"\1:/", path)


def _arrival(source_no: int, file, place) -> Column:
    return (F.lit(source_no * SOURCE_UNIT).cast(ARRIVAL) + F.col(file).cast("decimal(12,0)") * F.lit(FILE_UNIT) + F.col(place)).cast(ARRIVAL)


def with_arrival(df: DataFrame, source_no: int = 0) -> DataFrame:
    """Replace ``_path`` and ``_block`` by ``ingest_seq``: source, then file in path order, then place in file.

    The place is the byte offset of the file split plus the row number in its task. Each row takes at least two bytes
    of text, so the numbers rise along a file however it is split. The order depends on the files only; the numbers also on
    how files are packed into tasks.
    """
    files = sorted(df.inputFiles())     # the list that Spark's own scan keeps on the driver
    numbers = df.sparkSession.createDataFrame(
        [(one_slash(path), i) for i, path in enumerate(files)], "_path string, _file bigint")
    if len(files) <= BROADCAST_FILES:
        numbers = F.broadcast(numbers)
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = df.withColumn("_place", F.col("_block") + row)
    numbered = placed.withColumn("_path", F.regexp_replace("_path", _SCHEME, "$1:/")).join(numbers, "_path", "left")
    known = F.when(F.col("_file").isNull(), F.raise_error(F.concat(
        F.lit("row from a file that was not listed: "), "_path")).cast(ARRIVAL)).otherwise(_arrival(source_no, "_file", "_place"))
    return numbered.withColumn("ingest_seq", known).drop("_path", "_block", "_file", "_place")


def _with_origin(df: DataFrame, *columns) -> DataFrame:
    return df.select(*columns, F.col("_metadata.file_path").alias("_path"),
                     F.col("_metadata.file_block_start").alias("_block"))


def read_json(spark: SparkSession, path: str, schema: str, rows: str | None = None, source_no: int = 0,
              lines: bool = False) -> DataFrame:
    """JSON snapshot, one document per file or one per line. ``rows`` names the array that holds the rows.

    A document is first cut into the texts of its rows and each row is parsed by itself, so a bad value sets one row aside:
    its text goes to ``_corrupt_record``. A document that cannot be cut gives one such row with its whole text, a file that
    cannot be read to its end one with the problem; all rows before that stay. Files of any size are read by many tasks.
    """
    fields = schema if rows is None else schema.split("array<struct<", 1)[1].removesuffix(">>")
    parsed = F.from_json("text", f"struct<{_typed(fields)},{CORRUPT}:string>", {"columnNameOfCorruptRecord": CORRUPT}).alias("_row")
    if lines:
        return with_arrival(_cut_lines(spark, path, rows).select(parsed, "_path", "_block").select("_row.*", "_path", "_block"), source_no)
    cut = json_rows(spark, path, rows).withColumn("ingest_seq", _arrival(source_no, "file", "place"))
    told = F.concat(F.lit("unreadable "), "path", F.lit(": "), "problem")
    split = cut.select(parsed, "path", "problem", "ingest_seq").select("_row.*", "path", "problem", "ingest_seq")
    return split.withColumn(CORRUPT, F.coalesce(CORRUPT, told)).drop("path", "problem")


def _cut_lines(spark: SparkSession, path: str, rows: str | None) -> DataFrame:
    """The rows of the documents of a text file with one document per line."""
    raw = _with_origin(spark.read.text(path), "value").filter(F.trim("value") != "")
    if rows is None:
        listed = F.when(F.ltrim("value").startswith("["), F.from_json("value", "array<string>")).otherwise(F.array("value"))
    else:
        whole = F.from_json("value", f"{rows} array<string>, {CORRUPT} string", {"columnNameOfCorruptRecord": CORRUPT})
        listed = F.when(whole[CORRUPT].isNull(), F.coalesce(whole[rows], F.array().cast("array<string>")))
    elements = raw.select("_path", "_block", F.explode(F.coalesce(listed, F.array("value"))).alias("text"))
    return elements.filter(F.col("text").isNotNull())


def _typed(fields: str) -> str:
    """Column DDL as the fields of a struct type."""
    return re.sub(r"(^|, )(\w+) ", lambda m: f"{m[1].strip()}{m[2]}:", fields)


def read_xml(spark: SparkSession, path: str, schema: str, row_tag: str, source_no: int = 0) -> DataFrame:
    """Elements ``row_tag`` of XML snapshots, name spaces left out."""
    raw = (spark.read.format("xml").schema(f"{schema}, {CORRUPT} string").option("rowTag", row_tag)
           .option("ignoreNamespace", True).option("columnNameOfCorruptRecord", CORRUPT).options(**PATIENT).load(path))
    return with_arrival(_with_origin(raw, "*"), source_no)


def good_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def corrupt_rows(df: DataFrame) -> DataFrame:
    """Documents that did not parse. All columns stay: Spark refuses to read the corrupt text by itself."""
    return df.filter(F.col(CORRUPT).isNotNull())


def read_directory(spark, path, source_no=0, lines=False):
    return read_json(spark, path, schemas.DIRECTORY, None, source_no, lines)


def read_spaces(spark, path, source_no=1, lines=False):
    return read_json(spark, path, schemas.SPACES, None, source_no, lines)


def read_jobs_a(spark, path, source_no=0, lines=False):
    return read_json(spark, path, schemas.BOARD_A, "jobs", source_no, lines)


def read_jobs_b(spark, path, source_no=1, lines=False):
    return read_json(spark, path, schemas.BOARD_B, "data", source_no, lines)


def read_jobs_c(spark, path, source_no=2, lines=False):
    return read_json(spark, path, schemas.BOARD_C, "jobs", source_no, lines)


def read_rss(spark, path, source_no=3):
    return read_xml(spark, path, schemas.JOB_FEED_ITEM, "item", source_no)


def read_atom(spark, path, source_no=0):
    return read_xml(spark, path, schemas.PAPER_ENTRY, "entry", source_no)


def entry_link(links: Column) -> Column:
    """Address of an Atom entry: the link with no relation or ``alternate``, else the first."""
    main = F.filter(links, lambda x: x["_rel"].isNull() | (x["_rel"] == "alternate"))
    return F.coalesce(F.get(main, 0)["_href"], F.get(links, 0)["_href"])


def read_feed(spark: SparkSession, path: str, name: str, source_no: int = 0) -> DataFrame:
    """One news feed, RSS items and Atom entries alike: (source_name, title, published, link, summary, …)."""
    items = read_xml(spark, path, schemas.NEWS_ITEM, "item", source_no).select(
        "title", first_nonempty("published", "pubDate", "updated").alias("published"), "link", F.col("description").alias("summary"), CORRUPT,
        "ingest_seq")
    entries = read_xml(spark, path, schemas.NEWS_ENTRY, "entry", source_no).select(
        "title", first_nonempty("published", "pubDate", "updated").alias("published"), entry_link(F.col("link")).alias("link"),
        "summary", CORRUPT, "ingest_seq")
    return items.unionByName(entries).withColumn("source_name", F.lit(name))


def read_feeds(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """All news feeds, numbered in the order given."""
    return union_sources({
        name: lambda n=name, i=i, p=path: read_feed(spark, p, n, i) for i, (name, path) in enumerate(paths.items())})


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PAGES).options(**PATIENT).parquet(path)


def read_repo_stats(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.REPO_STATS).options(**PATIENT).parquet(path)


def union_sources(sources: dict[str, Callable[[], DataFrame]]) -> DataFrame:
    """Rows of all sources. A source that is absent is left out with a warning; of one that breaks off while it is read the
    readable rows stay (``broken_files`` names its broken files). The others go on."""
    whole = None
    for name, read in sources.items():
        try:
            part = read()
        except AnalysisException as problem:
            if not is_missing(problem):
                raise
            log.warning("source %s left out: %s", name, problem)
            continue
        whole = part if whole is None else whole.unionByName(part, allowMissingColumns=True)
    if whole is None:
        raise ValueError("no source could be opened")
    return whole
