"""One run: landed rows of all sources into the stored tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import fixed
from ..functions.dates import cutoff_of
from ..operators.audit import table_counts
from ..operators.records import flatten, to_record
from ..operators.resolve import Catalogue, resolution_log
from ..operators.validate import checked, split_checked
from ..session import at_once, fresh_path, stage, use_utc
from ..sinks.tables import load_tables, read_table
from . import entities, jobs, news, papers


@dataclass(frozen=True)
class Landed:
    """Landed rows, each with ``ingest_seq``; ``boards`` by board name, ``pages`` as (url, html)."""

    boards: dict[str, DataFrame]
    feeds: DataFrame
    pages: DataFrame
    papers: DataFrame
    repo_stats: DataFrame
    directory: DataFrame
    spaces: DataFrame


def _flat(kind: str, rows: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    return flatten(rows, kind, keep)


def run(spark: SparkSession, landed: Landed, root: str, run_ts: datetime, hours: int = fixed.FRESH_HOURS,
        target: int | None = None, catalogue: Catalogue | None = None,
        quarantine: str | None = None, run_id: str | None = None) -> DataFrame:
    """Load all tables under ``root`` as one version of them and return their row counts.

    Rows with resolved names are written to the shared folder, since records and log both come from them; so are the checked
    records of papers and news, since good and bad ones both come from them. ``quarantine`` names the folder for records that break the
    contract. A run whose ``run_id`` was loaded before changes no table.
    """
    use_utc(spark)
    catalogue = catalogue or Catalogue.built_in(spark)
    cutoff = cutoff_of(run_ts, hours)
    quarantine = quarantine or fresh_path(spark, "quarantine")

    companies, postings, articles = at_once([
        lambda: stage(entities.resolved_entities(landed.directory, landed.spaces, catalogue, target), "companies"),
        lambda: stage(jobs.resolved_jobs(landed.boards, cutoff, catalogue), "jobs"),
        lambda: news.news_rows(landed.feeds, landed.pages, cutoff, run_ts)])
    flats = {
        "research_papers": papers.paper_rows(landed.papers, landed.repo_stats, target),
        "startups": entities.startup_rows(companies, run_ts),
        "products": entities.product_rows(companies, run_ts),
        "news": articles,
        "jobs": jobs.job_rows(postings),
    }
    records = {kind: checked(to_record(flat, kind, ("ingest_seq",)), kind) for kind, flat in flats.items()}
    dear = ["research_papers", "news"]      # the others are made of a written table row by row
    records |= dict(zip(dear, at_once(partial(stage, records[kind], kind) for kind in dear)))
    split = {kind: split_checked(rows) for kind, rows in records.items()}
    good, bad = ({kind: pair[i] for kind, pair in split.items()} for i in (0, 1))
    state = load_tables(
        spark, root, good, [resolution_log(resolved, "raw_name", F.lit(run_ts), ("ingest_seq",)) for resolved in (companies, postings)],
        run_id=run_id, finish={kind: partial(_flat, kind) for kind in good})
    bad["research_papers/incomplete"] = papers.incomplete_papers(landed.papers)
    at_once(partial(rows.select(F.to_json(F.struct("*")).alias("record"), "reasons").write.mode("append").parquet,
                    f"{quarantine}/{kind}") for kind, rows in bad.items())
    return table_counts({name: read_table(spark, root, name, state) for name in [
        "startups", "products", "research_papers", "jobs", "news", "entity_mapping_logs"]})
