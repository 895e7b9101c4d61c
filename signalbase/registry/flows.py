"""Whole flows from landed rows to table rows over the given tables."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from .. import fixed
from ..operators.dedup import insert_or_ignore
from ..operators.records import flatten, to_record
from ..operators.resolve import Catalogue, resolution_log
from ..operators.validate import validate
from ..plans import entities, jobs, news, papers
from ..plans.run import Landed, run
from ..session import fresh_path, stage
from ..sources.landed import read_repo_stats as repo_stats_of
from . import readers
from .base import (
    CUTOFF, CUTOFF_SQL, NAMES_SQL, ORACLES, RUN_TS, Tables, any_keyword_sql, hash_sql, iso_sql, query,
    resolve_sql, strip_sql,
)
from .columns import ABSTRACTS_SQL, PARAGRAPHS_SQL, REPO_KEY_SQL, REPO_SQL, REPO_URL_SQL


def _arrived(df: DataFrame, key: str, source_no: int) -> DataFrame:
    return df.withColumn("ingest_seq", F.col(key) + F.lit(source_no).cast("bigint") * F.lit(1 << 58))


def _boards(t: Tables) -> dict[str, DataFrame]:
    return {"a": _arrived(readers.board_a_source(t), "c_custkey", 0),
            "b": _arrived(readers.board_b_source(t), "p_partkey", 1),
            "c": _arrived(readers.board_c_source(t), "s_suppkey", 2),
            "feed": _arrived(readers.job_feed_source(t), "o_orderkey", 3)}


def _stored(t: Tables, flat: DataFrame, kind: str) -> DataFrame:
    """New table rows of a first run: validated, flattened, deduplicated, numbered."""
    good, _ = validate(to_record(flat, kind, ("ingest_seq",)), kind)
    none = t.spark.createDataFrame([], "hash_key string")
    batch = stage(flatten(good, kind, ("ingest_seq",)).drop("raw_payload"), kind)
    return insert_or_ignore(batch, none, "ingest_seq").drop("ingest_seq")


POSTINGS_SQL = f"""{NAMES_SQL}, {readers.BOARD_A_SQL}, {readers.BOARD_B_SQL}, {readers.BOARD_C_SQL},
    {readers.JOB_FEED_SQL},
    postings AS (
      SELECT 0 AS board, c_custkey AS k, coalesce(company_name, 'Unknown') AS raw_name, ts, TRUE AS is_remote,
        coalesce(url, '{fixed.BOARD_A_HOME}') AS source_url FROM board_a
      UNION ALL SELECT 1, p_partkey, company_name, ts, coalesce(remote, FALSE), url FROM board_b
        WHERE {any_keyword_sql(["title"], fixed.BOARD_B_KEYWORDS)} OR list_contains(tags, 'AI')
      UNION ALL SELECT 2, s_suppkey, company_name, ts, TRUE, url FROM board_c
        WHERE {any_keyword_sql(["title"], fixed.BOARD_C_KEYWORDS)}
      UNION ALL SELECT 3, o_orderkey, CASE WHEN contains(title, ':') THEN {strip_sql("split_part(title, ':', 1)")}
        ELSE 'Unknown' END, ts, TRUE, link FROM job_feed
        WHERE {any_keyword_sql(["title"], fixed.JOB_FEED_KEYWORDS)}),
    fresh AS (SELECT * FROM postings WHERE ts >= {CUTOFF_SQL})"""


def _first_sql(source: str, order: str, columns: str) -> str:
    return f"""SELECT {columns}, hash_key, row_number() OVER (ORDER BY {order}) AS id FROM (SELECT *, row_number() OVER
        (PARTITION BY hash_key ORDER BY {order}) AS rn FROM {source}) x WHERE rn = 1"""


@query(f"""WITH {POSTINGS_SQL}, {resolve_sql('fresh')},
    keyed AS (SELECT board, k, canonical AS company, {iso_sql('ts')} AS date, is_remote, 'Engineering' AS role_family,
        source_url, {hash_sql('canonical', 'source_url')} AS hash_key FROM fresh JOIN res USING (raw_name))
    {_first_sql('keyed', 'board, k', 'company, date, is_remote, role_family, source_url')}""")
def jobs_table(t: Tables):
    resolved = jobs.resolved_jobs(_boards(t), CUTOFF, Catalogue.built_in(t.spark))
    return _stored(t, jobs.job_rows(resolved), "jobs")


@query(f"""WITH {POSTINGS_SQL}, {resolve_sql('fresh')} SELECT raw_name, canonical AS canonical_name, method, confidence
    FROM fresh JOIN res USING (raw_name)""")
def jobs_log(t: Tables):
    resolved = jobs.resolved_jobs(_boards(t), CUTOFF, Catalogue.built_in(t.spark))
    return resolution_log(resolved, "raw_name", F.lit(RUN_TS)).drop("resolved_at")


_ENTITIES_SQL = f"""{readers.DIRECTORY_SQL}, {readers.SPACES_SQL},
    on_topic AS (SELECT p_partkey AS k, {strip_sql('name')} AS raw_name,
        CASE WHEN regexp_full_match(team_size, '[0-9]+') AND team_size <> '0' THEN CAST(team_size AS INTEGER) END
        AS employee_count, coalesce(nullif(url, ''), nullif(cb_url, ''), '{fixed.DIRECTORY_URL}' || slug) AS source_url
        FROM directory WHERE {any_keyword_sql(
            ["industry", "subindustry", "coalesce(long_description, '') || ' ' || one_liner"],
            fixed.STARTUP_KEYWORDS)} AND {strip_sql('name')} <> ''),
    both_sources AS (SELECT 0 AS source_no, * FROM on_topic UNION ALL SELECT 1, o_orderkey, CASE WHEN contains(id, '/')
        THEN split_part(id, '/', 1) ELSE 'Community' END, NULL, '{fixed.SPACES_URL}' || id FROM spaces),
    kept AS (SELECT * FROM both_sources ORDER BY source_no, k),
    {resolve_sql('kept')}, resolved AS (SELECT * FROM kept JOIN res USING (raw_name))"""


def _entities(t: Tables) -> DataFrame:
    return entities.resolved_entities(
        _arrived(readers.directory_source(t), "p_partkey", 0), _arrived(readers.spaces_source(t), "o_orderkey", 1),
        Catalogue.built_in(t.spark))


@query(f"""WITH {_ENTITIES_SQL}, keyed AS (SELECT source_no, k, canonical AS entity_name, employee_count,
        CASE source_no WHEN 0 THEN 'Y Combinator' ELSE 'Hugging Face Spaces' END AS source_name, source_url,
        '2024-06-05T00:00:00+00:00' AS collected_at, {hash_sql('canonical', 'source_url')} AS hash_key FROM resolved)
    {_first_sql('keyed', 'source_no, k', 'entity_name, employee_count, source_name, source_url, collected_at')}""")
def startups_table(t: Tables):
    return _stored(t, entities.startup_rows(_entities(t), RUN_TS), "startups")


@query(f"""WITH {_ENTITIES_SQL}, keyed AS (SELECT source_no, k, canonical AS startup_name,
        CASE source_no WHEN 0 THEN 'FREEMIUM' ELSE 'FREE' END AS pricing_model,
        CASE source_no WHEN 0 THEN 'Y Combinator Directory' ELSE 'Hugging Face Spaces' END AS source_name, source_url,
        '2024-06-05T00:00:00+00:00' AS collected_at, {hash_sql('canonical', 'source_url')} AS hash_key FROM resolved)
    {_first_sql('keyed', 'source_no, k', 'startup_name, pricing_model, source_name, source_url, collected_at')}""")
def products_table(t: Tables):
    return _stored(t, entities.product_rows(_entities(t), RUN_TS), "products")


def _repo_stats(t: Tables) -> DataFrame:
    return t.supplier.select(
        F.concat(F.lit("org"), "s_suppkey").alias("owner"),
        F.concat(F.lit("repo"), F.col("s_suppkey") % 10).alias("repo"),
        F.abs(F.round("s_acctbal")).cast("int").alias("stars"))


@query("""SELECT 'org' || s_suppkey AS owner, 'repo' || s_suppkey % 10 AS repo,
    CAST(abs(round(s_acctbal)) AS INTEGER) AS stars FROM supplier""")
def read_repo_stats(t: Tables):
    path = fresh_path(t.spark, "landed-stats")
    _repo_stats(t).write.parquet(path)
    return repo_stats_of(t.spark, path)


@query(f"""WITH {ABSTRACTS_SQL}, capped AS (SELECT * FROM abstracts ORDER BY doc_id),
    stats AS (SELECT 'org' || s_suppkey || '/repo' || s_suppkey % 10 AS repo,
              CAST(abs(round(s_acctbal)) AS INTEGER) AS stars FROM supplier),
    linked AS (SELECT doc_id, {REPO_URL_SQL} AS github_url,
              nullif(regexp_extract(summary, {REPO_SQL}, 1), '') || '/' || {REPO_KEY_SQL} AS repo FROM capped),
    keyed AS (SELECT doc_id, 'On the topic ' || doc_id AS title,
              '["Ann ' || doc_id || '","Bo ' || doc_id % 50 || '"]' AS authors,
              'https://papers.example/' || doc_id % 800 AS paper_url, github_url, coalesce(stars, 0) AS github_stars,
              strftime({readers.HOURS_SQL.format('doc_id')}, '%Y-%m-%dT%H:%M:%SZ') AS published_date,
              {hash_sql("'https://papers.example/' || doc_id % 800")} AS hash_key
              FROM linked LEFT JOIN stats USING (repo))
    {_first_sql('keyed', 'doc_id', 'title, authors, paper_url, github_url, github_stars, published_date')}""")
def papers_table(t: Tables):
    rows = papers.paper_rows(_arrived(readers.paper_source(t), "doc_id", 0), _repo_stats(t))
    return _stored(t, rows, "research_papers")


def _feeds(t: Tables) -> DataFrame:
    items = _arrived(readers.news_item_source(t), "event_id", 0).select(
        "title", F.col("pubDate").alias("published"), "link", F.col("description").alias("summary"), "ingest_seq",
        F.lit("TechCrunch AI").alias("source_name"))
    entries = _arrived(readers.news_entry_source(t), "s_suppkey", 1).select(
        "title", F.col("updated").alias("published"), F.element_at("link", -1)["_href"].alias("link"), "summary",
        "ingest_seq", F.lit("The Verge AI").alias("source_name"))
    return reduce(DataFrame.unionByName, [items, entries])


@query(f"""WITH {PARAGRAPHS_SQL}, {readers.NEWS_ITEM_SQL}, {readers.NEWS_ENTRY_SQL},
    entries AS (SELECT 0 AS feed, event_id AS k, title, ts, link, summary, 'TechCrunch AI' AS source_name FROM news_item
                UNION ALL SELECT 1, s_suppkey, title, ts, link, summary, 'The Verge AI' FROM news_entry),
    one AS (SELECT url, arg_min(body, page_id) AS body FROM bodies GROUP BY url),
    keyed AS (SELECT feed, k, coalesce(title, 'Untitled') AS title, source_name, link AS source_url,
        sha256(coalesce(nullif(body, ''), nullif(summary, ''), '')) AS text_digest, {iso_sql('ts')} AS published_date,
        '2024-06-05T00:00:00+00:00' AS collected_at, {hash_sql('link')} AS hash_key
        FROM entries LEFT JOIN one ON url = link WHERE ts >= {CUTOFF_SQL})
    {_first_sql('keyed', 'feed, k', 'title, text_digest, source_name, source_url, published_date, collected_at')}""")
def news_table(t: Tables):
    rows = news.news_rows(_feeds(t), t.pages, CUTOFF, RUN_TS, "page_id")
    stored = _stored(t, rows, "news")
    return stored.withColumn("text_digest", F.sha2("full_text", 256)).drop("full_text")


def landed_tables(t: Tables):
    """All sources of one run, from the given tables."""
    return Landed(
        boards=_boards(t), feeds=_feeds(t), pages=t.pages.select("url", "html"),
        papers=_arrived(readers.paper_source(t), "doc_id", 0), repo_stats=_repo_stats(t),
        directory=_arrived(readers.directory_source(t), "p_partkey", 0),
        spaces=_arrived(readers.spaces_source(t), "o_orderkey", 1))


def _uncapped(sql: str) -> str:
    """A twin without its target row count."""
    return re.sub(r"LIMIT \d+", "", sql)


_LOG_SQL = f"(SELECT count(*) FROM ({ORACLES['jobs_log']}) l) + (WITH {_uncapped(_ENTITIES_SQL)} SELECT count(*) FROM kept)"
_FULL_SQL = " UNION ALL ".join(
    f"SELECT '{table}' AS \"table\", (SELECT count(*) FROM ({_uncapped(ORACLES[name])}) q) AS rows" for table, name in [
        ("startups", "startups_table"), ("products", "products_table"), ("jobs", "jobs_table"), ("news", "news_table"),
        ("research_papers", "papers_table")]) + f" UNION ALL SELECT 'entity_mapping_logs', {_LOG_SQL}"


@query(_FULL_SQL)
def full_run(t: Tables):
    """One whole run, without target counts, into tables in the shared folder; row counts of the six tables."""
    return run(t.spark, landed_tables(t), fresh_path(t.spark, "tables"), RUN_TS, hours=36, target=None)
