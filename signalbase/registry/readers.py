"""Readers over snapshots that Spark lands from the given tables in the shared folder."""

from __future__ import annotations

import gzip

from pyspark.sql import DataFrame, functions as F

from ..functions.text import author_names, squash_ws
from ..session import fresh_path
from ..sources import landed
from .base import NAMES_SQL, Tables, company_names, query, squash_sql
from .columns import ABSTRACTS_SQL, abstracts

ROWS_PER_DOCUMENT = 200


def land_json(rows: DataFrame, key: str, field: str | None = None, path: str | None = None) -> str:
    """Write rows as JSON documents, one per line, each an array (or an object with one array) of up to 200 rows.

    Documents are cut by ``key``, a unique whole number, so no group can be larger.
    """
    body = F.struct(*[c for c in rows.columns if c != key])
    grouped = (rows.groupBy(F.floor(F.col(key) / ROWS_PER_DOCUMENT).alias("_doc"))
               .agg(F.array_sort(F.collect_list(F.struct(F.col(key).alias("_k"), body.alias("_b")))).alias("_rows")))
    array = F.transform("_rows", lambda r: r["_b"])
    document = F.to_json(F.struct(array.alias(field))) if field else F.to_json(array)
    path = path or fresh_path(rows.sparkSession, "landed-json")
    grouped.select(document.alias("value")).write.text(path)
    return path


def land_xml(rows: DataFrame, row_tag: str) -> str:
    path = fresh_path(rows.sparkSession, "landed-xml")
    rows.write.format("xml").option("rowTag", row_tag).option("rootTag", "feed").save(path)
    return path


def directory_source(t: Tables) -> DataFrame:
    """Company directory rows from parts: a third on topic, few without a name."""
    key = F.col("p_partkey")
    return t.part.select(
        "p_partkey",
        F.when(key % 13 == 0, F.lit(" ")).otherwise(F.concat_ws(" ", "p_brand", "p_name")).alias("name"),
        F.when(key % 3 == 0, F.lit("AI Tools")).otherwise(F.col("p_type")).alias("industry"),
        F.col("p_type").alias("subindustry"),
        F.when(key % 5 == 0, F.lit("We build LLM agents")).alias("long_description"),
        F.col("p_name").alias("one_liner"),
        F.when(key % 4 != 0, F.col("p_size").cast("string")).alias("team_size"),
        F.when(key % 2 == 0, F.concat(F.lit("https://dir.example/"), key)).otherwise(F.lit("")).alias("url"),
        F.when(key % 2 == 1, F.concat(F.lit("https://cb.example/"), key % 500)).alias("cb_url"),
        F.concat(F.lit("slug-"), key).alias("slug"))


DIRECTORY_SQL = """directory AS (SELECT p_partkey, CASE WHEN p_partkey % 13 = 0 THEN ' ' ELSE p_brand || ' ' || p_name END
    AS name, CASE WHEN p_partkey % 3 = 0 THEN 'AI Tools' ELSE p_type END AS industry, p_type AS subindustry,
    CASE WHEN p_partkey % 5 = 0 THEN 'We build LLM agents' END AS long_description, p_name AS one_liner,
    CASE WHEN p_partkey % 4 <> 0 THEN CAST(p_size AS VARCHAR) END AS team_size,
    CASE WHEN p_partkey % 2 = 0 THEN 'https://dir.example/' || p_partkey ELSE '' END AS url,
    CASE WHEN p_partkey % 2 = 1 THEN 'https://cb.example/' || p_partkey % 500 END AS cb_url,
    'slug-' || p_partkey AS slug FROM part)"""


def spaces_source(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    return t.orders.select("o_orderkey", F.when(key % 5 == 0, F.concat(F.lit("solo"), key)).otherwise(
        F.concat(F.lit("author"), F.col("o_custkey"), F.lit("/space"), key % 3000)).alias("id"))


SPACES_SQL = """spaces AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'solo' || o_orderkey
    ELSE 'author' || o_custkey || '/space' || o_orderkey % 3000 END AS id FROM orders)"""


def _hours(key):
    """Whole hours after 2024-06-01, up to six days."""
    return F.timestamp_seconds(F.lit(1717200000) + key % 144 * 3600)


HOURS_SQL = "TIMESTAMP '2024-06-01 00:00:00' + to_hours({} % 144)"


def board_a_source(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    return company_names(t).select(
        "c_custkey", F.when(key % 9 != 0, F.col("raw_name")).alias("company_name"),
        F.date_format(_hours(key), "yyyy-MM-dd'T'HH:mm:ss").alias("publication_date"),
        F.when(key % 10 != 0, F.concat(F.lit("https://a.example/"), key % 400)).alias("url"))


BOARD_A_SQL = f"""board_a AS (SELECT c_custkey, CASE WHEN c_custkey % 9 <> 0 THEN raw_name END AS company_name,
    {HOURS_SQL.format('c_custkey')} AS ts,
    CASE WHEN c_custkey % 10 <> 0 THEN 'https://a.example/' || c_custkey % 400 END AS url FROM names)"""


def board_b_source(t: Tables) -> DataFrame:
    key = F.col("p_partkey")
    return t.part.select(
        "p_partkey", F.when(key % 6 == 0, F.concat(F.lit("Python "), "p_name")).otherwise(F.col("p_name")).alias("title"),
        F.when(key % 4 == 3, F.array(F.lit("AI"), "p_brand")).otherwise(F.array("p_brand")).alias("tags"),
        F.when(key % 11 == 0, F.lit(0)).otherwise(F.unix_timestamp(_hours(key))).alias("created_at"),
        F.concat("p_brand", F.lit(" Systems, Inc.")).alias("company_name"),
        F.when(key % 3 != 0, key % 2 == 0).alias("remote"),
        F.concat(F.lit("https://b.example/"), key % 900).alias("url"))


BOARD_B_SQL = f"""board_b AS (SELECT p_partkey, CASE WHEN p_partkey % 6 = 0 THEN 'Python ' || p_name ELSE p_name END AS
    title, CASE WHEN p_partkey % 4 = 3 THEN ['AI', p_brand] ELSE [p_brand] END AS tags,
    CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE {HOURS_SQL.format('p_partkey')} END AS ts,
    p_brand || ' Systems, Inc.' AS company_name, CASE WHEN p_partkey % 3 <> 0 THEN p_partkey % 2 = 0 END AS remote,
    'https://b.example/' || p_partkey % 900 AS url FROM part)"""

_TITLES = ["Retail clerk", "ML engineer", "Cook"]


def board_c_source(t: Tables) -> DataFrame:
    key = F.col("s_suppkey")
    return t.supplier.select(
        "s_suppkey", F.get(F.array(*[F.lit(x) for x in _TITLES]), (key % 3).cast("int")).alias("jobTitle"),
        F.date_format(_hours(key), "EEE, dd MMM yyyy HH:mm:ss 'GMT'").alias("pubDate"),
        F.concat("s_name", F.lit(" Technologies Ltd")).alias("companyName"),
        F.concat(F.lit("https://c.example/"), key).alias("url"))


BOARD_C_SQL = f"""board_c AS (SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'Retail clerk' WHEN 1 THEN 'ML engineer'
    ELSE 'Cook' END AS title, {HOURS_SQL.format('s_suppkey')} AS ts, s_name || ' Technologies Ltd' AS company_name,
    'https://c.example/' || s_suppkey AS url FROM supplier)"""


def job_feed_source(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    return t.orders.select(
        "o_orderkey", F.when(key % 4 == 0, F.concat(F.lit("Customer "), "o_custkey", F.lit(" GmbH: Data & AI engineer")))
        .when(key % 4 == 1, F.lit("Python developer")).when(key % 4 == 2, F.lit(": ML lead"))
        .otherwise(F.lit("Gardener: Park")).alias("title"),
        F.date_format(_hours(key), "EEE, dd MMM yyyy HH:mm:ss '+0000'").alias("pubDate"),
        F.concat(F.lit("https://feed.example/"), key % 5000).alias("link"))


JOB_FEED_SQL = f"""job_feed AS (SELECT o_orderkey, CASE o_orderkey % 4
    WHEN 0 THEN 'Customer ' || o_custkey || ' GmbH: Data & AI engineer' WHEN 1 THEN 'Python developer'
    WHEN 2 THEN ': ML lead' ELSE 'Gardener: Park' END AS title, {HOURS_SQL.format('o_orderkey')} AS ts,
    'https://feed.example/' || o_orderkey % 5000 AS link FROM orders)"""


def news_item_source(t: Tables) -> DataFrame:
    """RSS items: two to each page, and some with no page."""
    key = F.col("event_id")
    pages = t.pages.select("page_id", "url")
    linked = t.events.select("event_id", "event_type", F.floor(key / 2).alias("page_id")).join(pages, "page_id", "left")
    return linked.select(
        "event_id", F.when(key % 7 != 0, F.concat("event_type", F.lit(" & more "), key)).alias("title"),
        F.date_format(_hours(key), "EEE, dd MMM yyyy HH:mm:ss 'GMT'").alias("pubDate"),
        F.coalesce("url", F.concat(F.lit("https://gone.example/"), key)).alias("link"),
        F.when(key % 3 != 0, F.concat(F.lit("About "), "event_type")).alias("description"))


NEWS_ITEM_SQL = f"""news_item AS (SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN event_type || ' & more ' || event_id
    END AS title, {HOURS_SQL.format('event_id')} AS ts,
    coalesce(url, 'https://gone.example/' || event_id) AS link,
    CASE WHEN event_id % 3 <> 0 THEN 'About ' || event_type END AS summary
    FROM events LEFT JOIN pages ON page_id = event_id // 2)"""


def news_entry_source(t: Tables) -> DataFrame:
    """Atom entries, dated by ``updated`` only."""
    key = F.col("s_suppkey")
    link = F.struct(F.concat(F.lit("https://atom.example/"), key).alias("_href"), F.lit("alternate").alias("_rel"))
    return t.supplier.select(
        "s_suppkey", F.col("s_name").alias("title"),
        F.date_format(_hours(key), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("updated"),
        F.array(F.struct(F.lit("https://atom.example/self").alias("_href"), F.lit("self").alias("_rel")), link).alias("link"),
        F.concat(F.lit("Summary of "), "s_name").alias("summary"))


NEWS_ENTRY_SQL = f"""news_entry AS (SELECT s_suppkey, s_name AS title, {HOURS_SQL.format('s_suppkey')} AS ts,
    'https://atom.example/' || s_suppkey AS link, 'Summary of ' || s_name AS summary FROM supplier)"""


def paper_source(t: Tables) -> DataFrame:
    key = F.col("doc_id")
    blank = F.lit(None).cast("string")
    authors = F.array(F.struct(F.concat(F.lit(" Ann "), key).alias("name")), F.struct(blank.alias("name")),
                      F.struct(F.concat(F.lit("Bo "), key % 50).alias("name")))
    return abstracts(t).select(
        "doc_id", F.concat(F.lit("https://papers.example/"), key % 800).alias("id"),
        F.concat(F.lit(" On \n the  topic "), key).alias("title"), "summary",
        F.date_format(_hours(key), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("published"), authors.alias("author"))


@query(f"WITH {DIRECTORY_SQL} SELECT name, industry, long_description, team_size, url, cb_url, slug FROM directory")
def read_directory(t: Tables):
    path = land_json(directory_source(t), "p_partkey")
    return landed.good_rows(landed.read_directory(t.spark, path, lines=True)).select(
        "name", "industry", "long_description", "team_size", "url", "cb_url", "slug")


@query(f"WITH {SPACES_SQL} SELECT id FROM spaces")
def read_spaces(t: Tables):
    path = land_json(spaces_source(t), "o_orderkey")
    return landed.good_rows(landed.read_spaces(t.spark, path, lines=True)).select("id")


@query(f"WITH {SPACES_SQL} SELECT id FROM spaces")
def read_globs(t: Tables):
    """The same rows from two dumps of many files each, read by one pattern."""
    root = fresh_path(t.spark, "landed-bulk")
    for half in (0, 1):
        land_json(spaces_source(t).filter(F.col("o_orderkey") % 2 == half), "o_orderkey", path=f"{root}/dump-{half}")
    return landed.good_rows(landed.read_spaces(t.spark, f"{root}/dump-*/part-*", lines=True)).select("id")


@query("SELECT 'space' AS source, o_orderkey AS key FROM orders UNION ALL SELECT 'page', page_id FROM pages")
def union_of_broken(t: Tables):
    """Two sources of which some files break off: an array cut short, an archive cut short, a Parquet file without a footer."""
    spaces = land_json(t.orders.select("o_orderkey", F.col("o_orderkey").cast("string").alias("id")), "o_orderkey")
    pages = fresh_path(t.spark, "landed-pages")
    t.pages.select(F.col("page_id").cast("string").alias("url"), "html").write.parquet(pages)
    for path, body in ((f"{spaces}/zz-cut.json", b'[{"id": '), (f"{spaces}/zz-packed.json.gz", gzip.compress(b"[" * 99)[:30]),
                       (f"{pages}/zz.parquet", b"PAR1 and nothing")):
        place = t.spark._jvm.org.apache.hadoop.fs.Path(path)
        out = place.getFileSystem(t.spark._jsc.hadoopConfiguration()).create(place)
        out.write(bytearray(body))
        out.close()
    return landed.union_sources({
        "space": lambda: landed.good_rows(landed.read_spaces(t.spark, f"{spaces}/{{part-*,zz-*}}", lines=False)).select(
            F.lit("space").alias("source"), F.col("id").cast("bigint").alias("key")),
        "page": lambda: landed.read_pages(t.spark, pages).select(F.lit("page").alias("source"), F.col("url").cast("bigint").alias("key"))})


@query("SELECT url, sha256(html) AS digest FROM pages")
def read_pages(t: Tables):
    pages = landed.read_pages(t.spark, f"{t.folder}/pages.parquet")
    return pages.select("url", F.sha2("html", 256).alias("digest"))


@query(f"WITH {BOARD_B_SQL} SELECT title, url, coalesce(remote, false) AS aside FROM board_b")
def quarantine_rows(t: Tables):
    """Documents in which each remote job has a text where a boolean belongs: only those rows go aside."""
    whole, path = land_json(board_b_source(t), "p_partkey", "data"), fresh_path(t.spark, "landed-bad")
    (t.spark.read.text(whole).select(F.regexp_replace("value", '"remote":true', '"remote":"often"'))
     .write.text(path))
    rows = landed.read_jobs_b(t.spark, path, lines=True)
    aside = landed.corrupt_rows(rows).select(
        *[F.get_json_object(landed.CORRUPT, f"$.{c}").alias(c) for c in ("title", "url")], F.lit(True).alias("aside"))
    return landed.good_rows(rows).select("title", "url", F.lit(False).alias("aside")).union(aside)


@query(f"""WITH {NAMES_SQL}, {BOARD_A_SQL} SELECT company_name, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS publication_date, url
    FROM board_a""")
def read_jobs_a(t: Tables):
    path = land_json(board_a_source(t), "c_custkey", "jobs")
    return landed.good_rows(landed.read_jobs_a(t.spark, path, lines=True)).select(
        "company_name", "publication_date", "url")


@query(f"""WITH {BOARD_B_SQL} SELECT title, array_to_string(tags, '|') AS tags, CAST(coalesce(epoch(ts), 0) AS BIGINT) AS
    created_at, company_name, remote, url FROM board_b""")
def read_jobs_b(t: Tables):
    path = land_json(board_b_source(t), "p_partkey", "data")
    return landed.good_rows(landed.read_jobs_b(t.spark, path, lines=True)).select(
        "title", F.array_join("tags", "|").alias("tags"), F.col("created_at").cast("bigint").alias("created_at"), "company_name", "remote", "url")


@query(f"""WITH {BOARD_C_SQL} SELECT title AS "jobTitle", strftime(ts, '%a, %d %b %Y %H:%M:%S GMT') AS "pubDate",
    company_name AS "companyName", url FROM board_c""")
def read_jobs_c(t: Tables):
    path = land_json(board_c_source(t), "s_suppkey", "jobs")
    return landed.good_rows(landed.read_jobs_c(t.spark, path, lines=True)).select(
        "jobTitle", "pubDate", "companyName", "url")


@query(f"""WITH {JOB_FEED_SQL} SELECT title, strftime(ts, '%a, %d %b %Y %H:%M:%S +0000') AS "pubDate", link
    FROM job_feed""")
def read_rss(t: Tables):
    path = land_xml(job_feed_source(t).drop("o_orderkey"), "item")
    return landed.good_rows(landed.read_rss(t.spark, path)).select("title", "pubDate", "link")


@query(f"""WITH {NEWS_ITEM_SQL}, {NEWS_ENTRY_SQL} SELECT 'TechCrunch AI' AS source_name, title, link, summary,
    strftime(ts, '%a, %d %b %Y %H:%M:%S GMT') AS published FROM news_item UNION ALL SELECT 'The Verge AI', title, link,
    summary, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') FROM news_entry""")
def read_feeds(t: Tables):
    """An RSS feed, an Atom feed, and one that is not there."""
    feeds = landed.read_feeds(t.spark, {
        "TechCrunch AI": land_xml(news_item_source(t).drop("event_id"), "item"),
        "MIT Tech Review": fresh_path(t.spark, "absent"),
        "The Verge AI": land_xml(news_entry_source(t).drop("s_suppkey"), "entry")})
    return landed.good_rows(feeds).select("source_name", "title", "link", "summary", "published")


@query(f"""WITH {ABSTRACTS_SQL} SELECT 'https://papers.example/' || doc_id % 800 AS id, 'On the topic ' || doc_id AS title,
    sha256({squash_sql('summary')}) AS digest, strftime({HOURS_SQL.format('doc_id')}, '%Y-%m-%dT%H:%M:%SZ') AS published,
    'Ann ' || doc_id || '|Bo ' || doc_id % 50 AS authors FROM abstracts""")
def read_atom(t: Tables):
    path = land_xml(paper_source(t).drop("doc_id"), "entry")
    return landed.good_rows(landed.read_atom(t.spark, path)).select(
        "id", squash_ws("title").alias("title"), F.sha2(squash_ws("summary"), 256).alias("digest"), "published",
        F.array_join(author_names("author"), "|").alias("authors"))
