import json
import os
from datetime import datetime, timezone

import pytest

from signalbase import schemas
from signalbase.__main__ import main
from signalbase.functions.dates import py_isoformat
from signalbase.operators.resolve import Catalogue
from signalbase.plans import jobs, papers
from signalbase.plans.run import Landed, run
from signalbase.sinks import export, tables
from signalbase.sources import landed as L

NOW = datetime(2024, 6, 5, tzinfo=timezone.utc)


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


BOARD_A = {"jobs": [
    {"company_name": "OpenAI, Inc.", "publication_date": "2024-06-04T10:00:00", "url": "https://a/1"},
    {"publication_date": "2024-06-04T11:00:00"},
    {"company_name": "Old Co", "publication_date": "2024-06-01T10:00:00", "url": "https://a/3"},
    {"company_name": "", "publication_date": "2024-06-09T10:00:00", "url": "https://a/4"}]}
BOARD_B = {"data": [
    {"title": "Cook", "tags": ["AI"], "created_at": 1717500000, "company_name": "Groq GmbH", "remote": True, "url": "https://b/1"},
    {"title": "Data lead", "tags": [], "created_at": 0, "company_name": "Zero", "url": "https://b/2"},
    {"title": "Data lead", "created_at": 1717500000, "company_name": "Acme Ltd"},
    {"title": "Cook", "tags": ["ai ops"], "created_at": 1717500000, "company_name": "No", "url": "https://b/4"}]}
BOARD_C = {"jobs": [
    {"jobTitle": "Retail clerk", "pubDate": "Tue, 04 Jun 2024 10:00:00 GMT", "companyName": "Shop", "url": "https://c/1"},
    {"jobTitle": "Nurse", "pubDate": "Tue, 04 Jun 2024 10:00:00 GMT", "companyName": "Ward", "url": "https://c/2"}]}
JOB_FEED = """<?xml version="1.0"?><rss version="2.0"><channel><title>Feed</title>
<item><title>Acme Corp: Python &amp; AI</title><link>https://w/1</link><pubDate>Tue, 04 Jun 2024 10:00:00 +0000</pubDate></item>
<item><title><![CDATA[ML person wanted]]></title><link>https://w/2</link><pubDate>Tue, 04 Jun 2024 10:00:00 +0000</pubDate></item>
</channel></rss>"""
RSS = """<rss><channel>
<item><title>One</title><link>https://n/1</link><pubDate>Tue, 04 Jun 2024 10:00:00 GMT</pubDate><description>sum one</description></item>
<item><link>https://n/2</link><pubDate>Tue, 04 Jun 2024 11:00:00 GMT</pubDate><description>sum two</description></item>
<item><title>No date</title><link>https://n/3</link></item>
<item><title>One again</title><link>https://N/1</link><pubDate>Tue, 04 Jun 2024 12:00:00 GMT</pubDate></item>
</channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>Three</title>
<link rel="self" href="https://n/self"/><link rel="alternate" href="https://n/4"/>
<updated>2024-06-04T10:00:00Z</updated><summary>sum three</summary></entry></feed>"""
PAPERS = """<feed xmlns="http://www.w3.org/2005/Atom">
<entry><id>http://p/1</id><title> Deep
  nets </title><summary>Code at https://github.com/o/r.git.</summary><published>2024-06-04T10:00:00Z</published>
<author><name> Ann </name></author><author><name>Bo</name></author></entry>
<entry><id>http://p/2</id><title>Solo</title><summary>No code</summary><published>2024-06-03T10:00:00Z</published>
<author><name>Cy</name></author></entry>
<entry><id>http://p/3</id><summary>No title</summary><published>2024-06-03T10:00:00Z</published></entry>
<entry><id>HTTP://P/1</id><title>Again</title><summary>x</summary><published>2024-06-02T10:00:00Z</published></entry></feed>"""
DIRECTORY = [
    {"name": "Groq", "industry": "AI chips", "team_size": 12, "url": "https://d/groq"},
    {"name": " ", "industry": "AI"}, {"name": "Shoe shop", "industry": "Fashion", "slug": "shoes"},
    {"name": "Machine Learning Ltd", "one_liner": "machine learning", "team_size": "0", "cb_url": "https://cb/ml"},
    {"name": "Agents", "long_description": "LLM agents", "url": "", "slug": "agents"}]
SPACES = [{"id": "mistral/chat"}, {"id": "solo"}, {"id": "a/b/c"}]


@pytest.fixture
def landed(spark, tmp_path):
    def json_file(name, body):
        return write(tmp_path / name, json.dumps(body, indent=1))

    pages = spark.createDataFrame(
        [("https://n/1", "<p>A paragraph that is longer than thirty characters.</p>")], "url string, html string")
    stats = spark.createDataFrame([("o", "r", 42)], schemas.REPO_STATS)
    feeds = L.good_rows(L.read_feeds(spark, {
        "TechCrunch AI": write(tmp_path / "rss.xml", RSS), "Absent": str(tmp_path / "none.xml"),
        "The Verge AI": write(tmp_path / "atom.xml", ATOM)}))
    return Landed(
        boards={"a": L.good_rows(L.read_jobs_a(spark, json_file("a.json", BOARD_A))),
                "b": L.good_rows(L.read_jobs_b(spark, json_file("b.json", BOARD_B))),
                "c": L.good_rows(L.read_jobs_c(spark, json_file("c.json", BOARD_C))),
                "feed": L.good_rows(L.read_rss(spark, write(tmp_path / "jobs.xml", JOB_FEED)))},
        feeds=feeds, pages=pages,
        papers=L.good_rows(L.read_atom(spark, write(tmp_path / "papers.xml", PAPERS))), repo_stats=stats,
        directory=L.good_rows(L.read_directory(spark, json_file("dir.json", DIRECTORY))),
        spaces=L.good_rows(L.read_spaces(spark, json_file("spaces.json", SPACES))))


def test_whole_run_twice(spark, landed, tmp_path):
    root = str(tmp_path / "tables")
    counts = {r["table"]: r["rows"] for r in run(spark, landed, root, NOW).collect()}
    assert counts == {"startups": 6, "products": 6, "research_papers": 2, "jobs": 8, "news": 3,
                      "entity_mapping_logs": 14}
    job_rows = [(r.id, r.company, r.date, r.is_remote, r.source_url)
                for r in tables.read_table(spark, root, "jobs").orderBy("id").collect()]
    assert job_rows == [
        (1, "OpenAI", "2024-06-04T10:00:00+00:00", True, "https://a/1"),
        (2, "Unknown", "2024-06-04T11:00:00+00:00", True, "https://remotive.com"),
        (3, "Unknown", "2024-06-09T10:00:00+00:00", True, "https://a/4"),
        (4, "Groq", "2024-06-04T11:20:00+00:00", True, "https://b/1"),
        (5, "Acme", "2024-06-04T11:20:00+00:00", False, "https://arbeitnow.com"),
        (6, "Shop", "2024-06-04T10:00:00+00:00", True, "https://c/1"),
        (7, "Acme", "2024-06-04T10:00:00+00:00", True, "https://w/1"),
        (8, "Unknown", "2024-06-04T10:00:00+00:00", True, "https://w/2")]
    startups = [(r.entity_name, r.employee_count, r.source_name, r.source_url)
                for r in tables.read_table(spark, root, "startups").orderBy("id").collect()]
    assert startups == [
        ("Groq", 12, "Y Combinator", "https://d/groq"), ("Machine Learning", None, "Y Combinator", "https://cb/ml"),
        ("Agents", None, "Y Combinator", "https://www.ycombinator.com/companies/agents"),
        ("Mistral AI", None, "Hugging Face Spaces", "https://huggingface.co/spaces/mistral/chat"),
        ("Community", None, "Hugging Face Spaces", "https://huggingface.co/spaces/solo"),
        ("A", None, "Hugging Face Spaces", "https://huggingface.co/spaces/a/b/c")]
    products = [(r.pricing_model, r.source_name) for r in tables.read_table(spark, root, "products").orderBy("id").collect()]
    assert products == [("FREEMIUM", "Y Combinator Directory")] * 3 + [("FREE", "Hugging Face Spaces")] * 3
    news = [(r.title, r.full_text, r.source_name, r.source_url, r.published_date)
            for r in tables.read_table(spark, root, "news").orderBy("id").collect()]
    assert news == [
        ("One", "A paragraph that is longer than thirty characters.", "TechCrunch AI", "https://n/1",
         "2024-06-04T10:00:00+00:00"),
        ("Untitled", "sum two", "TechCrunch AI", "https://n/2", "2024-06-04T11:00:00+00:00"),
        ("Three", "sum three", "The Verge AI", "https://n/4", "2024-06-04T10:00:00+00:00")]
    stored = [(r.title, json.loads(r.authors), r.github_url, r.github_stars, r.published_date)
              for r in tables.read_table(spark, root, "research_papers").orderBy("id").collect()]
    assert stored == [
        ("Deep nets", ["Ann", "Bo"], "https://github.com/o/r.git", 42, "2024-06-04T10:00:00Z"),
        ("Solo", ["Cy"], None, 0, "2024-06-03T10:00:00Z")]

    again = {r["table"]: r["rows"] for r in run(spark, landed, root, NOW).collect()}
    assert again == {**counts, "entity_mapping_logs": 28}
    ids = [r.id for r in tables.read_table(spark, root, "entity_mapping_logs").collect()]
    assert sorted(ids) == list(range(1, 29))

    out = str(tmp_path / "export")
    export.export_tabs({n: tables.read_table(spark, root, n) for n in schemas.TABLES}, out)
    shown = spark.read.option("header", True).csv(f"{out}/Jobs")
    assert shown.columns == ["Canonical Company", "Date (ISO-8601)", "Is Remote", "Role Family", "Source URL"]
    assert {r["Is Remote"] for r in shown.collect()} == {"0", "1"}
    log = spark.read.option("header", True).csv(f"{out}/Entity_Mapping_Log")
    assert log.count() == 28 and log.first()["Timestamp"] == "2024-06-05 00:00:00"


def test_command_line(spark, tmp_path):
    landing = tmp_path / "landing"
    for folder, name, body in [
            ("jobs_a", "1.json", json.dumps(BOARD_A)), ("jobs_a", "2.json", '{"jobs": [{"comp'),
            ("jobs_feed", "1.xml", JOB_FEED), ("news/The Verge AI", "1.xml", ATOM), ("papers", "1.xml", PAPERS),
            ("directory", "1.json", json.dumps(DIRECTORY)), ("spaces", "1.json", json.dumps(SPACES))]:
        (landing / folder).mkdir(parents=True, exist_ok=True)
        write(landing / folder / name, body)
    main(["--landing", str(landing), "--tables", str(tmp_path / "tables"), "--export", str(tmp_path / "out"),
          "--quarantine", str(tmp_path / "bad"), "--run-time", "2024-06-05T00:00:00+00:00", "--target", "0"])
    counts = {n: tables.read_table(spark, str(tmp_path / "tables"), n).count() for n in schemas.TABLES}
    assert counts == {"startups": 6, "products": 6, "research_papers": 2, "jobs": 5, "news": 1,
                      "entity_mapping_logs": 11}
    assert spark.read.parquet(str(tmp_path / "bad" / "corrupt" / "jobs_a")).count() == 1
    assert (tmp_path / "out" / "Jobs").exists()


def test_targets_cut_before_dedup(spark, landed, tmp_path):
    root = str(tmp_path / "tables")
    counts = {r["table"]: r["rows"] for r in run(spark, landed, root, NOW, target=4).collect()}
    assert counts["startups"] == counts["products"] == 4
    assert papers.paper_rows(landed.papers, landed.repo_stats, 1).count() == 1


def test_tables_are_made_once(spark, tmp_path):
    root = str(tmp_path)
    tables.ensure_tables(spark, root)
    row = spark.createDataFrame([("h", "n", 1, "s", "u", "t", "p", 5)], (
        "hash_key string, entity_name string, employee_count int, source_name string, source_url string, "
        "collected_at string, raw_payload string, ingest_seq bigint"))
    tables.append_new(spark, root, "startups", row)
    tables.ensure_tables(spark, root)
    assert tables.read_table(spark, root, "startups").count() == 1
    assert tables.read_table(spark, root, "news").count() == 0


def test_corrupt_documents_go_aside(spark, tmp_path):
    folder = tmp_path / "dump"
    folder.mkdir()
    write(folder / "1.json", json.dumps(BOARD_A))
    write(folder / "2.json", '{"jobs": [{"company_name": "Half')
    write(folder / "3.json", json.dumps(BOARD_A))
    read = L.read_jobs_a(spark, str(folder))
    assert L.good_rows(read).count() == 8 and len(L.corrupt_rows(read).collect()) == 1
    seqs = [r.ingest_seq for r in L.good_rows(read).select("ingest_seq").collect()]
    assert len(set(seqs)) == 8


def test_arrival_order_over_files_and_splits(spark, tmp_path):
    folder = tmp_path / "dump"
    folder.mkdir()
    for f in range(3):
        write(folder / f"{f}.json", "\n".join(json.dumps({"id": f"{f}-{i:05d}"}) for i in range(2000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = L.read_spaces(spark, str(folder), lines=True)
        assert df.rdd.getNumPartitions() > 6
        ordered = [r.id for r in df.orderBy("ingest_seq").select("id").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert ordered == sorted(ordered) and len(ordered) == 6000


def test_no_source_at_all(spark, tmp_path):
    with pytest.raises(ValueError):
        L.union_sources({"x": lambda: spark.read.parquet(str(tmp_path / "none"))})


def test_csv_quotes_and_blanks(spark, tmp_path):
    news = spark.createDataFrame(
        [(1, 'Say "hi", all', None, "s", "", "d", "c")], "id bigint, title string, full_text string, "
        "source_name string, source_url string, published_date string, collected_at string")
    path = str(tmp_path / "csv")
    others = {n: spark.createDataFrame([], s) for n, s in schemas.TABLES.items()}
    export.export_tabs({**others, "news": news}, path, files=1)
    lines = [r.value for r in spark.read.text(f"{path}/News").collect()]
    assert lines == ["Title,Source Name,Source URL,Published Date (ISO-8601),Collected At", '"Say ""hi"", all",s,,d,c']
    export.export_tabs({**others, "news": news.unionByName(news)}, path, files=2)
    assert len([f for f in os.listdir(f"{path}/News") if f.startswith("part-")]) == 2
    assert spark.read.option("header", True).csv(f"{path}/News").count() == 2


def test_stale_rows_are_dropped_before_resolution(spark, landed):
    resolved = jobs.resolved_jobs(landed.boards, datetime(2024, 6, 8, tzinfo=timezone.utc), Catalogue.built_in(spark))
    assert [(r.raw_name, r.method, r.d) for r in resolved.select("raw_name", "method", py_isoformat("ts").alias("d"))
            .collect()] == [("", "NONE", "2024-06-09T10:00:00+00:00")]
