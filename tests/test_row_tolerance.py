"""Nothing is lost: one bad value costs one row, a new checkpoint keeps stored rows, ranks are exact, dates are read."""

from __future__ import annotations

import json

import pytest

from signalbase.functions.dates import parse_utc, py_isoformat
from signalbase.functions.html import page_paragraphs
from signalbase.operators import retrieve
from signalbase.plans import papers
from signalbase.sources import landed as L, landing
from signalbase.streaming import loads


@pytest.mark.parametrize("lines", [False, True])
def test_one_bad_value_sets_one_row_aside(spark, tmp_path, lines):
    jobs = [{"title": "A", "tags": ["x"], "created_at": 1717500000, "company_name": "Acme", "remote": True, "url": "u1"},
            {"title": "B", "created_at": 1717500000.5}, {"title": "C", "created_at": "soon"}, None, {"title": "D", "remote": 7}]
    (tmp_path / "b.json").write_text(json.dumps({"data": jobs, "other": 1}, indent=None if lines else 1) + "\n")
    rows = L.read_jobs_b(spark, str(tmp_path / "b.json"), lines=lines)
    good = {r["title"]: r["created_at"] for r in L.good_rows(rows).collect()}
    assert good == {"A": 1717500000.0, "B": 1717500000.5}
    assert [json.loads(r[L.CORRUPT])["title"] for r in L.corrupt_rows(rows).orderBy("ingest_seq").collect()] == ["C", "D"]
    (tmp_path / "d.json").write_text(json.dumps([{"name": "one", "url": "a"}, 5, {"name": "two"}]) + "\n")
    rows = L.read_directory(spark, str(tmp_path / "d.json"), lines=lines)
    assert [r["name"] for r in L.good_rows(rows).orderBy("ingest_seq").collect()] == ["one", "two"]
    assert [r[L.CORRUPT] for r in L.corrupt_rows(rows).collect()] == ["5"]


def test_feed_dates_fall_back_over_empty_ones(spark, tmp_path):
    (tmp_path / "f.xml").write_text("<feed><entry><title>t</title><published/><updated>2024-06-04T10:00:00Z</updated></entry></feed>")
    assert [r["published"] for r in L.read_feed(spark, str(tmp_path / "f.xml"), "n").collect()] == ["2024-06-04T10:00:00Z"]


def test_landing_reads_every_feed_and_lists_what_is_missing(spark, tmp_path):
    folder = tmp_path / "in" / "news" / "Some new feed"
    folder.mkdir(parents=True)
    (folder / "f.xml").write_text("<rss><item><title>t</title><pubDate>Tue, 04 Jun 2024 10:00:00 GMT</pubDate></item></rss>")
    got = landing.load_landing(spark, str(tmp_path / "in"), str(tmp_path / "aside"))
    assert [r["source_name"] for r in got.feeds.collect()] == ["Some new feed"]
    skipped = {r["source"] for r in spark.read.parquet(str(tmp_path / "aside" / "skipped")).collect()}
    assert {"jobs_a", "papers", "pages"} <= skipped and "news/Some new feed" not in skipped


def test_incomplete_papers_are_told(spark):
    rows = spark.createDataFrame([("i", "t", None, "2024", [("a",)], 1), ("i", None, "s", None, [("a",)], 2), ("i", "t", "s", "2024", [("a",)], 3)],
                                 "id string, title string, summary string, published string, author array<struct<name:string>>, ingest_seq bigint")
    got = {r["ingest_seq"]: r["reasons"] for r in papers.incomplete_papers(rows).collect()}
    assert got == {1: ["missing summary"], 2: ["missing title", "missing published_date"]}


def test_a_new_checkpoint_keeps_what_is_stored(spark, tmp_path):
    table = str(tmp_path / "table")
    for k, keys in enumerate((["a", "b"], ["b", "c"], ["c", "a", "d"])):
        source = tmp_path / f"in{k}"
        spark.createDataFrame([(x, i) for i, x in enumerate(keys)], "hash_key string, seq bigint").write.parquet(str(source))
        stream = spark.readStream.schema("hash_key string, seq bigint").parquet(str(source))
        loads.idempotent_load(stream, table, str(tmp_path / f"state{k}"), "seq").awaitTermination()
    assert sorted(r["hash_key"] for r in spark.read.parquet(table).collect()) == ["a", "b", "c", "d"]


def test_ranks_are_by_exact_score(spark):
    rows = spark.createDataFrame([(1, [1.0, 1e-4], "x"), (2, [1.0, 0.0], "x"), (3, None, "word word")], "i int, v array<double>, s string")
    assert [r["i"] for r in retrieve.vector_topk(rows.where("i < 3"), "v", "i", [1.0, 0.0], 1).collect()] == [2]
    assert [r["i"] for r in retrieve.hybrid_topk(rows, "v", "s", "i", [1.0, 0.0], ["word"], 3, 0.4).collect()] == [3, 2, 1]


@pytest.mark.parametrize("text,want", [
    ("Tue, 04 Jun 24 10:00:00 GMT", "2024-06-04T10:00:00+00:00"), ("04 Jun 99 10:00 EST", "1999-06-04T15:00:00+00:00"),
    ("Tue Jun  4 10:00:00 2024", "2024-06-04T10:00:00+00:00"), ("Tue Jun 4 10:00:00 UTC 2024", "2024-06-04T10:00:00+00:00"),
    ("2024-6-4", "2024-06-04T00:00:00+00:00"), ("2024/6/4 10:00", "2024-06-04T10:00:00+00:00"),
    ("Tue, 04 Jun 2024 10:00:00 CEST", "2024-06-04T08:00:00+00:00"), ("10:00", None), ("6/4/2024", None), ("Jun 24", None)])
def test_date_forms(values, text, want):
    assert values(lambda c: py_isoformat(parse_utc(c)), [text]) == [want]


def test_hyphenated_and_long_tag_names(values):
    long = "Text that is certainly longer than thirty characters"
    name = "x-" + "y" * 60
    pages = [f"<p-card>{long}</p-card><p>{long} 2</p>", f"<p>{long}<{name}>in</{name}> it</p>{long}"]
    assert values(page_paragraphs, pages) == [f"{long} 2", f"{long}in it"]
