from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from signalbase.functions import dates as D
from signalbase.functions.dates import meta_date, parse_utc, py_isoformat

CASES = {
    "2024-01-02T03:04:05Z": "2024-01-02T03:04:05+00:00",
    "2024-01-02T03:04:05.000120+02:00": "2024-01-02T01:04:05.000120+00:00",
    "2024-01-02T03:04:05.123456789Z": "2024-01-02T03:04:05.123456+00:00",
    "2024-01-02 03:04:05": "2024-01-02T03:04:05+00:00", "2024-01-02": "2024-01-02T00:00:00+00:00",
    "2024/01/02 03:04": "2024-01-02T03:04:00+00:00", "2024-01-02T03:04:05+0530": "2024-01-01T21:34:05+00:00",
    "2024-01-02T03:04:05-08": "2024-01-02T11:04:05+00:00", "20240102": "2024-01-02T00:00:00+00:00",
    "20240102T030405Z": "2024-01-02T03:04:05+00:00", "202401020304": "2024-01-02T03:04:00+00:00",
    "Tue, 02 Jan 2024 03:04:05 GMT": "2024-01-02T03:04:05+00:00",
    "02 Jan 2024 03:04:05 +0200": "2024-01-02T01:04:05+00:00", "2 January 2024": "2024-01-02T00:00:00+00:00",
    "Tue, 02 Jan 2024 03:04:05 EST": "2024-01-02T08:04:05+00:00",
    "Jan 2, 2024 3:04 PM": "2024-01-02T15:04:00+00:00", "January 2nd, 2024 12:04 am": "2024-01-02T00:04:00+00:00",
    "10:00": None, "Monday": None, "2024": None, "2024-10": None, "": None, "junk": None, None: None,
    "2024-13-45": None, "Tue, 32 Jan 2024 03:04:05 GMT": None, "Tue, 02 Jan 2024 03:04:05 XYZ": None,
    "2 Foo 2024": None, "1700000000": None,
}


def test_forms(values):
    assert values(lambda c: D.py_isoformat(D.parse_utc(c)), list(CASES)) == list(CASES.values())


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.datetimes(datetime(1971, 1, 1), datetime(2100, 1, 1)), min_size=20, max_size=40),
       st.integers(-12 * 60, 14 * 60))
def test_round_trips(values, times, minutes):
    zone = timezone(timedelta(minutes=minutes))
    aware = [t.replace(tzinfo=zone) for t in times]
    want = [t.astimezone(timezone.utc).isoformat() for t in aware]
    assert values(lambda c: D.py_isoformat(D.parse_utc(c)), [t.isoformat() for t in aware]) == want
    mail = [t.strftime("%a, %d %b %Y %H:%M:%S %z") for t in aware]
    whole = [t.astimezone(timezone.utc).replace(microsecond=0).isoformat() for t in aware]
    assert values(lambda c: D.py_isoformat(D.parse_utc(c)), mail) == whole


def test_freshness_bounds(spark):
    cutoff = datetime(2024, 1, 1, 12, tzinfo=timezone.utc)
    rows = [("at", cutoff), ("before", cutoff - timedelta(microseconds=1)), ("future", cutoff + timedelta(days=999)),
            ("junk", None)]
    df = spark.createDataFrame(rows, "k string, ts timestamp")
    assert {r["k"] for r in D.fresh_only(df, "ts", cutoff).collect()} == {"at", "future"}
    assert D.cutoff_of(datetime(2024, 1, 2, 12, tzinfo=timezone.utc)) == cutoff


def test_relative(values):
    reference = F.lit("2024-03-31 12:00:00").cast("timestamp")
    said = {"2 hours ago": "2024-03-31T10:00:00+00:00", "an hour ago": "2024-03-31T11:00:00+00:00",
            "yesterday": "2024-03-30T12:00:00+00:00", "just now": "2024-03-31T12:00:00+00:00",
            "3 months ago": "2023-12-31T12:00:00+00:00", "x ago": None, None: None}
    assert values(lambda c: D.py_isoformat(D.relative_date(c, reference)), list(said)) == list(said.values())


def test_meta_date(values):
    pages = ["<meta property='article:published_time' content='2024-01-02T03:04:05Z'>\"datePublished\": \"2020-01-01\"",
             '{"datePublished":"2024-01-02"}', "<pubDate>Tue, 02 Jan 2024 03:04:05 GMT</pubDate>", "<p>x</p>"]
    assert values(lambda c: D.py_isoformat(D.meta_date(c)), pages) == [
        "2024-01-02T03:04:05+00:00", "2024-01-02T00:00:00+00:00", "2024-01-02T03:04:05+00:00", None]


@pytest.mark.parametrize("text,want", [
    ("Mon, 03 Jun 2024 17:00:00 -0700 (PDT)", "2024-06-04T00:00:00+00:00"), ("Mon, 03 Jun 2024 17:00:00 +0000 (Coordinated Universal Time)", "2024-06-03T17:00:00+00:00"),
    ("2024-06-03 5:00 PM", "2024-06-03T17:00:00+00:00"), ("2024-06-03 12:30 am", "2024-06-03T00:30:00+00:00"), ("2024-06-03T5:00", "2024-06-03T05:00:00+00:00"),
    ("20240603T170000+0200", "2024-06-03T15:00:00+00:00"), ("20240603T170000.25Z", "2024-06-03T17:00:00.250000+00:00"), ("20240603 1700", "2024-06-03T17:00:00+00:00"),
    ("2024.06.03", "2024-06-03T00:00:00+00:00"), ("2024.6.3 7:05", "2024-06-03T07:05:00+00:00"), ("June 3, 2024 5 p.m.", "2024-06-03T17:00:00+00:00"),
    ("3 June 2024, 11 AM", "2024-06-03T11:00:00+00:00"), ("2024-06-03 13:00 PM", None), ("2024-06-03 5", None), ("20240603-12", None), ("1.2.3", None)])
def test_further_date_forms(values, text, want):
    assert values(lambda c: py_isoformat(parse_utc(c)), [text]) == [want]


@pytest.mark.parametrize("page,want", [
    ('<meta content="2024-06-03T10:00:00Z" property="article:published_time">', "2024-06-03T10:00:00+00:00"),
    ("<META name=x content=2024-06-03T10:00:00Z property=article:published_time />", "2024-06-03T10:00:00+00:00"),
    ("<meta property=article:published_time content='3 Jun 2024'>", "2024-06-03T00:00:00+00:00"),
    ('<meta property="og:title" content="a > b"><meta data-content="1999-01-01" content="2024-06-03" property="article:published_time"/>', "2024-06-03T00:00:00+00:00"),
    ('<meta property="article:published_time_old" content="2024-06-03">', None), ('<meta content="2024-06-03"><meta property="article:published_time">', None)])
def test_meta_tags_in_any_order(values, page, want):
    assert values(lambda c: py_isoformat(meta_date(c)), [page]) == [want]
