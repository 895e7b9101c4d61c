"""Date texts in many forms, drawn from the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates
from .base import Tables, iso_sql, query

_SEC = "date_trunc('second', ts)"
# UTC time meant by each written form.
WRITTEN_SQL = f"""written AS (SELECT event_id, ts, CASE event_id % 16
    WHEN 0 THEN ts WHEN 1 THEN ts - INTERVAL 2 HOUR WHEN 2 THEN {_SEC} WHEN 3 THEN {_SEC}
    WHEN 4 THEN {_SEC} - INTERVAL 2 HOUR WHEN 5 THEN date_trunc('day', ts) WHEN 6 THEN NULL WHEN 7 THEN NULL
    WHEN 8 THEN date_trunc('minute', ts) WHEN 9 THEN {_SEC} + INTERVAL 5 HOUR
    WHEN 11 THEN {_SEC} + INTERVAL 7 HOUR WHEN 12 THEN date_trunc('minute', ts) WHEN 13 THEN {_SEC} - INTERVAL 2 HOUR
    WHEN 14 THEN date_trunc('day', ts) WHEN 15 THEN date_trunc('minute', ts) ELSE NULL END AS utc FROM events)"""


def written(t: Tables):
    form = F.col("event_id") % 16

    def shown(pattern):
        return F.date_format("ts", pattern)

    raw = (F.when(form == 0, shown("yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
           .when(form == 1, shown("yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+02:00'"))
           .when(form == 2, shown("yyyy-MM-dd HH:mm:ss"))
           .when(form == 3, shown("EEE, dd MMM yyyy HH:mm:ss 'GMT'"))
           .when(form == 4, shown("d MMM yyyy HH:mm:ss '+0200'"))
           .when(form == 5, shown("yyyy-MM-dd"))
           .when(form == 6, F.lit("not a date"))
           .when(form == 7, F.lit(""))
           .when(form == 8, shown("MMM d, yyyy h:mm a"))
           .when(form == 9, shown("EEE, dd MMM yyyy HH:mm:ss 'EST'"))
           .when(form == 11, shown("EEE, dd MMM yyyy HH:mm:ss '-0700 (PDT)'"))
           .when(form == 12, shown("yyyy-MM-dd h:mm a"))
           .when(form == 13, shown("yyyyMMdd'T'HHmmss'+0200'"))
           .when(form == 14, shown("yyyy.MM.dd"))
           .when(form == 15, shown("yyyy-MM-dd'T'H:mm"))
           .otherwise(shown("HH:mm")))
    return t.events.select("event_id", "ts", raw.alias("raw"))


@query(f"WITH {WRITTEN_SQL} SELECT event_id, {iso_sql('utc')} AS utc FROM written")
def parse_utc(t: Tables):
    return written(t).select("event_id", dates.py_isoformat(dates.parse_utc("raw")).alias("utc"))


@query(f"""SELECT event_id, {iso_sql('ts')} AS iso, {iso_sql("date_trunc('second', ts)")} AS whole FROM events""")
def py_isoformat(t: Tables):
    return t.events.select(
        "event_id", dates.py_isoformat("ts").alias("iso"),
        dates.py_isoformat(F.date_trunc("second", "ts")).alias("whole"))


@query(f"""SELECT o_orderkey, {iso_sql("o_orderdate + to_seconds(o_orderkey)")} AS utc FROM orders
    WHERE o_orderkey % 7 NOT IN (0, 1)""")
def from_epoch(t: Tables):
    """Epoch seconds, with missing and zero ones skipped."""
    rest = F.col("o_orderkey") % 7
    epoch = F.when(rest == 1, F.lit(0)).when(rest != 0, F.unix_timestamp("o_orderdate") + F.col("o_orderkey"))
    landed = t.orders.select("o_orderkey", epoch.alias("created_at"))
    return landed.filter(F.coalesce("created_at", F.lit(0)) != 0).select(
        "o_orderkey", dates.py_isoformat(dates.from_epoch("created_at")).alias("utc"))


@query(f"""WITH {WRITTEN_SQL} SELECT event_id, {iso_sql('utc')} AS utc FROM written
    WHERE utc >= TIMESTAMP '2024-01-15 06:00:00'""")
def fresh_only(t: Tables):
    from datetime import datetime, timezone
    parsed = written(t).withColumn("utc", dates.parse_utc("raw"))
    return dates.fresh_only(parsed, "utc", datetime(2024, 1, 15, 6, tzinfo=timezone.utc)).select(
        "event_id", dates.py_isoformat("utc").alias("utc"))


@query(f"""SELECT event_id, {iso_sql('''CASE event_id % 6
    WHEN 0 THEN ts - to_hours(event_id % 40 + 1) WHEN 1 THEN ts - INTERVAL 1 DAY WHEN 2 THEN ts - INTERVAL 1 HOUR
    WHEN 3 THEN ts - to_days(CAST((event_id % 9 + 1) * 7 AS INTEGER)) WHEN 4 THEN ts ELSE NULL END''')} AS utc
    FROM events""")
def relative_date(t: Tables):
    key = F.col("event_id")
    said = (F.when(key % 6 == 0, F.concat(key % 40 + 1, F.lit(" hours ago")))
            .when(key % 6 == 1, F.lit("Yesterday")).when(key % 6 == 2, F.lit("an hour ago"))
            .when(key % 6 == 3, F.concat(key % 9 + 1, F.lit(" weeks ago")))
            .when(key % 6 == 4, F.lit(" just now ")).otherwise(F.lit("some time ago")))
    return t.events.select("event_id", dates.py_isoformat(dates.relative_date(said, "ts")).alias("utc"))


_NOON = "TIMESTAMP '2024-01-01 12:00:00'"


@query(f"""SELECT page_id, CASE WHEN page_id % 4 = 3 THEN NULL
    ELSE {iso_sql(f"{_NOON} + to_hours(page_id % 500)")} END AS utc FROM pages""")
def meta_date(t: Tables):
    stamp = F.timestamp_seconds(F.lit(1704110400) + F.col("page_id") % 500 * 3600)
    iso = F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    mail = F.date_format(stamp, "EEE, dd MMM yyyy HH:mm:ss 'GMT'")
    rest = F.col("page_id") % 4
    head = (F.when(rest == 0, F.concat(
                F.lit('<meta property="article:published_time" content="'), iso, F.lit('"/>')))
            .when(rest == 1, F.concat(
                F.lit('<script type="application/ld+json">{"@type":"NewsArticle","datePublished": "'), iso,
                F.lit('"}</script>')))
            .when(rest == 2, F.concat(F.lit("<pubDate>"), mail, F.lit("</pubDate>")))
            .otherwise(F.lit("<!-- no date -->")))
    return t.pages.select("page_id", dates.py_isoformat(dates.meta_date(F.concat(head, "html"))).alias("utc"))
