"""Dates: parsing to UTC, ISO text, relative dates, freshness."""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed
from .text import as_col, first_nonempty, let, py_strip

_HALF = r"([AaPp]\.?[Mm]\b\.?)"
_CLOCK = rf"(?:[\sT,]+(\d{{1,2}}:\d{{2}}|\d{{1,2}}(?=\s*{_HALF.replace('(', '(?:', 1)}))(:\d{{2}})?(?:\.\d+)?\s*{_HALF}?)?"
_NOTE = r"(?:\s*\([^()]*\))?"       # as in "-0700 (PDT)"
_ZONE = r"\s*\(?([A-Za-z]{1,4}|[+-]\d{2}:?\d{2})?\)?" + _NOTE
_ISO = (rf"(\d{{4}})[-/.](\d{{1,2}})[-/.](\d{{1,2}})(?:[T\s]+(\d{{1,2}}:\d{{2}})(:\d{{2}})?(?:[.,](\d{{1,9}}))?\s*{_HALF}?)?"
        r"\s*(Z|z|UTC|GMT|[+-]\d{2}(?::?\d{2})?)?" + _NOTE)
_DAY_FIRST = r"(\d{1,2})[\s-]+([A-Za-z]{3})[a-z]*\.?,?[\s-]+(\d{4}|\d{2})" + _CLOCK + _ZONE
_MONTH_FIRST = r"([A-Za-z]{3})[a-z]*\.?\s+(\d{1,2})(?:st|nd|rd|th)?,?\s+(\d{4})" + _CLOCK + _ZONE
# One pattern for all forms but the compact one. A group that took no part is empty, so each part of the rewrite
# names the groups of every form: year|month|day|hour:minute|:second|fraction|am/pm|zone.
_ANY_FORM = rf"^(?:{_ISO}|(?:[A-Za-z]{{3,9}}\.?,?\s+)?(?:{_DAY_FIRST}|{_MONTH_FIRST}))\z"
_ANY_PARTS = "$1$11$18|$2$10$16|$3$9$17|$4$12$19|$5$13$20|$6|$7$14$21|$8$15$22"
_COMPACT = (r"^(\d{4})(\d{2})(\d{2})(?:Z|[T\s]?(\d{2})(\d{2})(\d{2})?(?:[.,](\d{1,9}))?\s*(Z|UTC|GMT|[+-]\d{2}(?::?\d{2})?)?)?\z")
_COMPACT_PARTS = "$1|$2|$3|$4:$5|:$6|$7||$8"
_CLOCK_BEFORE_YEAR = r"^(?:[A-Za-z]{3},?\s+)?([A-Za-z]{3})\s+(\d{1,2})\s+(\d{1,2}:\d{2}(?::\d{2})?)(?:\s+([A-Za-z]{1,4}))?\s+(\d{4})\z"
_PLAIN_ISO = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?(?:Z|[+-]\d{2}:\d{2})\z"
_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"


def from_epoch(c) -> Column:
    return F.timestamp_seconds(as_col(c))


def _assemble(parts: Column) -> Column:
    """Timestamp of the eight parts that a form was rewritten to."""
    year, month, day, clock, second, fraction, half, zone = (parts[i] for i in range(8))
    named_month = F.floor((F.instr(F.lit(_MONTHS), F.lower(month)) + 2) / 3).cast("string")
    short = year.try_cast("int")    # two digits: 69 to 99 are of the last century, as in mail dates
    year = F.when(F.char_length(year) > 2, year).otherwise((short + F.when(short < 69, 2000).otherwise(1900)).cast("string"))
    month = F.when(month.rlike("^[0-9]"), month).otherwise(named_month)
    hour = F.substring_index(clock, ":", 1).try_cast("int")
    hour = (F.when(half == "", hour).when((hour < 1) | (hour > 12), None)
            .otherwise(hour % 12 + F.when(F.lower(half).startswith("p"), 12).otherwise(0)))
    minute = F.when(clock.contains(":"), F.substring_index(clock, ":", -1)).otherwise("00")
    clock = F.when(clock.isin("", ":"), F.lit("00:00")).otherwise(F.concat(
        F.lpad(hour.cast("string"), 2, "0"), F.lit(":"), minute))
    second = F.when(second.isin("", ":"), F.lit(":00")).otherwise(second)
    names = F.from_json(F.lit(json.dumps(fixed.ZONE_OFFSETS)), "map<string,string>")
    offset = (F.when(zone == "", F.lit("+0000"))
              .when(zone.rlike("^[+-]"), F.rpad(F.replace(zone, F.lit(":"), F.lit("")), 5, "0"))
              .otherwise(F.try_element_at(names, F.upper(zone))))
    return F.try_to_timestamp(F.concat(
        year, F.lit("-"), F.lpad(month, 2, "0"), F.lit("-"), F.lpad(day, 2, "0"), F.lit("T"), clock, second,
        F.lit("."), F.rpad(F.substring(fraction, 1, 6), 6, "0"), offset))


def parse_utc(c) -> Column:
    """Timestamp of a date text. No zone means UTC; anything that is not a full date is null.

    Plain ISO goes straight to Spark's cast. Other forms are rewritten to one list of parts first: no row pays for
    failed parsing attempts, and the text is named once per step, so the expression stays small.
    """
    def any_form(text):
        text = F.regexp_replace(text, _CLOCK_BEFORE_YEAR, "$1 $2 $5 $3 $4")
        text = F.regexp_replace(F.regexp_replace(F.rtrim(text), _ANY_FORM, _ANY_PARTS), _COMPACT, _COMPACT_PARTS)
        return let(F.split(text, r"\|"), lambda p: F.when(F.size(p) == 8, _assemble(p)))

    return let(py_strip(c), lambda text: F.when(
        text.rlike(_PLAIN_ISO), F.try_to_timestamp(text)).otherwise(any_form(text)))


def py_isoformat(c) -> Column:
    """ISO text with ``+00:00``; the fraction shows only where it is not zero. Session zone is UTC."""
    c = as_col(c).cast("timestamp")
    fraction = F.when(F.date_format(c, "SSSSSS") == "000000", F.lit("")).otherwise(
        F.date_format(c, ".SSSSSS"))
    return F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit("+00:00"))


def collected_at(run_ts: datetime) -> Column:
    """The one collection time of a run, as text."""
    return F.lit(run_ts.astimezone(timezone.utc).isoformat())


def cutoff_of(run_ts: datetime, hours: int = fixed.FRESH_HOURS) -> datetime:
    return run_ts.astimezone(timezone.utc) - timedelta(hours=hours)


def fresh_only(df: DataFrame, ts, cutoff: datetime) -> DataFrame:
    """Rows at or after ``cutoff``. Null times are dropped, future times stay."""
    return df.filter(as_col(ts) >= F.lit(cutoff))


_AGO = r"(?i)^(an?|\d{1,6})\s+(second|sec|minute|min|hour|hr|day|week|month|year)s?\s+ago\z"


def relative_date(c, reference) -> Column:
    """Time meant by "2 hours ago", "an hour ago", "yesterday", "today" or "just now"."""
    c = py_strip(c)
    word = F.lower(c)
    unit = F.substring(F.lower(F.regexp_extract(c, _AGO, 2)), 1, 3)
    amount = F.regexp_extract(c, _AGO, 1)
    n = -F.when(F.lower(amount).isin("a", "an"), 1).otherwise(amount.try_cast("int"))

    def of(*units):
        return F.when(unit.isin(*units), n).otherwise(F.lit(0))

    ago = F.make_interval(
        years=of("yea"), months=of("mon"), weeks=of("wee"), days=of("day"),
        hours=of("hou", "hr"), mins=of("min"), secs=of("sec"))
    reference = as_col(reference).cast("timestamp")
    return (F.when(c.rlike(_AGO), reference + ago)
            .when(word == "yesterday", reference - F.expr("INTERVAL 1 DAY"))
            .when(word.isin("today", "now", "just now"), reference))


_ATTRIBUTES = r"""(?:[^>"']|"[^"]*"|'[^']*')*?"""
_PUBLISHED = (rf"""(?is)<meta\b(?={_ATTRIBUTES}\sproperty\s*=\s*["']?article:published_time["'\s/>])"""
              rf"""{_ATTRIBUTES}\scontent\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")


def meta_date(html) -> Column:
    """Publication time that a page states: meta tag (its attributes in any order, quoted or not), then JSON-LD, then pubDate element."""
    html = as_col(html)
    meta = F.concat(*[F.regexp_extract(html, _PUBLISHED, i) for i in (1, 2, 3)])
    linked = F.regexp_extract(html, r"""(?is)"datePublished"\s*:\s*"([^"]*)\"""", 1)
    element = F.regexp_extract(html, r"(?is)<pubDate[^>]*>([^<]*)</pubDate>", 1)
    return parse_utc(first_nonempty(meta, linked, element))
