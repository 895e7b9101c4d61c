"""Article text of an HTML page, with Spark's array functions only."""

from __future__ import annotations

import json
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column, functions as F

from .. import fixed
from .text import as_col, let, py_strip, squash_ws

# The contents of these elements are no markup, so they end at their first closing tag, or with the page.
_RAW = r"(?is)<!--.*?-->|<(script|style)(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\z)"
_DROPPED = [tag for tag in fixed.PAGE_NOISE_TAGS if tag not in ("script", "style")]
_TOKEN = r"""<[A-Za-z/!?](?:[^'">]++|"[^"]*+"|'[^']*+')*+>|[^<]+|<"""
_TAG_NAME = r"^<(/?[A-Za-z][^\s/>]*)"
_SPANS = "array<struct<first:int,last:int,name:string>>"
_BAR, _AT = "\x01", "\x02"      # around an entry of the list of open elements, and between its name and its place
_PART = 64                      # spans that are gathered before they are put aside, so that no long array is copied at each tag

_NAMES = {name.removesuffix(";"): chars for name, chars in html5.items() if name.endswith(";")}
_BARE = sorted((name for name in html5 if not name.endswith(";")), key=len, reverse=True)    # may stand without semicolon
_ENTITY = r"^(#[xX][0-9A-Fa-f]+|#\d+|[A-Za-z][A-Za-z0-9]*(?=;)|" + "|".join(_BARE) + ")"
# Codes 128 to 159 stand for the characters of Windows-1252, or for themselves where it has none.
_REMAPPED = "".join(bytes([c]).decode("cp1252", "ignore") or chr(c) for c in range(128, 160))


def _character(code: Column) -> Column:
    """Character of a numeric reference: U+FFFD outside Unicode, nothing for control codes and non-characters."""
    none = (code.between(1, 8) | (code == 11) | code.between(14, 31) | (code == 127) | code.between(0xFDD0, 0xFDEF)
            | (code.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE))
    return (F.when(code.between(128, 159), F.substr(F.lit(_REMAPPED), code - 127, F.lit(1)))
            .when((code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF), F.lit("\ufffd"))
            .when(none, F.lit("")).otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")))


def unescape(c) -> Column:
    """Characters for numeric and named references of HTML5, in one pass over the text; unknown ones stay."""
    common = F.from_json(F.lit(json.dumps({**fixed.ENTITIES, "amp": "&"})), "map<string,string>")
    names = F.from_json(F.lit(json.dumps(_NAMES)), "map<string,string>")

    def number(digits: Column, most: int, base: int) -> Column:
        plain = F.regexp_replace(digits, "^0+", "")
        return F.when(plain == "", 0).when(F.char_length(plain) > most, 0x110000).otherwise(
            F.conv(plain, base, 10).try_cast("int"))

    def character(entity: Column) -> Column:
        return (F.when(entity.rlike("^#[xX]"), let(number(F.substr(entity, F.lit(3)), 6, 16), _character))
                .when(entity.startswith("#"), let(number(F.substr(entity, F.lit(2)), 7, 10), _character))
                .otherwise(F.coalesce(F.try_element_at(common, entity), F.try_element_at(names, entity))))

    def decoded(piece: Column) -> Column:
        # The longest name that may stand without a semicolon is tried where the whole name is unknown.
        return let(F.regexp_extract(piece, _ENTITY, 1), lambda whole: let(
            F.when((whole == "") | whole.startswith("#") | F.try_element_at(names, whole).isNotNull(), whole)
            .otherwise(F.regexp_extract(piece, "^(" + "|".join(_BARE) + ")", 1)), lambda entity: let(
                F.when(entity != "", character(entity)), lambda char: F.when(char.isNull(), F.concat(F.lit("&"), piece))
                .otherwise(F.concat(char, F.regexp_replace(F.substr(piece, F.char_length(entity) + 1), "^;", ""))))))

    return let(as_col(c), lambda text: F.when(~text.contains("&"), text).otherwise(
        let(F.split(text, "&"), lambda pieces: F.concat(pieces[0], F.array_join(
            F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), decoded), "")))))


def paragraph_texts(html) -> Column:
    """Text of every ``<p>`` in page order.

    An unclosed ``<p>`` runs on to the end of its parent, so its text holds that of the paragraphs inside it.
    Noise elements are left out with all that is in them; an unclosed one ends with its parent too.

    One pass over the tags keeps the open elements as one text, the newest first, and notes the first and last token of each
    ``<p>`` and of each noise element that is in no other. Noise is then cut out of the token list in one go, so that
    a paragraph is the join of a slice. The work grows with the page and the texts, not with their square.
    """
    clean = F.regexp_replace(as_col(html), _RAW, "")
    return let(F.regexp_extract_all(clean, F.lit(_TOKEN), F.lit(0)), _paragraphs_of)


def _tag_of(token: Column, at: Column) -> Column:
    """Place and name of a tag: ``p`` for an opening one, ``/p`` for a closing one, empty where nothing is held."""
    name = F.when(token.startswith("<"), F.lower(F.regexp_extract(token, _TAG_NAME, 1))).otherwise(F.lit(""))
    return F.struct((at + 1).alias("at"), F.when(token.endswith("/>") | name.isin(fixed.VOID_TAGS), F.lit("")).otherwise(
        F.translate(name, _BAR + _AT, "__")).alias("name"))


def _state(opened: Column, aside: Column, spans: Column) -> Column:
    return F.struct(opened.alias("open"), aside.alias("aside"), spans.alias("spans"))


def _step(state: Column, tag: Column, dropped: list[str]) -> Column:
    """``open`` is |name@place|name@place|, the newest element first, so the first hit of a name is its last open element."""
    opened, aside, spans = state["open"], state["aside"], state["spans"]
    pushed = F.concat(F.lit(_BAR), tag["name"], F.lit(_AT), tag["at"].cast("string"), opened)
    hit = F.instr(opened, F.concat(F.lit(_BAR), F.substr(tag["name"], F.lit(2)), F.lit(_AT)))

    def closed(place: Column) -> Column:
        end = F.call_function("locate", F.lit(_BAR), opened, place + 1)
        gone = F.concat(spans, _ended(F.substr(opened, F.lit(1), end), F.substr(opened, end), tag["at"], dropped))
        return let(gone, lambda now: F.when(F.size(now) < _PART, _state(F.substr(opened, end), aside, now)).otherwise(
            _state(F.substr(opened, end), F.concat(aside, F.array(now)), F.array().cast(_SPANS))))

    return F.when(~tag["name"].startswith("/"), _state(pushed, aside, spans)).otherwise(
        let(hit, lambda place: F.when(place == 0, state).otherwise(closed(place))))


def _ended(popped: Column, left: Column, at: Column, dropped: list[str]) -> Column:
    """Token spans of the ``<p>`` elements in ``popped``, and of its outermost noise element if none in ``left`` holds that."""
    span = lambda e: F.struct(F.substring_index(e, _AT, -1).cast("int").alias("first"), at.alias("last"),
                              F.substring_index(e, _AT, 1).alias("name"))
    noise = "(" + "|".join(dropped) + ")" + _AT
    none = F.array().cast(_SPANS)
    found = F.split(popped, _BAR)
    paragraphs = F.when(popped.contains(f"{_BAR}p{_AT}"), F.transform(F.filter(found, lambda e: e.startswith(f"p{_AT}")), span)).otherwise(none)
    outer = F.when(popped.rlike(_BAR + noise) & ~left.rlike(_BAR + noise), F.transform(
        F.slice(F.filter(found, lambda e: e.rlike("^" + noise)), -1, 1), span)).otherwise(none)
    return F.concat(paragraphs, outer)


def _spans_of(tokens: Column, dropped: list[str]) -> Column:
    """Sorted spans of the ``<p>`` elements and of the outermost elements named in ``dropped``."""
    start = _state(F.lit(_BAR), F.array().cast(f"array<{_SPANS}>"), F.array().cast(_SPANS))
    tags = F.filter(F.transform(tokens, _tag_of), lambda t: t["name"] != "")
    return F.aggregate(tags, start, lambda s, t: _step(s, t, dropped), lambda s: F.array_sort(F.flatten(F.concat(
        s["aside"], F.array(s["spans"], _ended(s["open"], F.lit(""), F.size(tokens) + 1, dropped))))))


def _paragraphs_of(tokens: Column) -> Column:
    return let(_spans_of(tokens, _DROPPED), lambda spans: let(F.filter(spans, lambda s: s["name"] != "p"), lambda noise: let(
        _without(tokens, noise), lambda kept: _texts_of(kept, spans))))


def page_text(html) -> Column:
    """The text of a page without scripts, styles, navigation bars and drawings; a blank line wherever markup breaks it."""
    clean = F.regexp_replace(as_col(html), _RAW, "")

    def broken(tag: Column) -> Column:
        return F.when(F.regexp_replace(F.lower(F.regexp_extract(tag, _TAG_NAME, 1)), "^/", "").isin(fixed.INLINE_TAGS), "").otherwise("\n")

    def text_of(tokens: Column) -> Column:
        kept = let(F.filter(_spans_of(tokens, fixed.BOILERPLATE_TAGS), lambda s: s["name"] != "p"), lambda noise: _without(tokens, noise, broken))
        lines = F.transform(F.split(unescape(F.array_join(kept, "")), "\n"), squash_ws)
        return F.array_join(F.filter(lines, lambda line: line != ""), "\n\n")

    return let(F.regexp_extract_all(clean, F.lit(_TOKEN), F.lit(0)), text_of)


def _without(tokens: Column, noise: Column, shown: Callable[[Column], Column] = lambda tag: F.lit("")) -> Column:
    """The tokens, null inside noise, and ``shown`` (by default empty) where they are tags. Noise spans are sorted and apart."""
    def before(k: Column) -> Column:
        return F.coalesce(F.get(noise, k - 1)["last"], F.lit(1))

    pieces = F.transform(noise, lambda n, k: F.concat(
        F.slice(tokens, before(k), n["first"] - before(k)), F.array_repeat(F.lit(None).cast("string"), n["last"] - n["first"])))
    rest = let(before(F.size(noise)), lambda at: F.slice(tokens, at, F.greatest(F.size(tokens) - at + 1, F.lit(0))))
    whole = F.when(F.size(noise) == 0, tokens).otherwise(F.flatten(F.concat(pieces, F.array(rest))))
    return F.transform(whole, lambda t: F.when(t.startswith("<") & t.rlike(r"^</?[A-Za-z!?]"), shown(t)).otherwise(t))


def _texts_of(kept: Column, spans: Column) -> Column:
    return F.transform(
        F.filter(spans, lambda s: (s["name"] == "p") & F.get(kept, s["first"] - 1).isNotNull()),
        lambda s: py_strip(unescape(F.array_join(F.slice(kept, s["first"] + 1, s["last"] - s["first"] - 1), ""))))


def page_paragraphs(html) -> Column:
    """Paragraphs of over 30 characters, joined by a blank line; empty text if there is none."""
    kept = F.filter(paragraph_texts(html), lambda p: F.char_length(p) > fixed.MIN_PARAGRAPH_CHARS)
    return F.coalesce(F.array_join(kept, "\n\n"), F.lit(""))
