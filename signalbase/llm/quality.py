"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

A rule bounds one measure by a share of another: ``100 * measure <= per_cent * of + slack`` ("at most"), or with ``>=``
and ``- slack`` ("at least"). Whole numbers only, so a verdict never hangs on rounding. All measures of a text are
computed in one expression; each list in it (words, lines, windows) is bound once, so nothing is split twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from .common import GAP

WINDOW = 5
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Function words of the corpus's languages; a word counts if it is one of them in lower case.
STOP_WORDS = tuple(("the of and to in a is that for it was on as with at by be this are or an from "
                    "der die und das den von mit zu ein im ist für auf nicht eine des dem sich auch als "
                    "la le de les et un est que en une dans du pour pas au par sur ne se "
                    "el los las por con del una y al lo su para como más no").split())


class Rule(NamedTuple):
    name: str
    measure: str
    bound: str              # "at least" or "at most"
    per_cent: int
    of: str | None = None   # None: of one
    slack: int = 0          # in hundredths of the measure's unit


BASE = (
    Rule("words", "n_words", "at least", 1000),
    Rule("repeated words", "n_repeat_words", "at most", 20, "n_words"),
)
RULES = (
    Rule("short words", "word_chars", "at least", 200, "n_words"),
    Rule("long words", "word_chars", "at most", 1500, "n_words"),
    Rule("symbols", "n_symbols", "at most", 20, "n_words"),
    Rule("stop words", "n_stop_words", "at least", 2, "n_words", 100),   # none is needed in 50 words or fewer
    Rule("repeated lines", "n_dup_lines", "at most", 30, "n_lines", 100),
    Rule("bullet lines", "n_bullet_lines", "at most", 90, "n_lines", 100),
    Rule("cut lines", "n_cut_lines", "at most", 30, "n_lines", 100),
)
MEASURES = ("n_words", "word_chars", "n_symbols", "n_stop_words", "n_lines", "n_dup_lines", "n_bullet_lines", "n_cut_lines",
            "n_repeat_words")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """Words that lie in windows of ``width`` words found at least twice.

    Windows are hashed; only where two hashes are equal are windows sorted by hash and words, so that equal ones are
    neighbours and are compared word by word. The sorted starts then give the length of their union.
    """
    starts = F.when(F.size(words) >= width, F.sequence(F.lit(1), F.size(words) - (width - 1))).otherwise(F.array().cast("array<int>"))

    def window(i: Column) -> list[Column]:
        return [F.get(words, i + (k - 1)) for k in range(width)]

    def equal(s: Column, j: Column, k: Column) -> Column:
        a, b = F.get(s, j), F.get(s, k)
        return (a["h"] == b["h"]) & (a["g"] == b["g"])

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, j: F.least(F.lit(width), F.coalesce(F.get(p, j + 1) - x, F.lit(width))))
        return F.aggregate(steps, F.lit(0), lambda total, x: total + x)

    def exact(hashes: Column) -> Column:
        rows = F.sort_array(F.transform(hashes, lambda h, i: F.struct(
            h.alias("h"), F.struct(*[w.alias(f"w{k}") for k, w in enumerate(window(i + 1))]).alias("g"), i.alias("i"))))
        return let(rows, lambda s: let(F.sort_array(F.transform(F.filter(
            F.transform(s, lambda x, j: F.struct(x["i"].alias("i"), (F.coalesce(equal(s, j, j + 1), F.lit(False))
                                                 | F.coalesce(equal(s, j, j - 1), F.lit(False))).alias("found"))),
            lambda x: x["found"]), lambda x: x["i"])), covered))

    return let(F.transform(starts, lambda i: F.xxhash64(*window(i))),
               lambda hashes: F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(exact(hashes)))


def measures(text: Column) -> Column:
    """A struct of MEASURES of the whole ``text``; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, GAP), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(r"[^\x20\x09-\x0D]")))

    def of(w: Column, l: Column) -> Column:
        found = {
            "n_words": F.size(w),
            "word_chars": _without(text, SPACE),
            "n_symbols": F.length(text) - _without(text, SYMBOLS),
            "n_stop_words": F.size(F.filter(w, lambda x: F.lower(x).isin(*STOP_WORDS))),
            "n_lines": F.size(l),
            "n_dup_lines": F.size(l) - F.size(F.array_distinct(l)),
            "n_bullet_lines": F.size(F.filter(l, lambda x: F.rlike(x, F.lit(r"^[\x20\t]*[-*•]")))),
            "n_cut_lines": F.size(F.filter(l, lambda x: F.rlike(x, F.lit(r"(\.\.\.|…)[\x20\t\r]*\z")))),
            "n_repeat_words": repeated_words(w),
        }
        return F.struct(*[found[name].cast("long").alias(name) for name in MEASURES])

    return let(words, lambda w: let(lines, lambda l: of(w, l)))


def holds(rule: Rule, measure: Callable[[str], Column]) -> Column:
    left, share = measure(rule.measure) * 100, (measure(rule.of) if rule.of else F.lit(1)) * rule.per_cent
    return left >= share - rule.slack if rule.bound == "at least" else left <= share + rule.slack


def judge(docs: DataFrame, base: Sequence[Rule] = BASE, rules: Sequence[Rule] = RULES, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, MEASURES, failed (names of all rules that do not hold), base_failed and kept.

    One projection without a shuffle; the rows come in the order of the table. Null, empty and blank texts have zero words and
    fail the rule on words. Repeated rows, repeated and null ids give a row each. Other columns are not read. An empty
    table gives an empty result. A text is held whole by one task, with about 150 bytes a word while its windows are
    compared, which happens only where two windows have the same hash.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), measures(F.col(text_col)).alias("m"))
    ok = {rule.name: holds(rule, lambda name: F.col(f"m.{name}")) for rule in (*base, *rules)}
    verdict = lambda names: reduce(lambda a, b: a & b, names, F.lit(True))
    failed = F.filter(F.array(*[F.when(~held, F.lit(name)) for name, held in ok.items()]), lambda name: name.isNotNull())
    return rows.select("doc_id", "m.*", failed.alias("failed"),
                       (~verdict([ok[r.name] for r in base])).alias("base_failed"), verdict(ok.values()).alias("kept"))
