"""Text columns: trimming, defaults, keyword tests, names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from .. import fixed

# Characters that Unicode calls white space, plus the four separators \x1c-\x1f.
SPACE_CHARS = "".join(map(chr, [
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]))
# The same characters as a pattern; ranges keep it short, as it is tried at every character of a text.
_SPACE_RUN = r"[\t-\r\x1c- \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def py_strip(c) -> Column:
    """Trim every kind of white space, not just blanks as ``trim`` does."""
    return F.btrim(as_col(c), F.lit(SPACE_CHARS))


def squash_ws(c) -> Column:
    """Trim, and turn each inner run of white space into one blank."""
    return py_strip(F.regexp_replace(as_col(c), _SPACE_RUN, " "))


def with_default(c, default) -> Column:
    return F.coalesce(as_col(c), F.lit(default))


def first_nonempty(*cols) -> Column:
    """First column that is neither null nor the empty text."""
    return F.coalesce(*[F.nullif(as_col(c), F.lit("")) for c in cols])


def digits_to_int(c) -> Column:
    """Integer of an all-digit text; null for anything else and for zero."""
    c = as_col(c)
    return F.when(c.rlike(r"^[0-9]+\z") & (c != "0"), c.try_cast("int"))


def any_keyword(cols: Sequence, keywords: Sequence[str]) -> Column:
    """True if any keyword is a part of any of the lowered columns (null counts as empty)."""
    test = F.lit(False)
    for c in cols:
        lowered = F.lower(F.coalesce(as_col(c), F.lit("")))
        for word in keywords:
            test = test | lowered.contains(word)
    return test


def keyword_or_tag(title, tags, keywords: Sequence[str]) -> Column:
    """True if a keyword is a part of the title, or equals one whole tag."""
    lowered = F.transform(as_col(tags), lambda t: F.lower(t))
    tagged = F.arrays_overlap(lowered, F.array(*[F.lit(k) for k in keywords]))
    return any_keyword([title], keywords) | F.coalesce(tagged, F.lit(False))


def startup_topic(industry, subindustry, long_description, one_liner) -> Column:
    """The directory's topic test over industry, sub-industry and both descriptions in one text."""
    description = F.concat(
        with_default(long_description, ""), F.lit(" "), with_default(one_liner, ""))
    return any_keyword([industry, subindustry, description], fixed.STARTUP_KEYWORDS)


def company_from_title(c) -> Column:
    """Company of a "Company: Job title" text."""
    c = as_col(c)
    return F.when(c.contains(":"), py_strip(F.substring_index(c, ":", 1))).otherwise(
        F.lit(fixed.UNKNOWN_COMPANY))


def split_space_id(c) -> Column:
    """Author of an "author/product" id."""
    c = as_col(c)
    return F.when(c.contains("/"), F.substring_index(c, "/", 1)).otherwise(F.lit(fixed.NO_AUTHOR))


def space_url(c) -> Column:
    return F.concat(F.lit(fixed.SPACES_URL), as_col(c))


def author_names(c) -> Column:
    """Trimmed names of ``array<struct<name>>``, in order, entries with no name left out."""
    named = F.filter(as_col(c), lambda a: a["name"].isNotNull())
    names = F.transform(named, lambda a: py_strip(a["name"]))
    return F.coalesce(names, F.array().cast("array<string>"))


def truncate_middle(c, max_chars: int = fixed.MAX_TEXT_CHARS) -> Column:
    """Keep the first 70 % and the last 30 % of the allowed length, with a mark between."""
    c = as_col(c)
    head, tail = int(max_chars * 0.7), int(max_chars * 0.3)
    cut = F.concat(
        F.substring(c, 1, head), F.lit(fixed.TRUNCATION_MARK),
        F.substring(c, -tail, tail) if tail else c)
    return F.when(F.char_length(c) <= max_chars, c).otherwise(cut)


def normalize_name(c) -> Column:
    """Words of a name, lowered, without punctuation and legal suffix words."""
    words = F.split(F.regexp_replace(as_col(c), r"[^\p{L}\p{N}_]+", " "), " ")
    kept = F.filter(words, lambda w: (w != "") & ~F.lower(w).isin(fixed.SUFFIX_WORDS))
    return F.lower(F.array_join(kept, " "))


def title_case(c) -> Column:
    """Capital at the start of each run of letters, lower case elsewhere."""
    runs = F.regexp_extract_all(F.lower(as_col(c)), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda r: F.initcap(r)), "")


def title_name(c) -> Column:
    """Display form of a name that no catalogue entry covers."""
    c = as_col(c)
    return F.coalesce(F.nullif(F.initcap(normalize_name(c)), F.lit("")), title_case(py_strip(c)))


def chunk_paragraphs(c, max_chars: int = fixed.MAX_TEXT_CHARS, boundary: str = r"\n+") -> Column:
    """Pack the paragraphs of a text, in order, into chunks of at most ``max_chars``, each filled greedily.

    A text within the limit is one chunk, unchanged, null like an empty one; a longer one of line ends only has none. A paragraph over the limit is cut into pieces of the limit.
    Only piece sizes go through the fold; texts are joined once per chunk.
    """
    c = F.coalesce(as_col(c), F.lit(""))
    pieces = F.flatten(F.transform(
        F.filter(F.split(c, boundary), lambda p: p != ""),
        lambda p: F.transform(
            F.sequence(F.lit(0), F.floor((F.char_length(p) - 1) / max_chars).cast("int")),
            lambda i: F.substr(p, i * max_chars + 1, F.lit(max_chars)))))

    def place(state, size):
        at = state["at"] + 1
        opens = (state["used"] + 1 + size > max_chars) | (at == 1)
        return F.struct(
            at.alias("at"),
            F.when(opens, size).otherwise(state["used"] + 1 + size).alias("used"),
            F.when(opens, F.concat(state["starts"], F.array(at))).otherwise(state["starts"]).alias("starts"))

    def cut(pieces):
        start = F.struct(
            F.lit(0).alias("at"), F.lit(0).alias("used"), F.array().cast("array<int>").alias("starts"))
        starts = F.aggregate(
            F.transform(pieces, lambda p: F.char_length(p)), start, place,
            lambda s: F.concat(s["starts"], F.array(s["at"] + 1)))
        return let(starts, lambda at: F.transform(
            F.sequence(F.lit(1), F.size(at) - 1),
            lambda k: F.array_join(F.slice(
                pieces, F.element_at(at, k), F.element_at(at, k + 1) - F.element_at(at, k)), "\n")))

    return (F.when(F.char_length(c) <= max_chars, F.array(c))
            .when(F.regexp_replace(c, boundary, "") == "", F.array().cast("array<string>"))
            .otherwise(let(pieces, cut)))
