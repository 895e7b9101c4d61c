"""Company name resolution against a catalogue of aliases.

The catalogue is an index of two kinds of keys. Every alias is a key for whole names. An alias that may stand inside a name is
also listed under its rarest word, the one that the fewest aliases have; a name that holds the alias holds that word, so a
name is compared only with the aliases listed under its words. One plan serves catalogues of any size; Spark broadcasts
what turns out to be small.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import fixed
from ..functions.text import normalize_name, py_strip, title_name
from ..session import is_staged, shared_dir, stage
from .skew import salted_join

MIN_CONTAINED = 3       # an alias must be longer than this to match as a part of a name
_WHOLE, _WORD = "=", "~"


@dataclass(frozen=True)
class Catalogue:
    """Aliases in lookup order: ``frame(alias, canonical, priority)``, each alias once, and ``index`` with a ``key`` besides."""

    frame: DataFrame
    index: DataFrame

    @staticmethod
    def from_frame(frame: DataFrame) -> Catalogue:
        """Aliases are compared in lower case; one given twice keeps its first place and its last canonical name."""
        frame = stage(frame.groupBy(F.lower("alias").alias("alias")).agg(
            F.max_by("canonical", "priority").alias("canonical"), F.min("priority").alias("priority")), "catalogue")
        return Catalogue(frame, stage(_index(frame), "alias-index"))

    @staticmethod
    def from_entries(spark: SparkSession, entries) -> Catalogue:
        """A catalogue of (alias, canonical) pairs in lookup order."""
        rows = [(a, c, i) for i, (a, c) in enumerate(entries)]
        return Catalogue.from_frame(spark.createDataFrame(rows, "alias string, canonical string, priority int"))

    @staticmethod
    def built_in(spark: SparkSession) -> Catalogue:
        """The catalogue of ``fixed``, written once for each shared folder of an application, and anew if that was emptied."""
        place = spark.sparkContext.applicationId, shared_dir(spark)
        if place not in _built_in or not is_staged(spark, _built_in[place].frame):
            _built_in[place] = Catalogue.from_entries(spark, catalogue_entries())
        return _built_in[place]


_built_in: dict[tuple[str, str], Catalogue] = {}


def _words(c: Column) -> Column:
    return F.array_distinct(F.split(c, " ", -1))


def _index(frame: DataFrame) -> DataFrame:
    """``key, alias, canonical, priority``: whole aliases, and usable ones by their rarest word."""
    words = frame.filter(F.char_length("alias") > MIN_CONTAINED).select("*", F.explode(_words(F.col("alias"))).alias("word"))
    counted = salted_join(words, words.groupBy("word").agg(F.count("*").alias("aliases")), "word", "inner")
    rarest = counted.groupBy("alias", "canonical", "priority").agg(
        F.min(F.struct(F.col("word") == "", "aliases", "word"))["word"].alias("word"))
    return (frame.select(F.concat(F.lit(_WHOLE), "alias").alias("key"), "alias", "canonical", "priority")
            .unionByName(rarest.select(F.concat(F.lit(_WORD), "word").alias("key"), "alias", "canonical", "priority")))


def catalogue_entries(catalogue: list[tuple[str, list[str]]] = fixed.CATALOGUE) -> list[tuple[str, str]]:
    """(alias, canonical) pairs; a canonical name in lower case is its own first alias."""
    found = {alias.lower(): canonical for canonical, aliases in catalogue for alias in [canonical, *aliases]}
    return list(found.items())


def _inside(keys: DataFrame, catalogue: Catalogue) -> DataFrame:
    """Of lookups (``_lower, key``, further columns) by alias or word, those whose alias is the name or stands in it."""
    stands_in = F.concat(F.lit(" "), "_lower", F.lit(" ")).contains(F.concat(F.lit(" "), "alias", F.lit(" ")))
    return salted_join(keys, catalogue.index, "key", "inner").filter(F.col("key").startswith(_WHOLE) | stands_in)


def _keys(sign: str, rank: int, words: Column) -> Column:
    return F.transform(words, lambda w: F.struct(F.lit(rank).alias("rank"), F.concat(F.lit(sign), w).alias("key")))


def _hits(df: DataFrame, name: str, catalogue: Catalogue, *keys: Column) -> DataFrame:
    """The best hit of each distinct name, (rank, priority, canonical), written so that Spark knows how many there are."""
    looked_up = (df.select(name).filter(F.col(name).isNotNull()).distinct()
                 .select(name, F.lower(py_strip(name)).alias("_lower"), F.explode(F.concat(*keys)).alias("k"))
                 .select(name, "_lower", "k.rank", "k.key"))
    return stage(_inside(looked_up, catalogue).groupBy(name).agg(
        F.min(F.struct("rank", "priority", "canonical")).alias("_hit")), "name-hits")


def _seed(df: DataFrame, key: Column, catalogue: Catalogue, out: str) -> DataFrame:
    whole = catalogue.index.filter(F.col("key").startswith(_WHOLE)).select("key", F.col("canonical").alias(out))
    return salted_join(df.withColumn("key", F.concat(F.lit(_WHOLE), key)), whole, "key").drop("key")


def seed_exact(df: DataFrame, name: str, catalogue: Catalogue) -> DataFrame:
    """Adds ``exact``: canonical name for the trimmed, lowered name."""
    return _seed(df, F.lower(py_strip(name)), catalogue, "exact")


def seed_normalized(df: DataFrame, name: str, catalogue: Catalogue) -> DataFrame:
    """Adds ``normalized``: canonical name for the name without punctuation and suffix words."""
    return _seed(df, normalize_name(F.lower(py_strip(name))), catalogue, "normalized")


def seed_substring(df: DataFrame, name: str, catalogue: Catalogue) -> DataFrame:
    """Adds ``contained``: canonical name of the first alias that stands in the name as whole blank-separated words."""
    hits = _hits(df, name, catalogue, _keys(_WORD, 2, _words(F.lower(py_strip(name)))))
    return salted_join(df, hits.select(name, F.col("_hit.canonical").alias("contained")), name)


def resolve_entities(df: DataFrame, name: str, catalogue: Catalogue) -> DataFrame:
    """Adds ``canonical``, ``method`` and ``confidence`` for the company name in column ``name``.

    Order: blank, exact alias, alias after normalising, alias contained as whole words, rule. ``df`` is read twice: names are
    looked up once each, then the best hits are joined back, with salting if there are many. Pass a written table where
    its rows are dear.
    """
    lowered = F.lower(py_strip(name))
    hits = _hits(df, name, catalogue, _keys(_WHOLE, 0, F.array(lowered)), _keys(_WHOLE, 1, F.array(normalize_name(lowered))),
                 _keys(_WORD, 2, _words(lowered)))
    joined = salted_join(df, hits, name).withColumns({
        "_lower": F.lower(py_strip(F.coalesce(F.col(name), F.lit("")))),
        "_exact": F.when(F.col("_hit.rank") == 0, F.col("_hit.canonical")),
        "_normalized": F.when(F.col("_hit.rank") == 1, F.col("_hit.canonical")),
        "_contained": F.when(F.col("_hit.rank") == 2, F.col("_hit.canonical")),
    })
    return _with_outcome(joined, name).drop("_hit")


def _with_outcome(df: DataFrame, name: str) -> DataFrame:
    steps = [
        (F.col("_lower") == "", F.lit(fixed.UNKNOWN_COMPANY), fixed.METHOD_NONE),
        (F.col("_exact").isNotNull(), F.col("_exact"), fixed.METHOD_EXACT),
        (F.col("_normalized").isNotNull(), F.col("_normalized"), fixed.METHOD_NORMALIZED),
        (F.col("_contained").isNotNull(), F.col("_contained"), fixed.METHOD_SUBSTRING),
        (F.lit(True), title_name(name), fixed.METHOD_RULE),
    ]

    def pick(value) -> Column:
        chosen = F.when(steps[0][0], value(steps[0]))
        for s in steps[1:]:
            chosen = chosen.when(s[0], value(s))
        return chosen

    return df.withColumns({
        "canonical": pick(lambda s: s[1]),
        "method": pick(lambda s: F.lit(s[2][0])),
        "confidence": pick(lambda s: F.lit(s[2][1])),
    }).drop("_lower", "_exact", "_normalized", "_contained")


def resolution_log(resolved: DataFrame, name: str, resolved_at: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """One log row per resolved row, duplicates included."""
    return resolved.select(
        F.col(name).alias("raw_name"), F.col("canonical").alias("canonical_name"), "method", "confidence",
        resolved_at.cast("timestamp").alias("resolved_at"), *keep)
