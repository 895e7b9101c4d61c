import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from signalbase import fixed
from signalbase.functions.text import normalize_name, title_name
from signalbase.operators import resolve as R

GOLDENS = {
    "OpenAI": ("OpenAI", "SEED_EXACT", 1.0), "Open AI": ("OpenAI", "SEED_EXACT", 1.0),
    "OpenAI, Inc.": ("OpenAI", "SEED_EXACT", 1.0), "openai inc": ("OpenAI", "SEED_EXACT", 1.0),
    "Anthropic PBC": ("Anthropic", "SEED_EXACT", 1.0), "anthropic ai": ("Anthropic", "SEED_EXACT", 1.0),
    "Anthropic": ("Anthropic", "SEED_EXACT", 1.0),
    "Future Autonomous Labs Inc.": ("Future Autonomous", "RULE_NORMALIZATION", 0.8),
    None: ("Unknown", "NONE", 0.0), "": ("Unknown", "NONE", 0.0), " \t ": ("Unknown", "NONE", 0.0),
    "Unknown": ("Unknown", "RULE_NORMALIZATION", 0.8),
    "Cursor AI Inc": ("Anysphere", "SEED_NORMALIZED", 0.95),
    "Hugging Face, Inc.": ("Hugging Face", "SEED_NORMALIZED", 0.95),
    "Lambda Technologies": ("Lambda Labs", "SEED_NORMALIZED", 0.95),
    "Together AI Inc.": ("Together AI", "SEED_SUBSTRING", 0.9),
    "the together  ai people": ("The Together People", "RULE_NORMALIZATION", 0.8),
    "Scale AI, Inc": ("Scale", "RULE_NORMALIZATION", 0.8),
    "AI-Labs": ("Ai-Labs", "RULE_NORMALIZATION", 0.8), "!!!": ("!!!", "RULE_NORMALIZATION", 0.8),
    "Writer": ("Writer", "SEED_EXACT", 1.0), "  MODAL \n": ("Modal", "SEED_EXACT", 1.0),
    "Suno and Udio": ("Suno", "SEED_SUBSTRING", 0.9),
}


def outcome(df):
    return {r["n"]: (r["canonical"], r["method"], r["confidence"]) for r in df.collect()}


def test_goldens(spark):
    df = spark.createDataFrame([(n,) for n in GOLDENS], "n string")
    assert outcome(R.resolve_entities(df, "n", R.Catalogue.built_in(spark))) == GOLDENS


def test_catalogue_shape():
    entries = R.catalogue_entries()
    assert len({c for _, c in entries}) == 48 and len(entries) == 124
    assert entries[0] == ("openai", "OpenAI") and not [a for a, _ in entries if len(a) <= 3]


def test_user_catalogue_keeps_order_and_length_guard(spark):
    frame = spark.createDataFrame(
        [("XYZ", "Short", 0), ("big data", "Big", 1), ("data house", "House", 2)],
        "alias string, canonical string, priority int")
    df = spark.createDataFrame([("my xyz shop",), ("the big data house",), ("xyz",)], "n string")
    want = {"my xyz shop": ("My Xyz Shop", "RULE_NORMALIZATION", 0.8),
            "the big data house": ("Big", "SEED_SUBSTRING", 0.9), "xyz": ("Short", "SEED_EXACT", 1.0)}
    assert outcome(R.resolve_entities(df, "n", R.Catalogue.from_frame(frame))) == want


def test_aliases_with_pattern_signs(spark):
    entries = [("c++ (labs)", "Plus"), (r"a\E|b", "Odd"), ("x.y?", "Dot")]
    df = spark.createDataFrame([("the C++ (Labs) team",), (r"on a\E|b here",), ("an xay now",)], "n string")
    out = outcome(R.resolve_entities(df, "n", R.Catalogue.from_entries(spark, entries)))
    assert [out[n][0] for n in ("the C++ (Labs) team", r"on a\E|b here")] == ["Plus", "Odd"]
    assert out["an xay now"][1] == "RULE_NORMALIZATION"


def test_hot_name_keeps_every_row(spark):
    df = spark.range(3000).withColumn("n", F.when(F.col("id") % 3 == 0, "The Groq team").otherwise(
        F.concat(F.lit("Firm "), F.col("id"))))
    catalogue = R.Catalogue.built_in(spark)
    out = R.resolve_entities(df, "n", catalogue)
    assert out.count() == 3000 and out.filter("canonical = 'Groq'").count() == 1000
    assert out.select("id").distinct().count() == 3000


def test_log_keeps_duplicates(spark):
    df = spark.createDataFrame([("Groq",), ("Groq",)], "n string")
    log = R.resolution_log(R.resolve_entities(df, "n", R.Catalogue.built_in(spark)), "n", F.current_timestamp())
    assert log.count() == 2 and log.columns == [
        "raw_name", "canonical_name", "method", "confidence", "resolved_at"]


def spec_normal(text):
    kept = "".join(ch if ch.isalnum() or ch == "_" else " " for ch in text)
    return " ".join(w for w in kept.split() if w.lower() not in fixed.SUFFIX_WORDS).lower()


NAMES = st.lists(st.one_of(
    st.text(alphabet="abcXYZ äÖéß09_-.,&'\t AI", max_size=25),
    st.lists(st.sampled_from(["AI", "Labs", "inc.", "Groq", "Café", "Scale", "x-1", "GmbH", ","]), max_size=5).map(
        " ".join)), min_size=30, max_size=60)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(NAMES)
def test_normal_form_and_title_match_a_plain_spec(values, names):
    assert values(normalize_name, names) == [spec_normal(n) for n in names]
    want = [" ".join(w.capitalize() for w in spec_normal(n).split()) or n.strip().title() for n in names]
    assert values(title_name, names) == want


def plain_contained(name, aliases):
    padded = f" {name.strip().lower()} "
    return next((c for a, c in aliases if len(a) > 3 and f" {a} " in padded), None)


def test_large_catalogue_of_long_aliases(spark):
    """100,000 aliases of up to 12 words from a small vocabulary, and names that hold some of them; words repeat in most."""
    rng = random.Random(5)
    words = ["inc", "the", "of", "labs"] + [f"w{i}" for i in range(400)]
    aliases = list(dict.fromkeys(" ".join(rng.choices(words, k=rng.randint(1, 12))) for _ in range(100_000)))
    entries = [(a, f"C{i}") for i, a in enumerate(aliases)]
    names = []
    for _ in range(250):
        held = " ".join(rng.choice(aliases).split(" ") + rng.choices(words, k=2)) if rng.random() < .6 else " ".join(rng.choices(words, k=6))
        names.append(f"x {held}  y")
    catalogue = R.Catalogue.from_entries(spark, entries)
    by_word = catalogue.index.filter("key LIKE '~%'").groupBy("key").count().agg(F.max("count")).first()[0]
    assert catalogue.index.count() <= 2 * len(aliases) and by_word < len(aliases) / 50      # no word lists many aliases
    df = spark.createDataFrame([(n,) for n in set(names)], "n string")
    got = {r["n"]: r["contained"] for r in R.seed_substring(df, "n", catalogue).collect()}
    assert got == {n: plain_contained(n, entries) for n in set(names)} and sum(v is not None for v in got.values()) > 100


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(NAMES)
def test_contained_aliases_match_a_plain_search(spark, names):
    df = spark.createDataFrame([(n,) for n in set(names)], "n string")
    got = {r["n"]: r["contained"] for r in R.seed_substring(df, "n", R.Catalogue.built_in(spark)).collect()}
    for n in set(names):
        assert got[n] == plain_contained(n, R.catalogue_entries())
