"""Language of texts by Bayesian fusion of evidence.

For each row and language the logarithms of four kinds of evidence are added:

* the text: a naive Bayes model of hashed byte trigrams, counted over all rows with a declared one;
* the declared language (a markup or table field): how often each language is declared for texts of each language;
* the address: how often each address suffix goes with each language;
* the host: its share of each language, smoothed by that of its domain, which is smoothed by that of all rows.

All are counted by grouped aggregation, each row's own trigrams and vote left out. Noise competes as a
language of its own ("und") whose trigrams are all equally likely.

Languages are those declared by at least LEAST_ROWS rows with a text, and those of LANGUAGES that any row declares. A share
UNSEEN of each model goes to all trigrams alike, so that scores do not move with the size of the input.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import stage
from .common import slices

LANGUAGES = ("en", "de", "fr", "es")    # modelled from the first row on
LEAST_ROWS = 20         # rows that must declare any other language
UNSEEN = 0.01
NOISE = "und"
NO_LANGUAGE = ("", NOISE, "mul", "zxx", "none", "other")     # tags that name no language
BINS = 1 << 15
EVIDENCE = 64           # trigrams that a long text counts as: overlapping trigrams aren't independent
STRENGTH = 8.0          # rows that a parent's shares count as in those of a host or domain

_MARKUP = re.compile(r"<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[#\w]+;", re.S | re.I)
_LETTERS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def trigrams(text: str | None, markup: bool = False) -> np.ndarray:
    """Bins of the byte trigrams of a text's letters, in lower case; anything else counts as a blank."""
    text = text or ""
    if markup:
        text = _MARKUP.sub(" ", text)
    words = text.lower().encode("utf-8", "surrogatepass").translate(_LETTERS).split()
    if not words:
        return np.array([], np.int64)
    raw = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint32)
    mixed = (raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]) * np.uint32(2654435761)
    return (mixed >> np.uint32(17)).astype(np.int64)


def main_tag(value: Column) -> Column:
    return F.lower(F.trim(F.regexp_extract(F.coalesce(value, F.lit("")), r"^\s*([A-Za-z]*)", 1)))


def declared_language(value: Column, languages: tuple[str, ...] = LANGUAGES) -> Column:
    """The main part of a language tag in lower case: one of ``languages``, "other", or "none" for null and empty."""
    tag = main_tag(value)
    return F.when(tag == "", "none").when(tag.isin(*languages), tag).otherwise("other")


def evidence(ids: list[Column], text: Column, declared: Column | None = None, address: Column | None = None,
             host: Column | None = None, domain: Column | None = None) -> list[Column]:
    """Columns for ``identify``: the ids, then text, declared, suffix, host, domain and tag; missing evidence is neutral."""
    none = F.lit(None).cast("string")
    site = F.lower(F.regexp_extract(F.coalesce(address, F.lit("")), r"^[A-Za-z]+://([^/:?#]+)", 1)) if address is not None else F.lit("")
    host = F.coalesce(host.cast("string"), F.lit("")) if host is not None else site
    return [*ids, text.alias("text"), declared_language(declared if declared is not None else none).alias("declared"),
            F.regexp_extract(site, r"\.([a-z]+)$", 1).alias("suffix"), host.alias("host"),
            (domain if domain is not None else F.regexp_extract(host, r"([^.]*\.?[^.]*)$", 1)).alias("domain"),
            main_tag(declared if declared is not None else none).alias("tag")]


def declared_languages(rows: DataFrame, least: int = LEAST_ROWS) -> tuple[str, ...]:
    """The languages that rows with a text declare, those of LANGUAGES first; LANGUAGES if none."""
    found = rows.where(F.col("text").isNotNull() & ~F.col("tag").isin(*NO_LANGUAGE)).groupBy("tag").agg(F.count("*").alias("n"))
    tags = {r["tag"] for r in found.where((F.col("n") >= least) | F.col("tag").isin(*LANGUAGES)).collect()}
    return tuple([x for x in LANGUAGES if x in tags] + sorted(tags - set(LANGUAGES))) or LANGUAGES


def fit_texts(rows: DataFrame, languages: tuple[str, ...] = LANGUAGES, markup: bool = False) -> np.ndarray:
    """Counts [language, bin] of the trigrams of all rows with a declared language.

    Each task counts its own rows, and only counts are shuffled: at most len(languages) x BINS rows a task, and as many
    in all reach the driver.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((len(languages), BINS), np.int64)
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                held: dict[str, list[np.ndarray]] = {}
                for tag, text in zip(batch.column("declared").to_pylist(), batch.column("text").to_pylist()):
                    held.setdefault(tag, []).append(trigrams(text, markup))
                for tag, bins in held.items():
                    totals[languages.index(tag)] += np.bincount(np.concatenate(bins), minlength=BINS)
        who, where = np.nonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(who), pa.array(where), pa.array(totals[who, where])],
                                         names=["language", "bin", "n"])

    known = rows.where(F.col("declared").isin(*languages) & F.col("text").isNotNull()).select("declared", "text")
    table = (known.mapInArrow(count, "language long, bin long, n long").groupBy("language", "bin")
             .agg(F.sum("n").alias("n")).toArrow())
    totals = np.zeros((len(languages), BINS), np.int64)
    totals[table["language"].to_numpy(), table["bin"].to_numpy()] += table["n"].to_numpy()
    return totals


def log_chances(counts: np.ndarray, totals: np.ndarray | int) -> np.ndarray:
    """Logarithms of the chances of trigrams with such counts in models of such totals; all alike in an empty model."""
    seen = np.where(totals > 0, 1 - UNSEEN, 0.0)
    return np.log(seen * counts / np.maximum(totals, 1) + (1 - seen) / BINS)


def identify(rows: DataFrame, languages: tuple[str, ...] | None = None, markup: bool = False) -> DataFrame:
    """Per row: its id columns, declared, text_language, language, posterior, declared_posterior, n_trigrams.

    ``rows`` comes from ``evidence``: id columns, then text, declared, suffix, host, domain, tag. ``languages`` are
    those of ``declared_languages`` if not given; ``declared`` is "other" for any other language. ``language`` is the most
    probable one; "und" where noise fits better than any, or the text has no letters. A null or empty text has no text
    evidence and is "und"; null addresses, hosts and declared languages add nothing. Repeated rows and null ids give a row each.
    Ties go to the first language in order. An empty table gives an empty result. Texts are read twice (counts, scores) and
    never shuffled; scores are written once to the shared folder.
    """
    ids = rows.columns[:-6]
    languages = languages or declared_languages(rows)
    tag = F.col("tag")
    rows = rows.withColumn("declared", F.when(tag.isin(*NO_LANGUAGE), "none").when(tag.isin(*languages), tag).otherwise("other")).drop("tag")
    counts = fit_texts(rows, languages, markup)
    totals = counts.sum(axis=1)
    model = log_chances(counts, totals[:, None]).astype(np.float32)
    noise = float(-np.log(BINS))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                scores, sizes = [], []
                for text, tag in zip(batch.column("text").to_pylist(), batch.column("declared").to_pylist()):
                    bins = trigrams(text, markup)
                    n = len(bins)
                    mean = model[:, bins].mean(axis=1) if n else np.zeros(len(languages))
                    if n and tag in languages:      # the row's own trigrams don't count as evidence
                        k = languages.index(tag)
                        rest = counts[k, bins] - np.bincount(bins, minlength=BINS)[bins]
                        mean[k] = log_chances(rest, totals[k] - n).mean()
                    scores.append([float(x) * min(n, EVIDENCE) for x in mean] + [noise * min(n, EVIDENCE)])
                    sizes.append(n)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in [*ids, "declared", "suffix", "host", "domain"]),
                     pa.array(scores, pa.list_(pa.float64())), pa.array(sizes, pa.int64())],
                    names=[*ids, "declared", "suffix", "host", "domain", "scores", "n_trigrams"])

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in ids)
    scored = rows.mapInArrow(score, f"{kinds}, declared string, suffix string, host string, domain string, "
                                    "scores array<double>, n_trigrams long")
    labels = F.array(*map(F.lit, [*languages, NOISE]))
    vote = F.when(F.col("n_trigrams") == 0, F.lit(NOISE)).otherwise(
        F.element_at(labels, F.array_position("scores", F.array_max("scores")).cast("int")))
    scored = stage(scored.withColumn("vote", vote), "scores")

    k = len(languages)

    def votes(rows: DataFrame, *by: str) -> DataFrame:
        """Votes per language and group as an array."""
        return rows.groupBy(*by).agg(F.array(*[F.sum((F.col("vote") == x).cast("long")) for x in languages]).alias("votes"))

    hosts = votes(scored, "host", "domain")
    domains = (hosts.groupBy("domain").agg(F.array(*[F.sum(F.col("votes")[i]) for i in range(k)]).alias("of_domain")))
    overall = votes(scored).select(F.col("votes").alias("of_all"))
    # As a written table, so that the join reads plain shuffles on both sides and AQE can split a frequent host.
    tables = stage(hosts.withColumnRenamed("votes", "of_host").join(domains, "domain"), "hosts")
    by_declared = votes(scored, "declared").withColumnRenamed("votes", "of_declared")   # a row per language tag
    by_suffix = votes(scored, "suffix").withColumnRenamed("votes", "of_suffix")
    both = (scored.join(tables, ["host", "domain"]).join(by_declared, "declared").join(by_suffix, "suffix").crossJoin(overall))

    def others(counts: str, i: int) -> Column:
        """Votes for language i of all rows but this one."""
        return F.col(counts)[i] - (F.col("vote") == languages[i]).cast("long")

    def summed(counts: str) -> Column:
        return sum((others(counts, i) for i in range(1, k)), others(counts, 0))

    both = both.withColumns({f"sum_{c}": summed(c) for c in ("of_all", "of_domain", "of_host")})
    logs = []
    for i in range(k):
        share_all = (others("of_all", i) + 1) / (F.col("sum_of_all") + k)
        share_domain = (others("of_domain", i) + STRENGTH * share_all) / (F.col("sum_of_domain") + STRENGTH)
        share_host = (others("of_host", i) + STRENGTH * share_domain) / (F.col("sum_of_host") + STRENGTH)
        tag = F.when(F.col("declared") == "none", F.lit(0.0)).otherwise(
            F.log((others("of_declared", i) + 0.5) / (others("of_all", i) + 0.5 * (k + 1))))
        suffix = F.when(F.col("suffix") == "", F.lit(0.0)).otherwise(
            F.log((others("of_suffix", i) + 1.0) / (others("of_all", i) + float(k))))
        logs.append(F.col("scores")[i] + F.log(share_host) + tag + suffix)
    logs.append(F.col("scores")[k] + F.lit(float(np.log(0.01))))
    fused = both.withColumn("logs", F.array(*logs)).withColumn("top", F.array_max("logs"))
    chances = F.transform("logs", lambda x: F.exp(x - F.col("top")))
    fused = (fused.withColumn("chances", chances)
             .withColumn("sum", F.aggregate("chances", F.lit(0.0), lambda a, x: a + x)))
    best = F.when(F.col("n_trigrams") == 0, F.lit(NOISE)).otherwise(
        F.element_at(labels, F.array_position("logs", F.col("top")).cast("int")))
    place = F.array_position(labels, F.col("declared")).cast("int")
    return fused.select(
        *[F.col(f"`{c}`") for c in ids], "declared", F.col("vote").alias("text_language"), best.alias("language"),
        (1 / F.col("sum")).alias("posterior"),
        F.when(place > 0, F.element_at("chances", F.greatest(place, F.lit(1))) / F.col("sum")).alias("declared_posterior"),
        "n_trigrams")


def is_rejected(least: float = 1e-6) -> Column:
    """Of a row of ``identify``: its text has no letters, or the evidence rules out the language it declares.

    Any other row is kept: where a row declares no language, or one that has no model, nothing tells a language that few rows
    are in from noise.
    """
    return (F.col("n_trigrams") == 0) | F.coalesce(F.col("declared_posterior") < least, F.lit(False))
