"""Record contract: rows that break it go to quarantine with their reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed

_REQUIRED = {
    "startups": ["content.entityName", "source.name", "source.url", "collectedAt"],
    "products": ["content.startupName", "content.pricingModel", "source.name", "source.url", "collectedAt"],
    "research_papers": ["content.title", "content.authors", "content.paper_url", "content.published_date"],
    "jobs": ["content.company", "content.date", "content.is_remote", "content.role_family", "source_url"],
    "news": ["content.title", "content.text", "content.published_date", "source.name", "source.url", "collectedAt"],
}


def broken_rules(kind: str) -> Column:
    """Names of the rules a record breaks, in rule order."""
    rules = [(f"missing {path}", F.col(path).isNull()) for path in _REQUIRED[kind]]
    if kind == "products":
        rules.append(("unknown content.pricingModel", ~F.col("content.pricingModel").isin(fixed.PRICING_MODELS)))
    if kind == "research_papers":
        rules.append(("null in content.authors", F.exists("content.authors", lambda a: a.isNull())))
    return F.filter(
        F.array(*[F.when(test, F.lit(name)) for name, test in rules]), lambda r: r.isNotNull())


def checked(records: DataFrame, kind: str) -> DataFrame:
    """Adds ``reasons``, empty for good rows."""
    return records.withColumn("reasons", broken_rules(kind))


def split_checked(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with ``reasons``) of checked rows."""
    return rows.filter(F.size("reasons") == 0).drop("reasons"), rows.filter(F.size("reasons") > 0)


def validate(records: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with ``reasons``)."""
    return split_checked(checked(records, kind))
