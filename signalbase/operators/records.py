"""Nested records, their flat table rows and their keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed, schemas
from ..functions.keys import hash_key


def _envelope(kind: str) -> list[Column]:
    return [F.lit(fixed.SCHEMA_VERSION).alias("schemaVersion"),
            F.lit(schemas.RECORD_TYPES[kind]).alias("recordType")]


def _source() -> Column:
    return F.struct(F.col("source_name").alias("name"), F.col("source_url").alias("url")).alias("source")


def _content(*pairs) -> Column:
    return F.struct(*[(c if isinstance(c, Column) else F.col(c)).alias(n) for n, c in pairs]).alias("content")


def record_of(kind: str) -> Column:
    """The nested record of flat columns, as one struct."""
    collected = F.col("collected_at").alias("collectedAt")
    if kind == "startups":
        data = F.struct(F.col("employee_count").alias("employeeCount"))
        fields = [_source(), _content(("entityName", "entity_name"), ("data", data)), collected]
    elif kind == "products":
        fields = [_source(), _content(("startupName", "startup_name"), ("pricingModel", "pricing_model")), collected]
    elif kind == "research_papers":
        fields = [_content(*[(n, n) for n in (
            "title", "authors", "paper_url", "github_url", "github_stars", "published_date")])]
    elif kind == "jobs":
        fields = [_content(*[(n, n) for n in ("company", "date", "is_remote", "role_family")]), F.col("source_url")]
    elif kind == "news":
        fields = [_source(), _content(
            ("title", "title"), ("text", "full_text"), ("published_date", "published_date")), collected]
    else:
        raise ValueError(f"unknown record kind {kind}")
    return F.struct(*_envelope(kind), *fields)


def to_record(df: DataFrame, kind: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Flat columns to one nested record per row."""
    return df.select(record_of(kind).alias("_r"), *keep).select("_r.*", *keep)


def to_payload(record: Column) -> Column:
    """JSON text of a record; null fields are written."""
    return F.to_json(record, {"ignoreNullFields": "false"})


# Stored columns with their place in the record, and the parts of the dedup key.
_FLAT = {
    "startups": ({"entity_name": "content.entityName", "employee_count": "content.data.employeeCount",
                  "source_name": "source.name", "source_url": "source.url", "collected_at": "collectedAt"},
                 ["entity_name", "source_url"]),
    "products": ({"startup_name": "content.startupName", "pricing_model": "content.pricingModel",
                  "source_name": "source.name", "source_url": "source.url", "collected_at": "collectedAt"},
                 ["startup_name", "source_url"]),
    "research_papers": ({"title": "content.title", "authors": "content.authors",
                         "paper_url": "content.paper_url", "github_url": "content.github_url",
                         "github_stars": "content.github_stars", "published_date": "content.published_date"},
                        ["paper_url"]),
    "jobs": ({"company": "content.company", "date": "content.date", "is_remote": "content.is_remote",
              "role_family": "content.role_family", "source_url": "source_url"}, ["company", "source_url"]),
    "news": ({"title": "content.title", "full_text": "content.text", "source_name": "source.name",
              "source_url": "source.url", "published_date": "content.published_date",
              "collected_at": "collectedAt"}, ["source_url"]),
}


def flatten(records: DataFrame, kind: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Nested records to table rows with ``hash_key`` and ``raw_payload``, without ``id``."""
    columns, key = _FLAT[kind]
    whole = F.struct(*[F.col(f) for f in records.columns if f not in keep])
    flat = records.select(
        *[F.col(path).alias(name) for name, path in columns.items()],
        to_payload(whole).alias("raw_payload"), *keep)
    flat = flat.withColumn("hash_key", hash_key(*key))
    if "authors" in columns:
        flat = flat.withColumn("authors", F.to_json("authors"))
    return flat.select("hash_key", *columns, "raw_payload", *keep)
