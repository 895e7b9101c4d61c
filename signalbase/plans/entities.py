"""Companies and products: a directory first, then product spaces for what is missing to the target."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from .. import fixed
from ..functions.dates import collected_at
from ..functions.text import (
    digits_to_int, first_nonempty, py_strip, space_url, split_space_id, startup_topic, with_default,
)
from ..operators.limits import backfill
from ..operators.resolve import Catalogue, resolve_entities
from ..session import stage


def directory_rows(df: DataFrame) -> DataFrame:
    """Named companies on topic."""
    on_topic = df.filter(startup_topic("industry", "subindustry", "long_description", "one_liner"))
    template = F.concat(F.lit(fixed.DIRECTORY_URL), with_default("slug", ""))
    return on_topic.filter(py_strip("name") != "").select(
        py_strip("name").alias("raw_name"), digits_to_int("team_size").alias("employee_count"),
        first_nonempty("url", "cb_url", template).alias("source_url"), "ingest_seq")


def space_rows(df: DataFrame) -> DataFrame:
    known = with_default("id", "")
    return df.select(
        split_space_id(known).alias("raw_name"), F.lit(None).cast("int").alias("employee_count"),
        space_url(known).alias("source_url"), "ingest_seq")


def resolved_entities(directory: DataFrame, spaces: DataFrame, catalogue: Catalogue,
                      target: int | None = None) -> DataFrame:
    """Rows within the target with resolved names; the parent of companies, products and log rows."""
    kept = backfill(directory_rows(directory), space_rows(spaces), "ingest_seq", target)
    return resolve_entities(stage(kept, "named"), "raw_name", catalogue)


def startup_rows(resolved: DataFrame, run_ts: datetime) -> DataFrame:
    return resolved.select(
        F.col("canonical").alias("entity_name"), "employee_count",
        F.when(F.col("source_no") == 0, F.lit(fixed.DIRECTORY_NAME)).otherwise(
            F.lit(fixed.SPACES_NAME)).alias("source_name"),
        "source_url", collected_at(run_ts).alias("collected_at"), "ingest_seq")


def product_rows(resolved: DataFrame, run_ts: datetime) -> DataFrame:
    from_directory = F.col("source_no") == 0
    return resolved.select(
        F.col("canonical").alias("startup_name"),
        F.when(from_directory, F.lit("FREEMIUM")).otherwise(F.lit("FREE")).alias("pricing_model"),
        F.when(from_directory, F.lit(fixed.DIRECTORY_PRODUCT_NAME)).otherwise(
            F.lit(fixed.SPACES_NAME)).alias("source_name"),
        "source_url", collected_at(run_ts).alias("collected_at"), "ingest_seq")
