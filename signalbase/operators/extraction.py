"""Extraction results of several service tiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def first_valid_tier(docs: DataFrame, responses: DataFrame, schema: str) -> tuple[DataFrame, DataFrame]:
    """(docs with ``tier`` and parsed ``result``, docs for which no tier gave valid JSON).

    A response counts if its status is 200 and its body is JSON; the lowest tier wins.
    """
    usable = responses.filter((F.col("status") == 200) & F.try_parse_json("body").isNotNull())
    best = usable.groupBy("doc_id").agg(F.min("tier").alias("tier"), F.min_by("body", "tier").alias("body"))
    joined = docs.join(best, "doc_id", "left")
    return (joined.filter(F.col("tier").isNotNull()).withColumn("result", F.from_json("body", schema)).drop("body"),
            joined.filter(F.col("tier").isNull()).drop("tier", "body"))
