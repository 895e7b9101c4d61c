"""Failed items and error rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

MAX_TRIES = 4
ERROR_SHARE = 0.2
WINDOW = "60 seconds"


def dead_letters(attempts: DataFrame, item: str, failed: str, tries: int = MAX_TRIES) -> DataFrame:
    """Items with at least ``tries`` attempts, all failed: (item, attempts)."""
    counted = attempts.groupBy(item).agg(
        F.count("*").alias("attempts"), F.count_if(~F.col(failed)).alias("_passed"))
    return counted.filter((F.col("attempts") >= tries) & (F.col("_passed") == 0)).drop("_passed")


def error_windows(calls: DataFrame, ts: str, provider: str, failed: str, share: float = ERROR_SHARE,
                  watermark: str | None = None) -> DataFrame:
    """Windows of a provider in which over ``share`` of the calls failed. Takes batches and streams alike."""
    if watermark:
        calls = calls.withWatermark(ts, watermark)
    counted = calls.groupBy(F.window(ts, WINDOW), F.col(provider)).agg(
        F.count("*").alias("calls"), F.count_if(F.col(failed)).alias("errors"))
    return (counted.filter(F.col("errors") > F.col("calls") * share)
            .select(F.col("window.start").alias("window_start"), provider, "calls", "errors"))
