"""Row counts of the stored tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows), one row per table."""
    counts = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
              for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)
