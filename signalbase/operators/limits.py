"""Target row counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .dedup import numbered

SORTED_ROWS = 100_000   # targets up to here are kept by each task and sorted in one; beyond, rows are numbered and cut: the same rows


def first_rows(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first ``n`` rows in ``order``, which must tell any two rows apart."""
    if n <= SORTED_ROWS:
        return df.orderBy(*order).limit(n)
    return numbered(df, *order).filter(F.col("id") <= n).drop("id")


def cap_rows(df: DataFrame, seq: str, n: int | None = None) -> DataFrame:
    """The first ``n`` rows in the order of ``seq``, which is unique; all rows if ``n`` is None."""
    return df if n is None else first_rows(df, n, seq)


def backfill(first: DataFrame, second: DataFrame, seq: str, n: int | None = None) -> DataFrame:
    """Rows of ``first``, then rows of ``second`` only as far as ``n`` is not reached. Adds ``source_no``."""
    first, second = first.withColumn("source_no", F.lit(0)), second.withColumn("source_no", F.lit(1))
    both = first.unionByName(second, allowMissingColumns=True)
    return both if n is None else first_rows(both, n, "source_no", seq)


def newest_n(df: DataFrame, published: str, seq: str, n: int | None = None) -> DataFrame:
    """The ``n`` most recent rows; rows of equal time in arrival order."""
    return df if n is None else first_rows(df, n, F.col(published).desc(), F.col(seq))
