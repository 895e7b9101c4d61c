"""Distribution of urls by host."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.links import host


def domain_buckets(df: DataFrame, url: str) -> DataFrame:
    """(bucket, hosts, urls): 16 buckets by the first hex digit of the host's MD5."""
    hosts = df.select(host(url).alias("host")).filter(F.col("host").isNotNull()).groupBy("host").agg(
        F.count("*").alias("n"))
    return hosts.groupBy(F.substring(F.md5("host"), 1, 1).alias("bucket")).agg(
        F.count("*").alias("hosts"), F.sum("n").alias("urls"))


def partition_by_domain(df: DataFrame, url: str, partitions: int, order: str, slice_rows: int = 100_000) -> DataFrame:
    """Rows of a host kept together for polite fetching, in slices of up to ``slice_rows`` consecutive numbers of
    ``order``, so that one huge host spreads over many partitions."""
    return df.repartition(partitions, host(url), F.floor(F.col(order) / F.lit(slice_rows)))
