"""Joins on keys of which one may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

HOT_KEYS = 1000        # keys looked at; a key with over 1/1000 of all rows is always among them
TRACKED_ITEMS = 20000  # sketch size, keeps the counts of those keys well apart from the rest
SALTS = 64             # parts a hot key is split into at least
SALT_ROWS = 1_000_000  # rows in one part; a key with more than SALTS x SALT_ROWS is split into more parts
NULL_PARTS = 4096      # parts for rows without a key, which match nothing


def frequent_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that hold at least 1/HOT_KEYS of the rows, and into how many parts (``_hot``) each is to be split.

    At most HOT_KEYS rows, whatever the size of ``df``.
    One pass over the key column with a mergeable sketch; no shuffle of keys.
    """
    top = df.agg(
        F.expr(f"approx_top_k(`{key}`, {HOT_KEYS}, {TRACKED_ITEMS})").alias("top"),
        F.count("*").alias("total"))
    return (top.select("total", F.explode("top").alias("t"))
            .filter(F.col("t.item").isNotNull() & (F.col("t.count") * HOT_KEYS >= F.col("total")))
            .select(F.col("t.item").alias(key), F.greatest(F.lit(SALTS), F.ceil(F.col("t.count") / SALT_ROWS)).cast("int").alias("_hot")))


def is_small(df: DataFrame) -> bool:
    """Whether Spark knows ``df`` to be within its limit for broadcasts, as it does for small written tables."""
    spark = df.sparkSession
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit


def salted_join(facts: DataFrame, lookup: DataFrame, key: str, how: str = "left",
                hot: DataFrame | None = None) -> DataFrame:
    """``facts`` joined (left or inner) with ``lookup``, which holds few rows per key.

    A lookup known to be small goes out to all tasks, and ``facts`` stay where they are. Otherwise:
    A key with a large share of ``facts`` would put that share into one task. Its rows are spread over at least SALTS parts,
    by the partition they come from (so a retried task sends them to the same part), and its lookup rows are
    repeated for each part. Rows without a key are spread in the same way. Only the frequent keys, at most HOT_KEYS rows, are broadcast; pass them as ``hot`` where
    they are known.
    """
    if is_small(lookup):
        return facts.join(F.broadcast(lookup), key, how)
    hot = frequent_keys(facts, key) if hot is None else hot
    return salted(facts, key, hot).join(repeated(lookup, key, hot), [key, "_salt"], how).drop("_salt")


def salted(facts: DataFrame, key: str, hot: DataFrame, by: Column | None = None) -> DataFrame:
    """Adds ``_salt``, the part of its key that a row belongs to: by the hash of ``by``, or by the partition it comes from."""
    part = F.spark_partition_id() if by is None else F.xxhash64(by)
    return facts.join(F.broadcast(hot), key, "left").withColumn(
        "_salt", F.when(F.col(key).isNull(), F.pmod(part, F.lit(NULL_PARTS)))
        .when(F.col("_hot").isNotNull(), F.pmod(part, F.col("_hot"))).otherwise(F.lit(0)).cast("int")).drop("_hot")


def repeated(lookup: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Rows for every part (``_salt``) of their key."""
    return lookup.join(F.broadcast(hot), key, "left").withColumn(
        "_salt", F.explode(F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.col("_hot") - 1)).otherwise(
            F.array(F.lit(0))))).drop("_hot")
