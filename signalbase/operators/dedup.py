"""First-wins deduplication, insert-or-ignore and row ids."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stage


def first_wins(df: DataFrame, key: str | Sequence[str], order: str | Sequence[str]) -> DataFrame:
    """The first row of each key in ``order``.

    ``row_number() = 1`` lets Spark drop the losing rows of each task before the shuffle, so a key with a third of
    the table reaches its reducer as one row per map task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    orders = [order] if isinstance(order, str) else list(order)
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*orders)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def anti_existing(batch: DataFrame, stored: DataFrame, key: str = "hash_key") -> DataFrame:
    """Batch rows whose key is not stored yet. Reads only the key column of the stored table."""
    return batch.join(stored.select(key), key, "left_anti")


def numbered(df: DataFrame, *order: str | Column, start: int = 0) -> DataFrame:
    """Adds ``id``: start+1, start+2, … in ``order``, which must tell any two rows apart.

    Rows are dealt into ranges of the order by sampled ranks, sorted inside each and written once; a row's number is the
    count of the ranges before its own, plus its place. Only one count per range is added up, so neither the values nor the
    number of rows decide what a single task holds.
    """
    place = F.monotonically_increasing_id()     # range number in the upper 31 bits, place in the lower 33
    sorted_rows = stage(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", place), "numbered")
    part = F.shiftright("_place", 33).cast("int")
    counts = sorted(sorted_rows.groupBy(part.alias("_part")).count().collect())
    before = accumulate((n for _, n in counts), initial=start)
    firsts = df.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(counts, before)], "_part int, _before bigint")
    return (sorted_rows.withColumn("_part", part).join(F.broadcast(firsts), "_part")      # a row per range
            .withColumn("id", F.col("_before") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)) + 1)
            .drop("_part", "_place", "_before"))


def assign_ids(df: DataFrame, seq: str, start: int = 0, lead: Sequence[str] = ()) -> DataFrame:
    """Adds ``id``: start+1, start+2, … in the order of ``lead``, then ``seq``, which is unique for each ``lead``."""
    return numbered(df, *lead, seq, start=start)


def first_places(batch: DataFrame, seq: str, key: str = "hash_key") -> DataFrame:
    """(key, seq) of the first row of each key: all that deciding on a batch takes, whatever its rows hold."""
    return batch.groupBy(key).agg(F.min(seq).alias(seq))


def insert_or_ignore(batch: DataFrame, stored: DataFrame, seq: str, key: str = "hash_key",
                     start: int = 0) -> DataFrame:
    """Rows to append: first of each key in the batch, none that is stored, with ids in arrival order.

    Keys and arrival numbers alone are grouped, compared and numbered; the rows are joined to the outcome once.
    """
    new = anti_existing(first_places(batch, seq, key), stored, key)
    return batch.join(assign_ids(new, seq, start), [key, seq])
