"""A Bloom filter of stored keys, as a table of segments.

A key's hash names its segment; PROBES further positions in the segment's BITS bits are set. Segments are built by grouped
bit aggregation, so filters of two sets of keys are merged by OR, and both the filter and a batch are spread over all
tasks by segment. At KEYS keys a segment (32 bits a key) a new key passes for a stored one about three times in ten million.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

PROBES = 17
WORDS = 512
BITS = WORDS * 64
KEYS = 1024         # keys a segment is meant for; beyond, a filter is built anew with more segments


def segments_for(keys: int) -> int:
    """Segments that hold ``keys`` keys and as many again: a power of two."""
    return 1 << max(0, (2 * keys - 1) // KEYS).bit_length()


def _segment(key: str, segments: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(0), F.col(key)), F.lit(segments)).alias("segment")


def _hashes(key: str) -> tuple[Column, Column]:
    return F.xxhash64(F.lit(1), F.col(key)).alias("first"), F.xxhash64(F.lit(2), F.col(key)).alias("step")


def _positions(first: Column, step: Column) -> Column:
    """PROBES positions from two hashes of the key."""
    step, mask = step.bitwiseOR(F.lit(1)), F.lit(BITS - 1)
    return F.array(*[(first.bitwiseAND(mask) + step.bitwiseAND(mask) * i).bitwiseAND(mask) for i in range(PROBES)])


def _bit(position: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), position.bitwiseAND(F.lit(63)).cast("int"))


def build(keys: DataFrame, key: str, segments: int) -> DataFrame:
    """``segment, words`` of a table's keys, a row for each of the ``segments``.

    Two hashes a key are dealt to its segment, and become PROBES bits there; a row for each segment brings the words without a bit.
    """
    def word(p: Column) -> Column:
        return F.struct(F.shiftright(p, 6).cast("int").alias("w"), _bit(p).alias("bits"))

    none = F.lit(None).cast("long")
    every = keys.sparkSession.range(segments).select(F.col("id").alias("segment"), none.alias("first"), none.alias("step"))
    dealt = every.unionByName(keys.select(_segment(key, segments).cast("long").alias("segment"), *_hashes(key))).repartition("segment")
    empty = F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda w: F.struct(w.alias("w"), F.lit(0).cast("long").alias("bits")))
    words = F.when(F.col("first").isNull(), empty).otherwise(F.transform(_positions(F.col("first"), F.col("step")), word))
    full = (dealt.select("segment", F.explode(words).alias("x")).groupBy("segment", "x.w").agg(F.bit_or("x.bits").alias("bits"))
            .select("segment", F.struct("w", "bits").alias("x")))
    held = full.groupBy("segment").agg(F.sort_array(F.collect_list("x")).alias("xs"))       # WORDS entries each
    return held.select("segment", F.transform("xs", lambda x: x["bits"]).alias("words"))


def merge(one: DataFrame, other: DataFrame) -> DataFrame:
    """The filter of the keys of both; both must have the same number of segments."""
    both = one.join(other.select("segment", F.col("words").alias("more")), "segment")
    return both.select("segment", F.zip_with("words", "more", lambda a, b: a.bitwiseOR(b)).alias("words"))


def with_maybe(batch: DataFrame, key: str, filter_: DataFrame, segments: int) -> DataFrame:
    """Adds ``maybe_stored``: false means that the key is certainly not among the filter's keys.

    ``batch`` should hold each key once, so that no segment is hotter than another.
    """
    probed = batch.withColumn("_segment", _segment(key, segments)).join(
        filter_.select(F.col("segment").alias("_segment"), F.col("words").alias("_words")), "_segment")
    found = F.forall(_positions(*_hashes(key)), lambda p: F.get("_words", F.shiftright(p, 6).cast("int")).bitwiseAND(_bit(p)) != 0)
    return probed.withColumn("maybe_stored", found).drop("_segment", "_words")
