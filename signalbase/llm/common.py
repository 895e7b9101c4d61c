"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

WORD = r"[^\x20\x09-\x0D]+"     # a word: a run without ASCII white space
GAP = r"[\x20\x09-\x0D]+"
BATCH_BYTES = 16 << 20


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, for clusters on which it isn't installed.

    Arrow batches are kept to BATCH_BYTES, since texts may be long and a Python worker holds a batch or two.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(root)))
    path = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{os.path.basename(root)}.zip")
    with open(path, "wb") as file:
        file.write(held.getvalue())
    context.addPyFile(path)     # served to the executors by the driver
    _shipped.add(context.applicationId)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def word_count(text: Column) -> Column:
    """Number of words of ``text``; 0 where it is null."""
    words = F.filter(F.split(text, GAP), lambda w: w != "")
    return F.coalesce(F.size(words), F.lit(0)).cast("long")


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The batch's texts as Python strings, null as empty."""
    return [t or "" for t in batch.column(name).to_pylist()]


def slices(batch: pa.RecordBatch, name: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch where the bytes of its column ``name`` exceed ``limit``, so that work stays bounded for long texts."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)


def shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    """A 64-bit hash (unsigned) of each run of ``width`` words; fewer words are one shingle."""
    import xxhash

    if not words:
        return np.array([], np.uint64)
    n, width = len(words), min(width, len(words))
    known: dict[bytes, int] = {}
    digest = xxhash.xxh64_intdigest
    one = np.fromiter([known.get(w) or known.setdefault(w, digest(w)) for w in words], np.uint64, n)
    grams = np.zeros(n - width + 1, np.uint64)
    for i in range(width):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + one[i:n - width + 1 + i]
    for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        grams ^= grams >> np.uint64(30)
        grams *= np.uint64(factor)
    return grams ^ grams >> np.uint64(31)


def prefix_sums(rows: DataFrame, group: str, block: str, order: list, size: str, out: str) -> DataFrame:
    """``out``: the sum of ``size`` over all rows of ``group`` that stand before this one, by (block, order).

    Two levels: a window inside each (group, block), and one over the block totals of a group. No task holds more than
    one block, or the totals of one group. ``group`` must not be null.
    """
    before = Window.partitionBy(group).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    starts = (rows.groupBy(group, block).agg(F.sum(size).alias("_total"))
              .select(group, block, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start")))
    inside = Window.partitionBy(group, block).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (rows.join(starts, [group, block])
            .withColumn(out, F.col("_start") + F.coalesce(F.sum(size).over(inside), F.lit(0)))
            .drop("_start"))
