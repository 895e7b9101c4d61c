"""Fingerprints by consistent weighted sampling.

Ioffe's scheme (2010): for each sample k and term t two gamma(2, 1) variables and a uniform one are fixed by the term. With
the term's weight w they give a quantised level and a value; the term with the smallest value is the sample. Two
texts agree in a sample with a probability equal to the generalised Jaccard similarity of their weights,
sum(min) / sum(max). The random variables are computed from 64-bit hashes of term and sample, so that any number of terms
keeps its own.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import shingle_hashes, slices

SAMPLES = 64
SEED = 20240605
BLOCK = 512         # terms whose variates are held at once: they stay in a core's cache


@functools.lru_cache(maxsize=1)
def seeds(samples: int = SAMPLES, seed: int = SEED) -> np.ndarray:
    """Two odd 64-bit factors for each sample."""
    return np.random.default_rng(seed).integers(0, 1 << 64, (2, samples), dtype=np.uint64) | np.uint64(1)


def uniforms(at: np.ndarray) -> np.ndarray:
    """A 64-bit number for each term and sample, fixed by the term's 64-bit hash."""
    first, second = seeds()
    x = at[:, None] * first
    x ^= x >> np.uint64(32)
    x *= second
    x ^= x >> np.uint64(32)
    return x


def variates(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, e, r) for numbers from ``uniforms``: a is c u, where u = exp(-r (1 - b)), and e is r b.

    With c and r gamma(2, 1) and b uniform, r b and r (1 - b) are two independent exponential variates, and so are c u and
    c (1 - u). Here these are drawn, which fixes c = a + a', r = e + ln(c / a) and b = e / r with their distributions.
    """
    y = x * np.uint64(0xBF58476D1CE4E5B9)
    y ^= y >> np.uint64(29)
    y *= np.uint64(0x94D049BB133111EB)
    y ^= y >> np.uint64(32)
    a = exponential(x)
    e, other = exponential(y & np.uint64(0xFFFFFFFF00000000)), exponential(y << np.uint64(32))
    return a, e, e + np.log1p(other / a)


def exponential(x: np.ndarray) -> np.ndarray:
    """Exponential variates in the order of the 64-bit numbers ``x``."""
    return -np.log1p(-np.minimum(x.astype(np.float32) * np.float32(2.0 ** -64) + np.float32(2.0 ** -40), np.float32(1 - 2.0 ** -24)))


def terms(text: str, width: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes and weights (numbers of occurrences) of a text's shingles of ``width`` words; a shorter text is one."""
    found, weights = np.unique(shingle_hashes(text.encode("utf-8", "surrogatepass").split(), width), return_counts=True)
    return found, weights.astype(np.float32)


def signature(text: str, width: int = 2) -> np.ndarray:
    """SAMPLES numbers of 16 bits, each from the sampled term and its level. All zero for a text without words."""
    found, weights = terms(text, width)
    if not len(found):
        return np.zeros(SAMPLES, np.uint16)
    best = np.full(SAMPLES, np.inf, np.float32)
    term = np.zeros(SAMPLES, np.uint64)
    level = np.zeros(SAMPLES, np.float32)
    samples = np.arange(SAMPLES)
    order = np.argsort(weights > 1, kind="stable")      # terms that occur once stand first
    found, logs, once = found[order], np.log(weights[order]), int((weights == 1).sum())
    cuts = [*range(0, once, BLOCK), *range(once, len(found), BLOCK), len(found)]
    for s, e in zip(cuts, cuts[1:]):
        at, x = found[s:e], uniforms(found[s:e])
        # With level t = floor(ln w / r + b) the value ln c - r (t - b) - r is ln a - r t, and t is 0 for weight one.
        if s < once:
            row = np.argmin(x, axis=0)
            least, t = np.log(exponential(x[row, samples])), np.zeros(SAMPLES, np.float32)
        else:
            a, b, r = variates(x)
            t = np.floor((logs[s:e, None] + b) / r)
            value = np.log(a) - r * t
            row = np.argmin(value, axis=0)
            least, t = value[row, samples], t[row, samples]
        better = least < best
        best[better], term[better], level[better] = least[better], at[row][better], t[better]
    mixed = term ^ level.astype(np.int64).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    mixed = (mixed ^ mixed >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15)
    return np.maximum((mixed >> np.uint64(48)).astype(np.uint16), 1)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal samples: an estimate of the generalised Jaccard similarity."""
    return float((a == b).mean())


def fingerprints(docs: DataFrame, width: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` (hex digits) for every row; a null text counts as empty, whose fingerprint is all zeros."""
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"),
                     pa.array([signature(t or "", width).astype(">u2").tobytes().hex()
                               for t in batch.column("text").to_pylist()], pa.string())],
                    names=["doc_id", "fingerprint"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(compute, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fingerprint string")


def edited_pairs(docs: DataFrame, blocks: int | None = None, width: int = 2, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edited text has the last floor(n / 2) code points replaced by the first as many, or all, of the next document
    (descending doc_id; the first one follows the last). Returns doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    Texts are shuffled once, into ranges of doc_id between quantiles of that column; each range also gets the first document
    of the range after it. A null text counts as empty. Rows with the same id follow each other by a hash of their texts;
    equal rows follow each other. Null ids come last. Other columns are not read. A single row is its own next. An empty
    table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    blocks = blocks or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"))
    found = ids.agg(F.percentile_approx("doc_id", [i / blocks for i in range(1, blocks)], 100 * blocks).alias("cuts"),
                    F.max("doc_id").alias("most"), F.max(F.col("doc_id").isNull()).alias("nulls")).first()
    # Range b + 1 holds the ids up to edges[b]; its first document in descending order has exactly that id. Range 0 holds
    # the null ids, below all others.
    edges = sorted({*(found["cuts"] or ()), *(() if found["most"] is None else (found["most"],))})
    nulls = bool(found["nulls"])

    def targets(i: int | None) -> list[int]:
        """The range of an id and, where it is the first one there, -1 - the range before whose last one it follows."""
        if i is None:
            return [0, -1 - (1 if edges else 0)]
        b = int(np.searchsorted(edges, i)) + 1
        if edges[b - 1] != i:
            return [b]
        return [b, -1 - (b + 1 if b < len(edges) else int(not nulls))]

    # A float column would round large ids, so the id travels as text.
    dealt = rows.withColumn("to", F.explode(_targets_udf(targets)(F.col("doc_id").cast("string"))))
    dealt = dealt.withColumn("ahead", F.col("to") < 0).withColumn(
        "block", F.when(F.col("ahead"), -1 - F.col("to")).otherwise(F.col("to"))).drop("to")
    dealt = (dealt.withColumn("tie", F.xxhash64("text")).repartition(max(1, blocks // 4), "block")
             .sortWithinPartitions("block", "ahead", F.desc_nulls_last("doc_id"), "tie"))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        waiting, block, closed = None, None, False      # the document whose next is awaited: id, text, signature

        def pair(this: tuple, following: tuple) -> tuple:
            i, text, own = this
            n = len(text)
            edited = text[:n - n // 2] + following[1][:n // 2]
            mark = signature(edited, width)
            return (i, n, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), _hex(own), _hex(mark),
                    likeness(own, mark), likeness(own, following[2]))

        for whole in batches:
            for batch in slices(whole, "text"):
                for i, text, now, ahead in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "block", "ahead"))):
                    if now != block:
                        block, closed, waiting = now, False, None
                    if closed:      # further documents with the edge's id
                        continue
                    this = (i, text, signature(text, width))
                    if waiting is not None:
                        out.append(pair(waiting, this))
                    waiting, closed = this, ahead
                yield _table(out)
                out = []

    return dealt.mapInArrow(walk, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                  "edited_fingerprint string, near_edited double, near_next double")


def _targets_udf(targets):
    @F.pandas_udf("array<int>")
    def deal(ids):
        return ids.map(lambda i: targets(None if i is None else int(i)))

    return deal


def _hex(mark: np.ndarray) -> str:
    return mark.astype(">u2").tobytes().hex()


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
