"""Near duplicates by 64-bit SimHash fingerprints, with pivot distance tables.

By the triangle inequality two fingerprints within d bits have distances to any reference fingerprint (a pivot) that
differ by d at most. Each fingerprint carries its distances to PIVOTS pivots; a pair is discarded as soon as one
coordinate differs by more than d, and only survivors are compared bit by bit.

At d = 3 one pivot lets about half of all random pairs pass, so pivots alone cannot name the pairs to look at. Pairs come
from tables of exact agreement instead: the 64 bits are cut into BLOCKS blocks, three differing bits leave at least
BLOCKS - 3 blocks equal, and one table per choice of those blocks finds every pair. In buckets with many
fingerprints the pivots also cut the bucket: it is split into overlapping cells of distance to a pivot.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import stage
from .common import slices
from .components import components

PIVOTS = 16
BLOCKS = 5          # 10 tables of 25 or 26 agreeing bits at distance 3
HOT_BUCKET = 4096   # distinct fingerprints in a bucket from which on it is split into cells
CELL = 8            # width of a cell in bits of distance


def fingerprint(text: str | None, width: int = 3) -> int:
    """The 64-bit SimHash of word shingles: bit set where over half of the shingle hashes have it set."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()   # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > width:
        starts, ends = starts[:len(words) - width + 1], ends[width - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(line[s:e], 42) for s, e in zip(starts.tolist(), ends.tolist())])
    n = len(starts)
    ones = np.zeros(64, np.int64)
    packed = np.frombuffer(hashes, np.uint8).reshape(n, 8)
    for k in range(0, n, 65_536):
        ones += np.unpackbits(packed[k:k + 65_536], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp`` (signed 64 bits) for every row of ``docs``."""
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                fps = np.fromiter((fingerprint(t, width) for t in batch.column("text").to_pylist()), np.uint64,
                                  batch.num_rows)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps.view(np.int64))],
                                                 names=["doc_id", "fp"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(compute, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long")


def pivots(count: int = PIVOTS, seed: int = 20240605) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 64, count, dtype=np.uint64)


def table_keys(fp: F.Column, distance: int, blocks: int = BLOCKS) -> F.Column:
    """One struct (table, key) per choice of blocks that must agree."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    masks = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    keys = []
    for t, chosen in enumerate(combinations(range(blocks), blocks - distance)):
        mask = sum(masks[i] for i in chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.struct(F.lit(t).alias("t"), fp.bitwiseAND(F.lit(signed)).alias("k")))
    return F.array(*keys)


def pairs_of(fps: np.ndarray, coordinates: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of all pairs within ``distance`` bits: by the pivot table first, then bit by bit.

    Rows are sorted by their first coordinate, so each row meets only rows that it does not exceed by more than
    ``distance`` there. Pairs come a block at a time, so that no more than a block of them is ever held.
    """
    order = np.argsort(coordinates[:, 0], kind="stable")
    fps, coordinates = fps[order], coordinates[order]
    last = np.searchsorted(coordinates[:, 0], coordinates[:, 0] + distance, "right")
    step = 256
    for i in range(0, len(fps), step):
        j = min(i + step, len(fps))
        end = last[j - 1]
        for k in range(i, end, 4096):
            m = min(k + 4096, end)
            a, b = np.nonzero(np.arange(k, m)[None, :] > np.arange(i, j)[:, None])
            a, b = a + i, b + k
            for p in range(coordinates.shape[1]):
                near = np.abs(coordinates[a, p] - coordinates[b, p]) <= distance
                a, b = a[near], b[near]
            near = np.bitwise_count(fps[a] ^ fps[b]) <= distance
            if near.any():
                yield order[a[near]], order[b[near]]


def forest(n: int, blocks: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Those of the links that join two parts not yet joined: the same parts from less than ``n`` links.

    Links inside a part found by earlier blocks are dropped all at once; only the others are looked at one by one.
    """
    parent = np.arange(n)
    kept: list[tuple[int, int]] = []

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = int(parent[x])
        return x

    for a, b in blocks:
        while (parent[parent] != parent).any():
            parent = parent[parent]
        apart = parent[a] != parent[b]
        # One link for each pair of parts is enough.
        ends = np.sort(np.stack([parent[a[apart]], parent[b[apart]]]), axis=0)
        _, one = np.unique(ends[0] * n + ends[1], return_index=True)
        for x, y in zip(a[apart][one].tolist(), b[apart][one].tolist()):
            u, v = top(x), top(y)
            if u != v:
                parent[max(u, v)] = min(u, v)
                kept.append((x, y))
    left, right = zip(*kept) if kept else ((), ())
    return np.array(left, np.int64), np.array(right, np.int64)


def links(distinct: DataFrame, distance: int = 3) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints (column ``fp``) that connect exactly those within ``distance`` bits.

    Of a bucket's links only a spanning forest is returned, which loses no component and is smaller than the bucket.
    """
    keyed = distinct.select("fp", F.explode(table_keys(F.col("fp"), distance)).alias("x")).select("fp", "x.t", "x.k")
    sizes = keyed.groupBy("t", "k").agg(F.count("*").alias("n")).where("n > 1")
    shared = keyed.join(sizes, ["t", "k"])
    first = [int(p) - (1 << 64) if int(p) >> 63 else int(p) for p in pivots(2)]
    cells = []
    for p in first:     # a row lies in its own cell and, near the lower end of it, in the one before too
        d = F.bit_count(F.col("fp").bitwiseXOR(F.lit(p)))
        own = F.floor(d / CELL).cast("int")
        cells.append(F.when(F.col("n") <= HOT_BUCKET, F.array(F.lit(0)))
                     .otherwise(F.array_distinct(F.array(own, F.floor((d - distance) / CELL).cast("int")))))
    celled = (shared.withColumn("c1", F.explode(cells[0])).withColumn("c2", F.explode(cells[1]))
              .select("t", "k", "c1", "c2", "fp"))
    dealt = celled.repartition("t", "k", "c1", "c2").sortWithinPartitions("t", "k", "c1", "c2")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pivots()

        def flush(fps: np.ndarray) -> pa.RecordBatch:
            coordinates = np.bitwise_count(fps[:, None] ^ table[None, :]).astype(np.int8)
            a, b = forest(len(fps), pairs_of(fps, coordinates, distance))
            return pa.RecordBatch.from_arrays([pa.array(fps[a].view(np.int64)), pa.array(fps[b].view(np.int64))],
                                              names=["a", "b"])

        key, held = None, []
        for batch in batches:
            cols = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("t", "k", "c1", "c2")])
            fps = batch.column("fp").to_numpy().astype(np.int64).view(np.uint64)
            cuts = np.flatnonzero((cols[:, 1:] != cols[:, :-1]).any(axis=0)) + 1
            for s, e in zip([0, *cuts], [*cuts, batch.num_rows]):
                if s == e:
                    continue
                if (now := tuple(cols[:, s])) != key:
                    if held and sum(map(len, held)) > 1:
                        yield flush(np.concatenate(held))
                    key, held = now, []
                held.append(fps[s:e])
        if held and sum(map(len, held)) > 1:
            yield flush(np.concatenate(held))

    return dealt.mapInArrow(compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, distance: int = 3, width: int = 3, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id reachable by links.

    Two rows are linked if their fingerprints differ in at most ``distance`` bits; equal ones always are. A null or empty
    text has fingerprint zero and is linked like any other. Repeated rows and repeated ids give a row each; a row with a
    null id takes part and has a component_id if any row reachable has an id. Columns other than the two named are
    not read. An empty table gives an empty result.

    Fingerprints are computed once and written to the shared folder; all later steps work on distinct fingerprints, so a
    group of copies, however large, is one row of the pair search.
    """
    rows = stage(fingerprints(docs, width, id_col, text_col), "fingerprints")
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    parts = components(links(distinct, distance))
    member = (parts.join(distinct, F.col("node") == F.col("fp"))
              .select("node", "root", "least"))
    roots = member.groupBy("root").agg(F.min("least").alias("found"))
    linked = member.join(roots, "root").select(F.col("node").alias("fp"), "found")
    # As a written table, so that the join below reads plain shuffles on both sides and AQE can split a frequent fingerprint.
    group = stage(distinct.join(linked, "fp", "left").select("fp", F.coalesce("found", "least").alias("component_id")), "groups")
    return rows.join(group, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
