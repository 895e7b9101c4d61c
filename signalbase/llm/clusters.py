"""Centroid clustering of 64-component vectors by bit planes.

Components become whole numbers in two's complement. Bit p of all 64 components of a vector is packed into one unsigned
64-bit number, its plane p; the top plane weighs -2^p, all others 2^p. The dot product of a vector and a centroid is then
the sum over plane pairs of weight times weight times popcount(plane AND plane), which is exact, and so is the squared
distance |x|^2 - 2xc + |c|^2. Planes are the only thing kept of a vector: the sums that move the centroids are counts of set bits
per cluster, plane and component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import stage

PARTS = 64          # components of a vector, bits of a plane
SCALE = 256
ROWS = 2048         # rows compared at once: ROWS x centroids x 8 bytes of dot products
NARROW = 24         # planes up to which products are summed in 64-bit numbers


def integers(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) as whole numbers: 64-bit ones where they fit in NARROW planes, else Python's."""
    scaled = np.floor(scale * vectors)
    if not scaled.size or np.abs(scaled).max() < 2.0 ** (NARROW - 1):
        return scaled.astype(np.int64)
    return np.array([[int(x) for x in row] for row in scaled], object).reshape(scaled.shape)


def width_of(numbers: np.ndarray) -> int:
    """Planes that hold every number in two's complement; at least two, so plane 0 is never the sign."""
    if not numbers.size:
        return 2
    return max(2, *(int(x).bit_length() + 1 for x in (numbers.max(), numbers.min())))


def pack(numbers: np.ndarray, width: int | None = None) -> np.ndarray:
    """Planes (rows x width) of whole numbers (rows x PARTS); bit j of a plane belongs to component j."""
    width = width or width_of(numbers)
    bits = np.stack([((numbers >> p) & 1).astype(np.uint8) for p in range(width)], axis=1)
    return np.packbits(bits, axis=2, bitorder="little").view("<u8").reshape(len(numbers), width)


def widen(planes: np.ndarray, width: int) -> np.ndarray:
    """The same numbers in ``width`` planes: the sign plane repeats."""
    return np.concatenate([planes, np.repeat(planes[:, -1:], width - planes.shape[1], axis=1)], axis=1)


def weights(width: int) -> list[int]:
    return [1 << p for p in range(width - 1)] + [-(1 << (width - 1))]


def dots(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact dot products (rows of ``x`` times rows of ``c``) from planes, as 64-bit numbers if they fit, else Python's.

    Popcounts of plane pairs of equal weight are summed first (at most PARTS * width each), then weighted.
    """
    p_last, q_last = x.shape[1] - 1, c.shape[1] - 1
    by_weight = np.zeros((p_last + q_last + 1, len(x), len(c)), np.int32)
    for p in range(p_last + 1):
        for q in range(q_last + 1):
            count = np.bitwise_count(x[:, p, None] & c[None, :, q])
            if (p == p_last) != (q == q_last):
                by_weight[p + q] -= count
            else:
                by_weight[p + q] += count
    total = np.zeros((len(x), len(c)), np.int64 if x.shape[1] + c.shape[1] <= 2 * NARROW + 2 else object)
    for m, counts in enumerate(by_weight):
        total += counts.astype(total.dtype) * (1 << m)
    return total


def norms(planes: np.ndarray) -> np.ndarray:
    """Squared lengths from planes."""
    wide = planes.shape[1] > NARROW
    total = np.zeros(len(planes), object if wide else np.int64)
    w = weights(planes.shape[1])
    for p in range(len(w)):
        for q in range(p, len(w)):
            count = np.bitwise_count(planes[:, p] & planes[:, q]).astype(total.dtype)
            total += count * (w[p] * w[q] * (1 if p == q else 2))
    return total


def nearest(planes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row the number of the nearest centroid (ties: the smaller) and the squared distance to it."""
    distances = norms(planes)[:, None] - 2 * dots(planes, centroids) + norms(centroids)[None, :]
    best = np.argmin(distances, axis=1)
    return best, distances[np.arange(len(planes)), best]


def _vectors(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, PARTS)


def planes_of(rows: DataFrame, vector_col: str, keep: list) -> DataFrame:
    """The columns ``keep`` and ``planes``, as many for each vector as it needs, of the vectors that take part."""
    v = F.col(vector_col).cast("array<double>")
    good = (F.size(v) == PARTS) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    table = rows.where(F.coalesce(good, F.lit(False))).select(*keep, v.alias("vector"))
    names = [n for n in table.columns if n != "vector"]

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                vectors = _vectors(batch.column("vector"))
                held: list = [None] * len(vectors)
                wide = np.abs(vectors).max(axis=1) * SCALE >= 2.0 ** (NARROW - 1) - 1   # these alone pay for long numbers
                for part in [np.flatnonzero(~wide), *np.flatnonzero(wide)[:, None]]:
                    if len(part):
                        for i, row in zip(part, pack(integers(vectors[part])).view(np.int64)):
                            held[i] = row
                yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(held, pa.list_(pa.int64()))],
                                                 names=[*names, "planes"])

    fields = ", ".join(f"`{n}` {table.schema[n].dataType.simpleString()}" for n in names)
    return table.mapInArrow(compute, f"{fields}, planes array<long>")


def blocks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, planes) of the batch: rows up to NARROW planes together, wider ones by their width, ROWS at a time."""
    column = batch.column("planes")
    if column.null_count == len(column):
        return
    widths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat, starts = column.flatten().to_numpy(), np.concatenate(([0], np.cumsum(widths)))
    groups = np.maximum(widths, NARROW)
    for group in np.unique(groups):
        rows = np.flatnonzero(groups == group)
        for k in range(0, len(rows), ROWS):
            part = rows[k:k + ROWS]
            width = int(widths[part].max())
            at = starts[part][:, None] + np.minimum(np.arange(width)[None, :], widths[part][:, None] - 1)
            yield part, flat[at].view(np.uint64)       # past a row's last plane that plane repeats: its sign


def bit_counts(table: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``cluster, plane, negative, rows, ones``: how often each component's bit is set in the cluster's vectors.

    Each task adds up its own rows first, so at most clusters x planes rows a task are shuffled.
    """
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int, bool], list] = {}
        for batch in batches:
            for _, planes in blocks(batch):
                cluster, _ = nearest(planes, centroids)
                order = np.argsort(cluster, kind="stable")
                firsts = np.flatnonzero(np.diff(cluster[order], prepend=-1))
                bits = np.unpackbits(planes[order].astype("<u8").view(np.uint8).reshape(*planes.shape, 8), axis=2, bitorder="little")
                ones = np.add.reduceat(bits, firsts, axis=0, dtype=np.int64)
                sizes = np.diff(np.append(firsts, len(order)))
                for g, k in enumerate(cluster[order][firsts].tolist()):
                    for p in range(planes.shape[1]):
                        kept = held.setdefault((k, p, p == planes.shape[1] - 1), [0, 0])
                        kept[0] += int(sizes[g])
                        kept[1] = kept[1] + ones[g, p]
        rows = [(*key, n, ones.tolist()) for key, (n, ones) in held.items()]
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(("cluster", "plane", "negative", "rows", "ones"), r)) for r in rows], schema=SCHEMA)

    partial = table.select("planes").mapInArrow(compute, "cluster int, plane int, negative boolean, rows long, ones array<long>")
    return (partial.select("cluster", "plane", "negative", "rows", F.posexplode("ones").alias("j", "one"))
            .groupBy("cluster", "plane", "negative", "j").agg(F.sum("rows").alias("rows"), F.sum("one").alias("ones")))


SCHEMA = pa.schema([("cluster", pa.int32()), ("plane", pa.int32()), ("negative", pa.bool_()), ("rows", pa.int64()),
                    ("ones", pa.list_(pa.int64()))])


def moved(table: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """One round: each centroid with vectors becomes floor(sum / count) of them, the others stay.

    What comes to the driver are counts, at most clusters x planes x PARTS rows whatever the number of vectors.
    """
    sums: dict[int, list[int]] = {}
    counts: dict[int, int] = {}
    for r in bit_counts(table, as_planes(centroids)).collect():
        row = sums.setdefault(r["cluster"], [0] * PARTS)
        row[r["j"]] += r["ones"] * (-(1 << r["plane"]) if r["negative"] else 1 << r["plane"])
        if r["plane"] == 0 and r["j"] == 0:
            counts[r["cluster"]] = r["rows"]
    return [[s // counts[k] for s in sums[k]] if k in sums else c for k, c in enumerate(centroids)]


def as_planes(centroids: list[list[int]]) -> np.ndarray:
    numbers = np.array(centroids, object)
    if max(abs(x) for row in centroids for x in row) < 1 << 62:
        numbers = numbers.astype(np.int64)
    return pack(numbers)


def as_numbers(planes: np.ndarray) -> list[list[int]]:
    bits = np.unpackbits(planes.astype("<u8").view(np.uint8).reshape(*planes.shape, 8), axis=2, bitorder="little")
    w = weights(planes.shape[1])
    return [[sum(w[p] for p in range(len(w)) if row[p, j]) for j in range(PARTS)] for row in bits]


def first_centroids(table: DataFrame, k: int, id_col: str = "vec_id") -> list[list[int]]:
    """The ``k`` vectors whose ids hash smallest, in the order of the hashes; ties by the vectors' planes."""
    mark = F.sha2(F.concat(F.lit("2:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    found = table.select(mark.alias("mark"), "planes").orderBy("mark", "planes").limit(k).collect()
    return [as_numbers(np.array([r["planes"]], np.int64).view(np.uint64))[0] for r in found]


def cluster(rows: DataFrame, k: int = 40, rounds: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per vector: vec_id, cluster, distance, cluster_inertia, inertia and centroid (its final components).

    Vectors that are null, hold a null or non-finite component or do not have 64 components take no part. Repeated and
    null ids give a row each (a null id hashes as an empty one). Fewer than ``k`` vectors give as many centroids. Components of
    any finite size are exact; a distance or an inertia beyond a long is null. An empty table gives an empty result.
    Other columns are not read.

    Planes are written once to the shared folder (eight bytes a plane, of which small numbers need few) and read in each
    round. Centroids, ``k`` x 64 numbers, go out with the tasks.
    """
    table = stage(planes_of(rows, vector_col, [F.col(id_col).alias("vec_id")]), "planes")
    kind = table.schema["vec_id"].dataType.simpleString()
    centroids = first_centroids(table, k)
    if not centroids:
        return table.selectExpr("vec_id", "0 AS cluster", "0L AS distance", "0L AS cluster_inertia", "0L AS inertia",
                                "array('') AS centroid")
    for _ in range(rounds):
        centroids = moved(table, centroids)
    final = as_planes(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, planes in blocks(batch):
                found, distance = nearest(planes, final)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(pa.array(at)), pa.array(found, pa.int32()), pa.array([str(d) for d in distance.tolist()])],
                    names=["vec_id", "cluster", "exact"])

    assigned = stage(table.mapInArrow(assign, f"vec_id {kind}, cluster int, exact string"), "assigned")
    totals: dict[int, int] = {}
    # Distances of up to 29 digits are added up by Spark; longer ones, which only huge components have, add to nothing else.
    for r in assigned.groupBy("cluster").agg(F.sum(F.expr("try_cast(exact AS decimal(29,0))")).alias("sum"),
                                             F.max(F.length("exact")).alias("digits")).collect():
        totals[r["cluster"]] = int(r["sum"]) if r["digits"] < 30 and r["sum"] is not None else 1 << 63
    total = sum(totals.values())
    spark = rows.sparkSession
    known = spark.createDataFrame([(c, _long(t), _long(total), [str(x) for x in centroids[c]]) for c, t in totals.items()],
                                  "cluster int, cluster_inertia long, inertia long, centroid array<string>")
    return (assigned.withColumn("distance", F.expr("try_cast(exact AS bigint)")).drop("exact")
            .join(F.broadcast(known), "cluster")        # at most k rows
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"))


def _long(x: int) -> int | None:
    return x if x < 1 << 63 else None
