"""Bit-plane clustering against plain whole-number arithmetic."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import oracle
import pytest

from signalbase.llm import clusters
from signalbase.llm.queries import ORACLES, QUERIES


def plain(rows, k=40, rounds=5):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    mark = lambda i: hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(good, key=lambda r: mark(r[0]))[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        found = [near(v)[1] for _, v in good]
        for n in range(len(centroids)):
            mine = [v for (_, v), f in zip(good, found) if f == n]
            if mine:
                centroids[n] = [sum(col) // len(mine) for col in zip(*mine)]
    found = [near(v) for _, v in good]
    inertia = [sum(d for d, n in found if n == m) for m in range(len(centroids))]
    long = lambda x: x if x < 1 << 63 else None
    return sorted((str(i), n, long(d), long(inertia[n]), long(sum(inertia)), ",".join(map(str, centroids[n]))) for (i, _), (d, n) in zip(good, found))


def check(spark, rows, **kw):
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, planes string, cluster int")
    got = sorted(((str(r["vec_id"]), r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], ",".join(r["centroid"]))
                  for r in clusters.cluster(table.repartition(3), **kw).collect()), key=str)
    assert got == sorted(plain(rows, **kw), key=str)
    return got


def vectors(n, seed=1, scale=1.0):
    rng = random.Random(seed)
    return [(i * 7 + 1, [rng.gauss(0, scale) for _ in range(64)]) for i in range(n)]


def test_matches_plain_rounds(shipped):
    rows = vectors(300)
    rows += [(1000, [0.5] * 64), (1001, [0.5] * 64), (1001, [0.5] * 64), (1002, [0.0] * 64), (1003, [-0.0] * 64), (1004, None), (1005, []),
             (1006, [1.0] * 63), (1007, [1.0] * 63 + [None]), (1008, [float("nan")] * 64), (1009, [1.0] * 63 + [float("-inf")]), (None, [-3.25] * 64)]
    assert len(check(shipped, rows)) == 306


def test_many_copies_leave_empty_centroids(shipped):
    rows = vectors(20, 2) + [(5000 + i, [0.25] * 64) for i in range(100)]
    check(shipped, rows, k=30)


@pytest.mark.parametrize("rows", [[], [(1, [2.0] * 64)], vectors(5, 3)])
def test_few_vectors(shipped, rows):
    check(shipped, rows)


def test_huge_components_are_exact(shipped):
    """Components far beyond 64 bits are clustered exactly; only what a long cannot hold is null."""
    rows = vectors(12, 4) + vectors(5, 5, 1e9) + [(900, [3e38] * 64), (901, [-3e38, 1.0] * 32)]
    rows = [(n * 13 + 5, v) for n, (_, v) in enumerate(rows)]
    got = check(shipped, rows, k=6, rounds=3)
    assert any(r[2] is None or r[4] is None for r in got)


def test_planes_give_exact_products():
    rng = np.random.default_rng(1)
    for scale in (1, 100, 1 << 20, 1 << 40):
        x, c = (rng.integers(-scale, scale + 1, (n, 64)) for n in (50, 7))
        px, pc = clusters.pack(x), clusters.pack(c)
        want = np.array(x.astype(object) @ c.astype(object).T)
        assert (clusters.dots(px, pc) == want).all() and (clusters.norms(px) == (x.astype(object) ** 2).sum(axis=1)).all()
        assert clusters.as_numbers(px) == x.tolist()
        assert (clusters.dots(clusters.widen(px, px.shape[1] + 3), pc) == want).all()


def test_query_equals_its_twin(shipped):
    folder = "/root/testdata/sf0.001"
    columns, rows = oracle.spark_rows(QUERIES["op12_bit_plane_clusters"](shipped, folder))
    want_columns, want = oracle.duck_rows(oracle.connect(folder), ORACLES["op12_bit_plane_clusters"])
    assert columns == want_columns and rows == want and rows
