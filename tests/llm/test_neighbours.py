from __future__ import annotations

import math

import numpy as np
import pytest

from signalbase.llm.neighbours import Tree, nearest


def vectors(shipped, rows):
    from pyspark.sql import functions as F

    table = shipped.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    return table.withColumns({c: F.lit("x") for c in ("v", "id", "shard", "block", "r", "d", "rank", "score")})


def plain(rows, k=10):
    good = {(i, tuple(float(np.float32(x)) for x in v)) for i, v in rows
            if i is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)}
    out = {}
    for q, a in good:
        if q % 100 == 0:
            for i, b in good:
                if i != q and len(a) == len(b):
                    total = 0.0
                    for x, y in zip(a, b):
                        total += (x - y) * (x - y)
                    key = (q, i)
                    out[key] = min(out.get(key, math.inf), math.sqrt(total))
    ranked = []
    for q in {q for q, _ in out}:
        best = sorted((s, i) for (p, i), s in out.items() if p == q)[:k]
        ranked += [(q, n + 1, i, s) for n, (s, i) in enumerate(best)]
    return sorted(ranked)


def rows_with_all_cases():
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(900)]
    rows += [(1000 + i, [0.5] * 8) for i in range(60)]                     # ties
    rows += [(5000, [1.0, None] + [0.0] * 6), (5100, [math.nan] + [1.0] * 7), (5200, [math.inf] * 8), (5300, [0.0] * 8), (5400, None),
             (5500, []), (None, [1.0] * 8), (300, rng.normal(size=8).tolist()), (5600, [1.0, 2.0]), (5601, [1.0, 2.5])]
    return rows + rows[:3] + rows[950:953]


@pytest.mark.parametrize("shard_rows,block_queries", [(8192, 4096), (100, 3)])
def test_exact_search_matches_brute_force(shipped, shard_rows, block_queries):
    rows = rows_with_all_cases()
    got = nearest(vectors(shipped, rows), shard_rows=shard_rows, block_queries=block_queries).collect()
    assert sorted(map(tuple, got)) == plain(rows)


def test_empty_table(shipped):
    assert nearest(vectors(shipped, [])).count() == 0


def test_a_larger_factor_visits_less_and_recalls_most():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 16))
    points = centres[rng.integers(40, size=6000)] + 0.25 * rng.normal(size=(6000, 16))
    ids = np.arange(6000)
    tree = Tree(points)
    exact = tree.search(points[::100], ids[::100], ids, 10, 1.0)
    loose = tree.search(points[::100], ids[::100], ids, 10, 1.5)
    want, got = set(zip(*map(np.ndarray.tolist, exact[:2]))), set(zip(*map(np.ndarray.tolist, loose[:2])))
    assert len(want) == 600 and len(want & got) >= 0.9 * len(want)


def test_bounds_never_exceed_distances():
    rng = np.random.default_rng(5)
    points, queries = rng.normal(size=(1000, 6)), rng.normal(size=(20, 6))
    tree = Tree(points, leaf=16)
    bounds = tree.bounds(queries)
    assert sorted(np.concatenate([m for m, _ in tree.leaves]).tolist()) == list(range(1000))
    for i, (members, _) in enumerate(tree.leaves):
        d = np.linalg.norm(queries[:, None] - points[members][None], axis=2)
        assert (bounds[:, i] <= d.min(axis=1) + 1e-12).all()
