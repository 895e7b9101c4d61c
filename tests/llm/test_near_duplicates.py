"""SimHash near duplicates against a plain version, and the parts they are made of."""

from __future__ import annotations

import random

import numpy as np
import xxhash

from signalbase.llm.components import components
from signalbase.llm.simhash import fingerprint, forest, near_duplicates, pairs_of, pivots


def plain_fingerprint(text: str | None) -> int:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered:
        if c in " \t\n\x0b\x0c\r":
            words, word = words + [word] * bool(word), ""
        else:
            word += c
    words += [word] * bool(word)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(items: list[tuple[int | None, int]], distance: int = 3) -> list[int | None]:
    parent = list(range(len(items)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(items)):
        for j in range(i):
            if (items[i][1] ^ items[j][1]).bit_count() <= distance:
                parent[top(i)] = top(j)
    out = []
    for i in range(len(items)):
        ids = [items[j][0] for j in range(len(items)) if top(j) == top(i) and items[j][0] is not None]
        out.append(min(ids, default=None))
    return out


def texts(n: int, seed: int = 3) -> list[str | None]:
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    out: list[str | None] = [None, "", " \n\t", "One", "one", "Two words", "É  è x y", " ".join(rng.choices(words, k=9000))]
    while len(out) < n:
        base = rng.choices(words, k=rng.randint(3, 400))
        out.append(" ".join(base))
        for _ in range(rng.choice([0, 0, 1, 4])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append(" ".join(copy))
    return out


def test_fingerprint_matches_plain_version():
    for text in texts(150):
        assert fingerprint(text) == plain_fingerprint(text)


def test_near_duplicates_match_all_pairs(docs):
    rows = [(i, t, "en", "s") for i, t in enumerate(texts(250))]
    rows += [(None, rows[20][1], "en", "s"), (None, "no id and no copy of it anywhere", "en", None), rows[30], rows[30]]
    got = sorted(tuple(r) for r in near_duplicates(docs(rows)).selectExpr("coalesce(doc_id, -1)", "fingerprint", "component_id").collect())
    items = [(i, plain_fingerprint(t)) for i, t, _, _ in rows]
    want = sorted((-1 if i is None else i, f"{fp:016x}", c) for (i, fp), c in zip(items, plain_components(items)))
    assert sorted(got, key=str) == sorted(want, key=str)
    assert len({c for _, _, c in want}) < len(rows) - 20


def test_empty_table(docs):
    assert near_duplicates(docs([])).count() == 0


def test_large_buckets_are_cut_into_cells(shipped, monkeypatch):
    from signalbase.llm import simhash

    monkeypatch.setattr(simhash, "HOT_BUCKET", 4)
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 62, 6, dtype=np.uint64)
    fps = set(base.tolist())
    for b in base.tolist():
        for _ in range(60):
            fps.add(b ^ sum(1 << int(i) for i in rng.choice(30, rng.integers(1, 7), replace=False)))
    fps = sorted(fps)
    table = shipped.createDataFrame([(f,) for f in fps], "fp long")
    parts = {r["node"]: r["root"] for r in components(simhash.links(table)).collect()}
    got = [parts.get(f, f) for f in fps]
    want = plain_components([(f, f) for f in fps])
    assert [(a == b) for a in got for b in got] == [(a == b) for a in want for b in want]


def test_pivots_discard_no_pair():
    rng = np.random.default_rng(1)
    fps = rng.integers(0, 1 << 12, 700, dtype=np.uint64)
    coordinates = np.bitwise_count(fps[:, None] ^ pivots()[None, :]).astype(np.int8)
    blocks = list(pairs_of(fps, coordinates, 3))
    got = {tuple(sorted(p)) for a, b in blocks for p in zip(a.tolist(), b.tolist())}
    want = {(i, j) for j in range(700) for i in range(j) if int(fps[i] ^ fps[j]).bit_count() <= 3}
    assert got == want
    a, b = forest(700, iter(blocks))
    assert len(a) < 700 and set(map(tuple, np.sort(np.stack([a, b]), axis=0).T.tolist())) <= want
    label = {x: x for x in range(700)}
    for x, y in sorted(want) * 20:
        label[x] = label[y] = min(label[x], label[y])
    assert len(a) == 700 - len(set(label.values()))


def test_components_of_long_chains_and_stars(shipped):
    rng = random.Random(2)
    chain = list(range(100, 400))
    rng.shuffle(chain)
    links = list(zip(chain, chain[1:])) + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5)]
    got = {r["node"]: r["root"] for r in components(shipped.createDataFrame(links, "a long, b long")).collect()}
    assert set(got[n] for n in chain) == {100} and set(got[n] for n in range(1000, 1200)) == {1000} and 5 not in got
