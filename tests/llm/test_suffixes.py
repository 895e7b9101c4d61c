from __future__ import annotations

import collections
import random

import numpy as np
import pytest

from signalbase.llm import suffixes
from signalbase.llm.suffixes import gram_hashes, remove_repeats, repeated_windows, sliding_least


def plain(texts, width=200):
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[i:i + width] for b in raw for i in range(len(b) - width + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - width + 1):
            if seen[b[i:i + width]] > 1:
                gone[i:i + width] = True
        edges = np.diff(np.r_[0, gone.astype(int)])
        out.append((len(b), int(gone.sum()), int((edges == 1).sum()), bytes(np.frombuffer(b, np.uint8)[~gone])))
    return out


def corpus(seed):
    rng = random.Random(seed)

    def words(n):
        return " ".join("".join(rng.choices("abcdeé", k=rng.randint(1, 7))) for _ in range(n))

    passage, edge, short = words(120), words(60)[:199], words(40)[:150]
    texts = [None, "", "x", "a" * 199, "b" * 200, "c" * 201, "c" * 450, "ab" * 700, words(4000), "d" * 200 + words(5) + "d" * 200]
    for _ in range(60):
        kind = rng.randrange(6)
        if kind == 0:
            texts.append(words(30) + passage[rng.randrange(200):] + words(20))
        elif kind == 1:
            texts.append(words(10) + edge + words(10))
        elif kind == 2:
            texts.append(texts[rng.randrange(4, len(texts))])
        elif kind == 3:
            base = (texts[rng.randrange(8, len(texts))] or "").split(" ")
            base[rng.randrange(len(base))] = "changed"
            texts.append(" ".join(base))
        elif kind == 4:
            texts.append(passage[:rng.randint(150, 400)] + words(15) + short + passage[-rng.randint(150, 400):])
        else:
            texts.append(words(rng.randint(1, 200)))
    return texts


@pytest.mark.parametrize("seed,limit", [(1, 4096), (2, 4096), (3, 1)])
def test_matches_counting_all_strings(docs, monkeypatch, seed, limit):
    """With limit 1 all anchors go the way of very frequent ones."""
    monkeypatch.setattr(suffixes, "SPLIT_RUNS", limit)
    texts = corpus(seed)
    rows = [(i if i % 9 else i // 9 % 2 or None, t, "en", "s") for i, t in enumerate(texts)]     # some ids repeat, some are null
    got = sorted((tuple(r) for r in remove_repeats(docs(rows)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()), key=str)
    want = sorted(((r[0], *w) for r, w in zip(rows, plain(texts))), key=str)
    assert [(*g[:4], bytes(g[4])) for g in got] == want
    assert sum(w[2] for w in want) > 1000


def test_empty_table(docs):
    assert remove_repeats(docs([])).count() == 0


def test_parts():
    rng = np.random.default_rng(2)
    data = rng.integers(0, 3, 500, dtype=np.uint8)
    h = gram_hashes(data, 4)
    strings = [bytes(data[i:i + 4]) for i in range(497)]
    assert len(set(h.tolist())) == len(set(strings)) == len(set(zip(h.tolist(), strings)))
    values = rng.integers(0, 1000, 777).astype(np.uint64)
    assert sliding_least(values, 161).tolist() == [int(values[i:i + 161].min()) for i in range(617)]
    flags = repeated_windows([b"xxabcd", b"yabcdz", b"abq"], [2, 1, 0], 3)
    assert [f.tolist() for f in flags] == [[False, False, True, True], [False, True, True, False], [False]]
