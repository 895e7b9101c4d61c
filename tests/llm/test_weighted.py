from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import pytest

from signalbase.llm import weighted
from signalbase.llm.weighted import edited_pairs, fingerprints, likeness, signature, terms


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefghé", k=rng.randint(2, 6))) for _ in range(n))


@pytest.mark.parametrize("blocks", [1, 7, 400])
def test_edited_pairs_match_a_plain_walk(docs, blocks):
    rng = random.Random(3)
    rows = [(i * 3, rng.choice([words(rng, 40), words(rng, 3), "", "é", None, words(rng, 900)]), "en", "s") for i in range(130)]
    rows += [(-5, "below", "en", "s"), (1 << 60, "far above", "en", "s"), ((1 << 60) + 1, "one more", "en", "s"), (None, "no id", "en", None)]
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    want = []
    for k, (i, t, _, _) in enumerate(order):
        following = order[(k + 1) % len(order)][1] or ""
        t = t or ""
        n = len(t)
        edited = t[:n - n // 2] + following[:n // 2]
        a, b, c = signature(t), signature(edited), signature(following)
        want.append((i, n, hashlib.sha256(edited.encode()).hexdigest(), a.astype(">u2").tobytes().hex(),
                     b.astype(">u2").tobytes().hex(), likeness(a, b), likeness(a, c)))
    got = [tuple(r) for r in edited_pairs(docs(rows), blocks=blocks).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_repeated_ids_and_rows(docs):
    rows = [(5, "first words here", "en", "s")] * 3 + [(5, "other text of five", "en", "s"), (2, "last one", "en", "s"), (None, "a b", "en", "s"), (None, "c d", "en", "s")]
    got = edited_pairs(docs(rows), blocks=5).collect()
    assert sorted((r["doc_id"] or 0, r["n_chars"]) for r in got) == sorted((i or 0, len(t)) for i, t, _, _ in rows)
    for rows in ([(1, "alone", "en", "s")], [(None, "alone", "en", "s")]):
        one, = edited_pairs(docs(rows)).collect()
        assert one["near_next"] == 1.0
    assert edited_pairs(docs([])).count() == 0


def test_collision_rate_is_generalised_jaccard():
    rng = random.Random(9)
    errors = []
    for k in range(150):
        a = rng.choices(words(rng, 60).split(), k=120)
        b = a[:rng.randint(0, 120)] + rng.choices(words(rng, 60).split(), k=rng.randint(1, 120))
        x, y = (dict(zip(*(v.tolist() for v in terms(" ".join(t))))) for t in (a, b))
        keys = set(x) | set(y)
        true = sum(min(x.get(t, 0), y.get(t, 0)) for t in keys) / sum(max(x.get(t, 0), y.get(t, 0)) for t in keys)
        errors.append(likeness(signature(" ".join(a)), signature(" ".join(b))) - true)
    assert abs(np.mean(errors)) < 0.012 and np.std(errors) < 0.07


def test_terms_count_shingles():
    text = "a b a b a c"
    assert sorted(terms(text)[1].tolist()) == sorted(map(float, collections.Counter(zip(text.split(), text.split()[1:])).values()))
    assert signature("") .tolist() == [0] * weighted.SAMPLES and signature("one").any()


def test_equal_texts_have_equal_fingerprints(docs):
    rows = [(i, "same text in both", "en", "s") for i in range(3)] + [(9, None, "en", "s")]
    got = {r["doc_id"]: r["fingerprint"] for r in fingerprints(docs(rows)).collect()}
    assert got[0] == got[1] == got[2] != got[9] and set(got[9]) == {"0"}


def test_long_texts_are_as_alike_as_their_shingles():
    """True likeness from the words themselves, at lengths at which terms would share bins."""
    rng = random.Random(12)
    errors, unlike = [], []
    for share in (0.0, 0.0, 0.0, 0.3, 0.6, 0.9):
        a = [f"a{rng.randrange(10 ** 6)}" for _ in range(20_000)]
        b = a[:int(share * len(a))] + [f"b{rng.randrange(10 ** 6)}" for _ in range(len(a) - int(share * len(a)))]
        x, y = (collections.Counter(zip(t, t[1:])) for t in (a, b))
        true = sum((x & y).values()) / sum((x | y).values())
        got = likeness(signature(" ".join(a)), signature(" ".join(b)))
        (errors if share else unlike).append(got - true)
    assert max(unlike) <= 1 / weighted.SAMPLES and max(map(abs, errors)) < 0.2


def test_variates_have_their_distributions():
    a, e, r = weighted.variates(weighted.uniforms(np.random.default_rng(1).integers(0, 1 << 64, 20_000, dtype=np.uint64)))
    a, e, r = (v.astype(float) for v in (a, e, r))
    b, c = e / r, a / np.exp(-(r - e))
    for gamma in (r, c):        # gamma(2, 1): mean 2, variance 2, P(x < 1) = 1 - 2 / e
        assert abs(gamma.mean() - 2) < 0.01 and abs(gamma.var() - 2) < 0.03 and abs((gamma < 1).mean() - 0.2642) < 0.002
    assert abs(b.mean() - 0.5) < 0.002 and abs(b.var() - 1 / 12) < 0.001 and 0 <= b.min() and b.max() <= 1
    for x, y in ((r, c), (r, b), (c, b), (r[:, :-1], r[:, 1:]), (c[:, :-1], c[:, 1:])):
        assert abs(np.corrcoef(x.ravel(), y.ravel())[0, 1]) < 0.01
