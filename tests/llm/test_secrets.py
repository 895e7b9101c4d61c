from __future__ import annotations

import hashlib
import re

import numpy as np
from hypothesis import given, settings, strategies as st

from signalbase.llm import secrets as S


def plain_base(text):
    found = []
    pattern = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)"""
    found += [(m.start(), m.end(), 0) for m in re.finditer(pattern, text) if len(m[2]) >= 6]
    found += [(m.start(), m.end(), 1) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), m.end(), 2) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda s: (s[0], s[2]))


PARTS = st.sampled_from(["password", "PassWd", "ſecret", "toKen", "api_key", "apikey", "=", ":", " ", '"', "'", "abc123", "x", "AKIA",
                         "A1B2C3D4E5F6G7H8", "0123456789abcdef01234567", "é", "\n", "[", "==", "secret=short"])


@settings(max_examples=400, deadline=None)
@given(st.lists(PARTS, max_size=25).map("".join))
def test_base_spans(text):
    assert S.base_spans(text) == plain_base(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["word", "a1", "=", "key", ":", '"', "0123456789abcdef", " ", "\n", "x" * 25, ".", "-", "7"]), max_size=60).map("".join))
def test_chains_found_by_search_are_all(text):
    def key(found):
        return [(places, feats) for places, feats in found]

    assert key(S.chains(text)) == key(S.chains(text, whole=True))


def test_viterbi_finds_the_best_path():
    field = S.trained()
    rng = np.random.default_rng(1)
    names = list(field.index)
    for _ in range(60):
        feats = [list(rng.choice(names, 5)) for _ in range(rng.integers(1, 6))]
        emit = field.scores(feats)

        def value(path):
            full = [S.O, *path, S.O]
            return sum(field.step[a, b] for a, b in zip(full, full[1:])) + sum(emit[t, y] for t, y in enumerate(path))

        paths = [[]]
        for _ in feats:
            paths = [[*p, y] for p in paths for y in range(3)]
        assert value(field.decode(feats)) == max(map(value, paths))


def field_spans(text):
    out = []
    for places, feats in S.chains(text):
        for (s, e), label in zip(places, S.trained().decode(feats)):
            if label == S.B:
                out.append([s, e])
            elif label == S.I:
                out[-1][1] = e
    return [tuple(x) for x in out]


def test_held_out_accuracy():
    held = S.examples(seed=4242, count=1000)
    right = sum(field_spans(t) == spans for t, spans in held)
    false = sum(bool(field_spans(t)) for t, spans in held if not spans)
    assert right >= 0.97 * len(held) and false <= 0.01 * len(held)


def test_field_adds_what_the_patterns_miss():
    text = "the bearer q9X2mZ7tLp0RvB4nKd83WsYh and 12.5.2024, order 48213, version 3.1"
    assert [text[s:e] for s, e, k in S.all_spans(text, S.trained())] == ["q9X2mZ7tLp0RvB4nKd83WsYh"]
    assert S.all_spans("Call +49 171 5553 21 on 2024-11-05, see https://a.example.org/x/12.", S.trained()) == []


def test_scan_and_masking(docs):
    rows = [(1, 'é password="hunter22" and token: abc', "en", "s"), (2, None, "en", None), (3, "", "en", "s"), (None, "AKIA" + "X" * 16, "en", "s"),
            (4, "f" * 30 + " secret = " + "0" * 24, "en", "s"), (4, "plain words", "en", "s"), (5, "word " * 50_000 + "passwd:abcdef", "en", "s")]
    got = {(r["doc_id"], r["spans"]): r for r in S.scan(docs(rows)).collect()}
    assert len(got) == len(rows)
    want = [",".join(f"{S.KINDS[k]}:{s}:{e}" for s, e, k in plain_base(t or "")) for _, t, _, _ in rows]
    assert set(got) == {(i, w) for (i, _, _, _), w in zip(rows, want)}
    for (_, spans), r in got.items():
        assert r["base_sha256"] == hashlib.sha256(spans.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in S.KINDS] == [spans.count(f"{k}:") for k in S.KINDS]
    table = docs(rows)
    out = S.mask_secrets(table)
    assert out.columns == table.columns and out.count() == len(rows)
    texts = {r["text"] for r in out.collect()}
    assert 'é [secret]" and token: abc' in texts and None in texts and "plain words" in texts and "[secret] [secret]" in texts
    assert S.scan(docs([])).count() == 0


def test_letters_names_with_values_and_joined_parts():
    field = S.trained()
    for text, want in [("the password is hQzVbTnKwEyRpLm and more", ["hQzVbTnKwEyRpLm"]),
                       ("connect pwd=Zk8QmPw2xTn4Lq now", ["Zk8QmPw2xTn4Lq"]), ("auth=kQzVbTnKwEyRpLmXw ok", ["kQzVbTnKwEyRpLmXw"]),
                       ("the key is rTqWz#x7Kp2Lm$wQzTbK then", ["rTqWz#x7Kp2Lm$wQzTbK"]),
                       ("the password is required for each login page", []),
                       ("Note: the following token was used by the author: nothing important", [])]:
        assert [text[s:e] for s, e, k in S.all_spans(text, field) if k == 3] == want


def test_field_span_beyond_a_base_span_is_kept():
    text = "set password=abc123!Qz7wLkPmXr3 next"
    spans = S.all_spans(text, S.trained())
    assert [(text[s:e], k) for s, e, k in spans] == [("password=abc123", 0), ("!Qz7wLkPmXr3", 3)]
    assert S.masked(text, spans) == "set [secret][secret] next"
