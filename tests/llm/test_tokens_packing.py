from __future__ import annotations

import os
import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from signalbase.llm.packing import Rounds, pack
from signalbase.llm.queries import vocabulary
from signalbase.llm.tokens import Encoder, PLAIN, count_tokens, safe_pieces

os.environ["TOKENIZERS_PARALLELISM"] = "false"
EXACT = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
ENCODER = Encoder(*vocabulary())


def ids(text: str) -> list[int]:
    return EXACT.encode(text, add_special_tokens=False).ids


def odd_texts() -> list[str]:
    rng = random.Random(8)
    words = ["the", "Élan", "groß", "don't", "1234", "!!", "x=1", "東京都", "привет", "\n\n", "  ", "é"]
    return ["", " ", "<|endoftext|> in <|endoftext|>", "a​b\x00c\x85d\x1ce", "’s 's 'S", "😀 family 👨‍👩‍👧 ", "a" * 5000,
            " ".join(rng.choices(words, k=30_000)), "".join(rng.choices(words, k=3000)), "東" * 40_000, "a\r\n\r\n  b\t\tc   "]


def test_ids_are_those_of_the_library():
    for text, got in zip(odd_texts(), ENCODER.ids(odd_texts())):
        assert got.tolist() == ids(text)


def test_plain_characters_are_cut_alike():
    for c in map(chr, range(0x10000)):
        if PLAIN.fullmatch(c):
            text = f"a{c}b {c}{c} 1{c}2 {c}\n{c}.{c}'s  {c}"
            assert ENCODER.plain.encode(text, allowed_special="all") == ids(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=200))
def test_any_text(text):
    assert next(ENCODER.ids([text])).tolist() == ids(text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["ab", "É", " ", "\n", "。", "東", "'s", "!", "7"]), max_size=60).map("".join), st.integers(1, 20))
def test_pieces_keep_the_tokens(text, limit):
    pieces = list(safe_pieces(text, limit))
    assert "".join(pieces) == text and [i for p in pieces for i in ids(p)] == ids(text)


def test_counts(docs):
    rows = [(i, t, "en", "s") for i, t in enumerate(odd_texts())] + [(None, None, "en", None), (3, "again", "en", "s"), (3, "again", "en", "s")]
    got = sorted(map(str, count_tokens(docs(rows), *vocabulary()).collect()))
    want = [(i, len((t or "").encode()), len(ids(t or ""))) for i, t, _, _ in rows]
    assert got == sorted(f"Row(doc_id={i}, n_bytes={b}, n_tokens={n}, over_limit={n > 1024})" for i, b, n in want)
    assert count_tokens(docs([]), *vocabulary()).count() == 0


def check_packed(rows: list[tuple], pieces: list, length: int) -> None:
    """Each id in one piece, sequences gapless from 0, full but for powers of two."""
    tokens: dict = {}
    for i, t, _, _ in rows:
        tokens.setdefault(i, []).append(ids(t or "") + [0])
    for i, texts in tokens.items():
        assert len(texts) == 1
        place = 0
        for p in sorted((p for p in pieces if p["doc_id"] == i), key=lambda p: p["start"]):
            assert p["start"] == place and p["doc_tokens"] == len(texts[0])
            part = texts[0][place:place + p["length"]]
            assert p["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            place += p["length"]
        assert place == len(texts[0])
    sequences: dict = {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for held in sequences.values():
        end = 0
        for offset, size in sorted(held):
            assert offset == end and size > 0
            end += size
        assert end == length or end < length and end.bit_count() == 1
    assert sorted(sequences) == list(range(len(sequences)))


def test_packing_round_trip(docs):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choices(["alpha", "bet", "zz9", "ñandú"], k=rng.choice([0, 3, 40, 900]))), "en",
             rng.choice(["big"] * 6 + ["small", "tiny", None])) for i in range(120)] + [(500, None, "en", "null text"), (501, " ".join(["long"] * 30_000), "en", "big")]
    for queues in (256, 3):
        pieces = pack(docs(rows), *vocabulary(), max_queues=queues).collect()
        check_packed(rows, pieces, 1024)
    assert pack(docs([]), *vocabulary()).count() == 0


def test_windows_hold_each_source_in_proportion():
    rounds = Rounds([50_000, 30_000, 19_999, 7], window=1000, length=100)
    filled: dict = {}
    for q, n in enumerate(rounds.totals):
        for first in range(0, n, 777):
            for _, size, sequence, offset in rounds.pieces(q, first, min(777, n - first)):
                for place in range(sequence * 100 + offset, sequence * 100 + offset + size):
                    filled[place] = q
    assert sorted(filled) == [*range(100_000), *range(100_000, 100_004), *range(100_100, 100_102)]  # tail: 4 and 2 tokens
    for w in range(0, 100_000, 1000):
        for q, n in enumerate(rounds.totals):
            got = sum(filled[p] == q for p in range(w, w + 1000))
            assert abs(got - 1000 * n / 100_006) <= 5


def test_sources_that_share_a_queue_have_their_share_of_each_window(docs):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choices(["alpha", "bet", "zz9"], k=60)), "en", f"s{i % 37}" if i % 2 else "big") for i in range(740)]
    pieces = pack(docs(rows), *vocabulary(), length=128, window=16, max_queues=2).collect()
    check_packed(rows, pieces, 128)
    total = sum(p["length"] for p in pieces)
    of_source: dict = {}
    for p in pieces:
        window = p["sequence_id"] // 16
        of_source.setdefault(p["source"], {}).setdefault(window, []).append(p["length"])
    assert len(of_source) == 38
    for held in of_source.values():
        share = sum(map(sum, held.values())) / total
        for window in range(total // 2048):
            assert abs(sum(held.get(window, [])) - 2048 * share) <= 7


def test_targets_fill_windows_until_a_queue_is_empty(docs):
    """Windows hold the asked shares while all queues last, and the others' proportions after that; nothing is lost."""
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices(["alpha", "bet", "zz9"], k=60)), "en", ["a", "a", "a", "b", None][i % 5]) for i in range(900)]
    pieces = pack(docs(rows), *vocabulary(), length=128, window=16, targets={"b": 0.5, "a": 0.3}).collect()
    check_packed(rows, pieces, 128)
    size: dict = {}
    for p in pieces:
        at = size.setdefault(p["sequence_id"] // 16, {})
        at[p["source"]] = at.get(p["source"], 0) + p["length"]
    total = {x: sum(w.get(x, 0) for w in size.values()) for x in ("a", "b", None)}
    first_empty = int(min(total["b"] / 0.5, total["a"] / 0.3, total[None] / 0.2) / 2048)
    assert first_empty > 3
    for w in range(first_empty):
        assert all(abs(size[w].get(x, 0) - 2048 * share) <= 3 for x, share in (("b", 0.5), ("a", 0.3), (None, 0.2)))
    after = size[first_empty + 1]
    assert after.get("b", 0) == 0 and abs(after["a"] / after[None] - 1.5) < 0.02


def test_rounds_by_weight_place_each_token_once():
    rng = random.Random(3)
    for _ in range(30):
        totals, length = [rng.randint(1, 3000) for _ in range(rng.randint(1, 6))], rng.choice([7, 16])
        rounds = Rounds(totals, length * rng.randint(1, 9), length, [rng.randint(1, 9) for _ in totals])
        places = []
        for q, n in enumerate(totals):
            at = 0
            while at < n:
                size = min(n - at, rng.randint(1, 400))
                for start, part, sequence, offset in rounds.pieces(q, at, size):
                    places += [(sequence, offset + k) for k in range(part)]
                at += size
        assert len(set(places)) == len(places) == sum(totals)
        held: dict = {}
        for sequence, offset in places:
            held.setdefault(sequence, []).append(offset)
        assert all(sorted(v) == list(range(len(v))) for v in held.values())


def test_tokens_are_not_shuffled(docs):
    """The counts that place a document's tokens are known to be small, so they go to the tokens."""
    table = docs([(i, "alpha bet", "en", f"s{i % 3}") for i in range(50)])
    plan = pack(table, *vocabulary())._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
