from __future__ import annotations

import random

import pytest
from hypothesis import given, settings, strategies as st

from signalbase.llm.mixing import apply_mix, mix, source_targets


def plain_targets(sizes: dict[str | None, int]) -> dict[str | None, float]:
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    left, free, out = float(sum(sizes.values())), set(order), {}
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if share[s] > 3 * sizes[s]}
        if not above:
            return out | share
        for s in above:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
        free -= above
    return out


def corpus(seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 30, 700])), "en", rng.choice(["a", "a", "a", "b", "Z", "é", None]))
            for i in range(400)]
    return rows + [(1000, None, "en", "b"), (1001, " \n", "en", "only empty"), (None, "x y", "en", "a"), rows[3], rows[3]]


@pytest.mark.parametrize("block_rows", [1, 40, 4096])
def test_mix_meets_each_budget(docs, block_rows):
    rows = corpus()
    got = mix(docs(rows), block_rows=block_rows).collect()
    assert len(got) == len(rows)
    sizes: dict = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = plain_targets(sizes)
    taken: dict = {}
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == sizes[r["source"]]
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"] + r["cut"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for s, n in taken.items():
        assert n == int(want[s] + 1e-9)


def test_reruns_and_block_sizes_agree(docs):
    rows = corpus(4)
    runs = [sorted(map(str, mix(docs(rows), block_rows=b).collect())) for b in (3, 4096, 4096)]
    assert runs[0] == runs[1] == runs[2]


def test_mixed_corpus_holds_the_words_taken(docs):
    rows = corpus(2)
    table = docs(rows)
    plan = mix(table).collect()
    out = apply_mix(table)
    assert out.columns == table.columns
    got: dict = {}
    for r in out.collect():
        got[r["source"]] = got.get(r["source"], 0) + len((r["text"] or "").split())
    want: dict = {}
    for r in plan:
        want[r["source"]] = want.get(r["source"], 0) + r["taken"]
    assert {s: n for s, n in got.items() if n} == {s: n for s, n in want.items() if n}
    assert max(sum(1 for r in out.collect() if r["doc_id"] == i) for i in range(0, 400, 50)) <= 3


def test_empty_table_and_no_words(docs):
    assert mix(docs([])).count() == 0
    assert [r["taken"] for r in mix(docs([(1, "", "en", "a"), (2, None, "en", None)])).collect()] == [0, 0]


@settings(max_examples=15, deadline=None)
@given(st.dictionaries(st.sampled_from(list("abcdefg") + ["é", "Z"]), st.integers(0, 5000), min_size=1))
def test_targets_match_repeated_sharing(shipped, sizes):
    rows = shipped.createDataFrame([("=" + s, s, n) for s, n in sizes.items()], "key string, source string, size long")
    want = plain_targets(sizes)
    for r in source_targets(rows).collect():
        assert r["target"] == pytest.approx(want[r["key"][1:]])


def test_rows_without_ids_make_no_pairs(docs):
    """Thousands of rows without an id and of one size, some of them equal, take what the plan says for them."""
    rows = [(None, f"{i // 3} two three", "en", "s" if i % 4 else "t") for i in range(6000)] + [(7, "a b c", "en", "s")] * 3000
    table = docs(rows)
    want = mix(table).groupBy("source").agg({"taken": "sum"}).collect()
    out = apply_mix(table).selectExpr("source", "size(split(text, ' ')) AS n").groupBy("source").agg({"n": "sum"}).collect()
    assert sorted(map(tuple, out)) == sorted(map(tuple, want))
