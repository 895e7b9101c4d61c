from __future__ import annotations

import random

import pytest

import corpus_pipeline
from signalbase.llm.secrets import base_spans
from signalbase.llm.simhash import fingerprint
from signalbase.session import stage
from test_language_quotes import speak


@pytest.fixture
def rows():
    rng = random.Random(11)
    made = [(i, speak(rng, tag, rng.randint(20, 200)), tag, f"src{i % 4}") for i in range(120) for tag in [rng.choice(["en", "de", "fr", "es"])]]
    made += [(200 + i, made[i][1], made[i][2], "src1") for i in range(10)]                       # copies
    made += [(300, made[20][1] + " password=abc123xyz9", made[20][2], "src2"), (301, None, "en", "src0"), (302, "", "en", None),
             (303, speak(rng, "en", 20_000), "en", "src0"), (None, speak(rng, "fr", 60), "fr", "src3"), made[5]]
    return made


def test_stages(shipped, docs, rows):
    """Each stage on its own input: what goes, what stays, and which columns come out."""
    table = docs(rows)
    found = {}
    for name, function in corpus_pipeline.STAGES:
        before = [r.asDict() for r in table.collect()]
        out = stage(function(shipped, table, ""), "tested")
        if name != "packing":
            assert sorted(out.columns) == sorted(table.columns)
        found[name] = before, [r.asDict() for r in out.collect()]
        table = out

    before, after = found["language ID"]
    assert {r["doc_id"] for r in before} - {r["doc_id"] for r in after} == {301, 302}
    before, after = found["SimHash near-dedup"]
    marks = [fingerprint(r["text"]) for r in after]
    assert all((a ^ b).bit_count() > 3 for i, a in enumerate(marks) for b in marks[:i])
    assert all(any((fingerprint(r["text"]) ^ b).bit_count() <= 3 for b in marks) for r in before)
    assert {r["doc_id"] for r in after} >= set(range(120)) | {None} and not {r["doc_id"] for r in after} & set(range(200, 210))
    before, after = found["secret scans"]
    assert len(before) == len(after) and not any(base_spans(r["text"]) for r in after)
    assert sum("[secret]" in r["text"] for r in after) == sum(bool(base_spans(r["text"])) for r in before)
    before, after = found["mixing to target weights"]
    assert {r["doc_id"] for r in after} <= {r["doc_id"] for r in before}
    before, after = found["packing"]
    assert sum(p["length"] for p in after) >= sum(len(r["text"].split()) for r in before)


def test_empty_documents(shipped, docs):
    table = docs([])
    for _, function in corpus_pipeline.STAGES:
        table = stage(function(shipped, table, ""), "tested")
    assert table.count() == 0


def test_run_over_given_documents(shipped):
    out = corpus_pipeline.run(shipped, "/root/testdata/sf0.001")
    assert out.count() > 100
