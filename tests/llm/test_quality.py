"""Quality rules against plain loops, and against the labels of the given documents."""

from __future__ import annotations

import random
import re
from collections import Counter

import oracle
from signalbase.llm import quality
from signalbase.llm.queries import ORACLES, QUERIES


def plain(text: str | None) -> dict:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(5)}
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_stop_words": sum(w.lower() in quality.STOP_WORDS for w in words), "n_lines": len(lines),
            "n_dup_lines": len(lines) - len(set(lines)), "n_bullet_lines": sum(bool(re.match(r"[ \t]*[-*•]", x)) for x in lines),
            "n_cut_lines": sum(bool(re.search(r"(\.\.\.|…)[ \t\r]*\Z", x)) for x in lines), "n_repeat_words": len(covered)}


def verdict(m: dict) -> tuple[bool, bool, list[str]]:
    def ok(r):
        left, right = 100 * m[r.measure], r.per_cent * (m[r.of] if r.of else 1)
        return left >= right - r.slack if r.bound == "at least" else left <= right + r.slack
    failed = [r.name for r in quality.BASE + quality.RULES if not ok(r)]
    base = not all(ok(r) for r in quality.BASE)
    assert base == (m["n_words"] < 10 or 100 * m["n_repeat_words"] > 20 * m["n_words"])
    return base, not failed, failed


def texts():
    rng = random.Random(6)
    out = [None, "", " \t\x0b\x0c\r\n", "one", "a b c d e", "a b c d e a b c d e", "a a a a a a", "x  y\x0bz\x0cq\rw", "é ☃ 𝄞 <b> | a",
           "- one\n* two\n • three\n- one\r\n", "the end...\nof it… \nand more...\r\n", "THE the tHe\n\n\nthe", "   x",
           " ".join(f"w{i}" for i in range(30_000)), " ".join(rng.choice("ab") for _ in range(5000))]
    vocabulary = ["the", "of", "word", "Zeile", "über", "x#y", "&&", "la"]
    for _ in range(300):
        base = [rng.choice(vocabulary if rng.random() < .5 else [f"t{rng.randrange(999)}"]) for _ in range(rng.randint(0, 60))]
        if rng.random() < .4 and len(base) > 12:
            i = rng.randrange(len(base) - 8)
            base += base[i:i + rng.randint(4, 8)]
        out.append("".join(w + rng.choice([" ", " ", "  ", "\n", "\t"]) for w in base))
    return out


def test_measures_and_verdicts_match_plain_loops(docs):
    rows = [(i, t, "en", "s") for i, t in enumerate(texts())] + [(None, "null id", "en", None), (3, "one", "en", "s"), (3, "one", "en", "s")]
    got = sorted((str(r["doc_id"]), tuple(r[n] for n in quality.MEASURES), r["base_failed"], r["kept"], tuple(r["failed"])) for r in quality.judge(docs(rows)).collect())
    want = []
    for i, text, *_ in rows:
        m = plain(text)
        base, kept, failed = verdict(m)
        want.append((str(i), tuple(m[n] for n in quality.MEASURES), base, kept, tuple(failed)))
    assert got == sorted(want)


def test_equal_hashes_of_unequal_windows_are_compared(docs, monkeypatch):
    """With a hash that puts all windows into one class, the words decide."""
    monkeypatch.setattr(quality.F, "xxhash64", lambda *c: quality.F.lit(1).cast("long"))
    rows = [(i, t, "en", "s") for i, t in enumerate(texts()) if t is None or len(t) < 2000]
    got = {r["doc_id"]: r["n_repeat_words"] for r in quality.judge(docs(rows)).collect()}
    assert got == {i: plain(t)["n_repeat_words"] for i, t, *_ in rows}


def test_own_rules_and_empty_table(docs):
    assert quality.judge(docs([])).count() == 0
    rules = (quality.Rule("long", "n_words", "at most", 300),)
    got = {r["doc_id"]: r["kept"] for r in quality.judge(docs([(1, "a b c", "en", "s"), (2, "a b c d", "en", "s")]), (), rules).collect()}
    assert got == {1: True, 2: False}


def test_one_projection(docs):
    plan = quality.judge(docs([(1, "a", "en", "s")]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") <= 2 and "Python" not in plan and "Aggregate" not in plan and "Join" not in plan


def test_labels_of_the_given_documents(shipped):
    """Documents labelled good are kept, but for base failures; of those labelled bad at least nine in ten go."""
    folder = "/root/testdata/sf0.01"
    found = quality.judge(shipped.read.parquet(f"{folder}/documents.parquet")).join(
        shipped.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    good = [r["kept"] for r in found if r["quality"] == 1 and not r["base_failed"]]
    bad = [r["kept"] for r in found if r["quality"] == 0]
    assert sum(good) >= 0.99 * len(good) > 100 and sum(bad) <= 0.1 * len(bad) and len(bad) > 20


def test_query_equals_its_twin(shipped):
    folder = "/root/testdata/sf0.001"
    columns, rows = oracle.spark_rows(QUERIES["op13_quality_rules"](shipped, folder))
    want_columns, want = oracle.duck_rows(oracle.connect(folder), ORACLES["op13_quality_rules"])
    assert columns == want_columns and rows == want and rows
