"""Inverted lists: recall against exact search, spread terms and lists, and what a search reads."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from signalbase.operators import search
from signalbase.session import stage_by as kept


def clustered(n, seed=2, dim=32, clusters=25):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dim))
    return [(i, (centres[rng.integers(clusters)] + 0.35 * rng.normal(size=dim)).tolist()) for i in range(n)]


def test_recall_with_few_lists(spark):
    rows = clustered(3000)
    table = spark.createDataFrame([*rows, (9000, [0.0] * 32), (9001, None)], "i int, v array<double>")
    index = search.VectorIndex.build(table, "i", "v", lists=40)
    queries = table.filter("i % 30 = 0")
    exact, near = ({(r["query"], r["item"]) for r in search.best(index.scores(queries, "i", "v", probes), 10).collect()} for probes in (None, 5))
    unit = np.array([v for _, v in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    want = {(q, int(i)) for q in range(0, 3000, 30) for i in np.argsort(-(unit @ unit[q]), kind="stable")[:10]}
    assert exact == want and len(near & exact) >= 0.9 * len(exact)


def test_a_term_in_all_texts_is_spread(spark, monkeypatch):
    rng = random.Random(1)
    texts = [(i, " ".join(["the"] * rng.randint(1, 4) + [f"w{rng.randrange(40)}" for _ in range(rng.randint(0, 30))])) for i in range(800)] + [(900, None), (901, "!")]
    table = spark.createDataFrame(texts, "i int, s string").repartition(6)
    index = search.TextIndex.build(table, "i", "s")
    assert index.hot.filter("term = 'the'").count() == 1 and index.items == 802
    assert index.postings.filter("term = 'the'").select("_salt").distinct().count() > 1
    queries = spark.createDataFrame([(1, "The w3"), (2, "W3 w3 nowhere"), (3, None)], "q int, s string")
    plan = index.scores(queries, "q", "s")._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan
    got = {(r["query"], r["item"]): float(r["score"]) for r in index.scores(queries, "q", "s").collect()}
    words = {i: (s or "").lower().replace("!", "").split() for i, s in texts}
    mean = sum(map(len, words.values())) / 802
    want = {}
    for q, asked in ((1, {"the", "w3"}), (2, {"w3", "nowhere"})):
        for term in asked:
            df = sum(term in w for w in words.values())
            for i, w in words.items():
                if term in w:
                    tf = w.count(term)
                    part = np.log(1 + (802 - df + .5) / (df + .5)) * tf * 2.2 / (tf + 1.2 * (.25 + .75 * len(w) / mean))
                    want[q, i] = want.get((q, i), 0) + part
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-6 for k in want)


def test_fusion_and_empty_indexes(spark):
    ranks = [spark.createDataFrame(r, "query int, item int, rank int") for r in ([(1, 10, 1), (1, 11, 2)], [(1, 11, 1), (1, 12, 2)])]
    assert [(r["item"], r["rank"]) for r in search.fused(ranks, 2).orderBy("rank").collect()] == [(11, 1), (10, 2)]
    none = spark.createDataFrame([], "i int, v array<double>")
    assert search.best(search.VectorIndex.build(none, "i", "v").scores(none, "i", "v"), 3).count() == 0
    texts = spark.createDataFrame([], "i int, s string")
    assert search.TextIndex.build(texts, "i", "s").scores(texts, "i", "s").count() == 0


def _asked(rows):
    return {(r["query"], r["item"], r["rank"], r["score"]) for r in rows.collect()}


def test_each_part_gives_its_own_best_vectors(spark, monkeypatch):
    """With k the same rows come out, ties and odd vectors included, and no task gives more than k of a query."""
    monkeypatch.setattr(search, "PART_ROWS", 50)
    monkeypatch.setattr(search, "PAIRS", 300)
    rows = clustered(900, dim=8, clusters=6)
    rows += [(1000 + i, rows[i % 3][1]) for i in range(60)] + [(2000, rows[0][1]), (2001, [1.0, 2.0]), (2002, [0.0] * 8), (2003, None), (None, rows[1][1])]
    table = spark.createDataFrame(rows, "i int, v array<float>")
    index = search.VectorIndex.build(table.where("size(v) = 8"), "i", "v", lists=4)
    queries = table.filter("i % 50 = 0")
    whole = search.best(index.scores(queries, "i", "v"), 7)
    few = index.scores(queries, "i", "v", k=7)
    assert _asked(search.best(few, 7)) == _asked(whole)
    parts = index.entries.select("list", "_salt").distinct().count()
    assert parts > 15 and few.count() <= 7 * parts * queries.filter("v IS NOT NULL").count() < index.scores(queries, "i", "v").count()


def test_each_shard_gives_its_own_best_texts(spark):
    """With k the same rows come out; items that come twice count as one where their length is the same, null items too."""
    rng = random.Random(3)
    texts = [(i % 700 if i % 90 else None, " ".join(["the"] * rng.randint(0, 2) + [f"w{rng.randrange(30)}" for _ in range(rng.randint(0, 9))])) for i in range(900)]
    texts += [(3000 + i, "w1 w2 w2") for i in range(80)]
    index = search.TextIndex.build(spark.createDataFrame(texts, "i int, s string").repartition(5), "i", "s")
    groups = {}
    for i, s in texts:
        groups.setdefault((i, len(s.split())), []).extend(s.split())
    assert index.items == len(groups) and abs(index.mean - sum(n for _, n in groups) / len(groups)) < 1e-12
    assert index.postings.filter("term IS NOT NULL").selectExpr("sum(n)").first()[0] == sum(len(set(w)) for w in groups.values())
    queries = spark.createDataFrame([(q, f"the w{q} w{q + 1} w2") for q in range(8)], "q int, s string")
    scored, few = index.scores(queries, "q", "s"), index.scores(queries, "q", "s", 6)
    assert _asked(search.best(few, 6)) == _asked(search.best(scored, 6))
    shards = index.postings.select("_salt").distinct().count()
    assert few.count() <= 7 * shards * 8 < scored.count()
    got = {(r["query"], r["item"]): float(r["score"]) for r in scored.filter("query = 1").collect()}
    want = {}
    for term in ("the", "w1", "w2"):
        df = sum(term in w for w in groups.values())
        for (i, n), w in groups.items():
            if term in w:
                part = np.log(1 + (len(groups) - df + .5) / (df + .5)) * w.count(term) * 2.2 / (w.count(term) + 1.2 * (.25 + .75 * n / index.mean))
                want[1, i] = want.get((1, i), 0) + part
    assert set(got) == set(want) and all(abs(got[x] - want[x]) < 1e-6 for x in want)


def test_terms_are_cut_out_of_whole_texts(spark, monkeypatch):
    """A shard gets each text as one value, not as a list of terms, and finds the terms that ``terms_of`` finds."""
    listed = []
    monkeypatch.setattr(search, "stage_by", lambda df, *a, **b: listed.append(df) or kept(df, *a, **b))
    odd = ["", " ", None, "A", "\u00c0B-c_d e\u0301f", "\u0130I \u015e\u015e \u00df \u1e9e", "x\u00a0y\u3000z\u2028w", "\u0663\u0664 \u00bd \u2167 \u00b2, \u0660", "\u6771\u4eac\u3001\u5927\u962a a\u6771", "\U0001f600a\U0001d400\U00010400b", "\ufffdq\ufffd", "\u0000n\tm\r\n", "don't, e-mail: a@b.c", "\uff41\uff22\uff11", "no-end9", "\ufeff\ufb01 \u01c5 \u02b0 \u0903"]
    texts = spark.createDataFrame([*enumerate(odd), *((100 + i, f"w{i} wörter{i % 7}é, Ω{i % 3}") for i in range(200))], "i int, s string").repartition(3)
    index = search.TextIndex.build(texts, "i", "s")
    got = {(r["term"], i, tf, n) for r in index.postings.filter("term IS NOT NULL").collect() for i, tf, n in zip(r["items"], r["tfs"], r["lengths"])}
    want = {(term, r["i"], r["t"].count(term), len(r["t"])) for r in texts.select("i", search.terms_of(search.text_of("s")).alias("t")).collect() for term in r["t"]}
    assert got == want and len(want) > 630 and index.items == len(odd) + 200
    plan = listed[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") <= 1        # texts without an item are dealt by their number of terms


def test_the_length_of_a_vector_is_worked_out_once(spark):
    """Neither the length nor the vector at length one stands inside the function over components or centroids."""
    rows = [(0, [3.0, 4.0]), (1, [0.0, 0.0]), (2, None), (3, []), (4, [float("inf"), 1.0]), (5, [float("nan")]), (6, [1.0, None])]
    table = spark.createDataFrame(rows, "i int, v array<double>").repartition(2)
    unit = search._unit(F.col("v"))
    got = table.select("i", unit.alias("u"), search._lists(unit, [[1.0, 0.0], [0.6, 0.8]], 2).alias("near")).orderBy("i")
    assert [r["u"] for r in got.collect()][:4] == [[0.6, 0.8], None, None, None] and got.first()["near"] == [1, 0]
    plan = got._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "/ sqrt(" not in plan and plan.count("sqrt(") <= 2


def test_staged_buckets_leave_the_settings(spark):
    held = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    table = kept(spark.range(1000).withColumn("k", F.col("id") % 37), ["k"], "buckets")
    assert table.count() == 1000 and spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == held
    assert len(table.inputFiles()) <= 4 and "Bucketed: true" in table.groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
