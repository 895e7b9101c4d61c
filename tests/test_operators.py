import json
from decimal import Decimal

from pyspark.sql import functions as F

from signalbase.operators import dedup, domains, extraction, graph, health, limits, lookups, records, retrieve, skew
from signalbase.operators.validate import validate


def test_first_wins_under_a_hot_key(spark):
    df = spark.range(9000).withColumn("k", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")))
    shuffled = df.orderBy(F.desc("id"))
    out = dedup.first_wins(shuffled, "k", "id")
    assert out.count() == 6001 and out.filter("k = 'hot'").first()["id"] == 0


def test_first_wins_drops_losers_before_the_shuffle(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 7)
    plan = dedup.first_wins(df, "k", "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Partial") > plan.index("Exchange")  # printed top down: the partial limit is below


def test_ids_follow_order_however_far_apart(spark):
    df = spark.createDataFrame([(n,) for n in [95, 3, 1 << 58, 11, 12, 4, (1 << 58) + 25]], "seq bigint")
    out = dedup.assign_ids(df, "seq", 100).orderBy("id").collect()
    assert [r["id"] for r in out] == list(range(101, 108))
    assert [r["seq"] for r in out] == sorted(r["seq"] for r in out)


def test_insert_or_ignore(spark):
    batch = spark.createDataFrame([("a", 5), ("b", 2), ("a", 1), ("c", 3)], "hash_key string, seq bigint")
    stored = spark.createDataFrame([("b",)], "hash_key string")
    rows = dedup.insert_or_ignore(batch, stored, "seq", start=7).orderBy("id").collect()
    assert [(r["hash_key"], r["seq"], r["id"]) for r in rows] == [("a", 1, 8), ("c", 3, 9)]


def test_salted_join_equals_plain_join(spark):
    facts = spark.range(5000).withColumn("k", F.when(F.col("id") % 3 == 0, "hot").when(
        F.col("id") % 100 == 1, None).otherwise((F.col("id") % 50).cast("string"))).repartition(4)
    lookup = spark.createDataFrame([("hot", 1), ("7", 2), ("nowhere", 3)], "k string, v int")
    for how in ("left", "inner"):
        got = skew.salted_join(facts, lookup, "k", how).select("id", "k", "v").collect()
        want = facts.join(lookup, "k", how).select("id", "k", "v").collect()
        assert sorted(got, key=str) == sorted(want, key=str)
    hot = [r["k"] for r in skew.frequent_keys(facts, "k").collect()]
    assert "hot" in hot and len(hot) <= skew.HOT_KEYS


def test_salts_spread_a_hot_key(spark):
    facts = spark.range(0, 8000, 1, 8).withColumn("k", F.lit("hot"))
    lookup = spark.createDataFrame([("hot", 1)], "k string, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = skew.salted_join(facts, lookup, "k")
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert joined.count() == 8000 and len(sizes) > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_limits(spark):
    a, b = spark.range(3).withColumnRenamed("id", "seq"), spark.range(5).withColumnRenamed("id", "seq")
    assert [r["seq"] for r in limits.cap_rows(b, "seq", 2).collect()] == [0, 1]
    assert limits.cap_rows(b, "seq", None).count() == 5
    assert sorted((r["source_no"], r["seq"]) for r in limits.backfill(a, b, "seq", 4).collect()) == [
        (0, 0), (0, 1), (0, 2), (1, 0)]
    assert limits.backfill(a, b, "seq", None).count() == 8


def test_targets_cut_the_same_by_numbers(spark, monkeypatch):
    monkeypatch.setattr(limits, "SORTED_ROWS", 7)
    a, b = list(range(0, 300, 3)), list(range(0, 900, 9))
    one, two = (spark.createDataFrame([(x,) for x in rows], "seq long") for rows in (a, b))
    for n in (1, 50, 150, 400):
        assert sorted(r["seq"] for r in limits.cap_rows(one, "seq", n).collect()) == a[:n]
        want = ([(0, x) for x in a] + [(1, x) for x in b])[:n]
        assert sorted((r["source_no"], r["seq"]) for r in limits.backfill(one, two, "seq", n).collect()) == want


def test_paper_stars(spark):
    papers = spark.createDataFrame(
        [(1, "see http://www.github.com/o/r.git."), (2, "https://github.com/x/y"), (3, "none"), (4, None)],
        "n int, summary string")
    stats = spark.createDataFrame([("o", "r", 5), ("o", "r", 4)], "owner string, repo string, stars int")
    got = {r["n"]: (r["github_url"], r["github_stars"]) for r in lookups.paper_stars(papers, stats).collect()}
    assert got == {1: ("https://github.com/o/r.git", 5), 2: ("https://github.com/x/y", 0), 3: (None, 0), 4: (None, 0)}


def test_news_body(spark):
    entries = spark.createDataFrame(
        [(1, "u", "s"), (2, "v", "s"), (3, "w", None), (4, "", "t")], "n int, link string, summary string")
    bodies = spark.createDataFrame([("u", "text"), ("v", "")], "url string, body string")
    got = {r["n"]: r["full_text"] for r in lookups.news_body(entries, bodies).collect()}
    assert got == {1: "text", 2: "s", 3: "", 4: "t"}


def test_records_of_each_kind(spark):
    startup = spark.createDataFrame(
        [("Stripe", 7000, "YC", "https://x/stripe", "2024-01-01T00:00:00+00:00")],
        "entity_name string, employee_count int, source_name string, source_url string, collected_at string")
    nested = records.to_record(startup, "startups").first()
    assert (nested.recordType, nested.schemaVersion) == ("STARTUP", "1.0")
    assert nested.content.entityName == "Stripe" and nested.content.data.employeeCount == 7000
    flat = records.flatten(records.to_record(startup, "startups"), "startups").first()
    assert json.loads(flat.raw_payload) == {
        "schemaVersion": "1.0", "recordType": "STARTUP", "source": {"name": "YC", "url": "https://x/stripe"},
        "content": {"entityName": "Stripe", "data": {"employeeCount": 7000}},
        "collectedAt": "2024-01-01T00:00:00+00:00"}
    paper = spark.createDataFrame(
        [("T", ["A", "B"], "u", None, 0, "2017-06-12T00:00:00Z")], "title string, authors array<string>, "
        "paper_url string, github_url string, github_stars int, published_date string")
    row = records.flatten(records.to_record(paper, "research_papers"), "research_papers").first()
    assert json.loads(row.authors) == ["A", "B"] and row.github_url is None
    assert json.loads(row.raw_payload)["content"]["github_url"] is None


def test_validation(spark):
    product = spark.createDataFrame(
        [("A", "PAID"), ("B", "TRIAL"), (None, None)], "startup_name string, pricing_model string").select(
        "*", F.lit("s").alias("source_name"), F.lit("u").alias("source_url"), F.lit("t").alias("collected_at"))
    good, bad = validate(records.to_record(product, "products"), "products")
    assert [r.content.pricingModel for r in good.collect()] == ["PAID"]
    assert sorted(tuple(r.reasons) for r in bad.collect()) == [
        ("missing content.startupName", "missing content.pricingModel"), ("unknown content.pricingModel",)]


def test_first_valid_tier(spark):
    docs = spark.createDataFrame([(1,), (2,), (3,)], "doc_id bigint")
    responses = spark.createDataFrame(
        [(1, 1, 429, '{"a": 0}'), (1, 2, 200, '{"a": 2}'), (1, 3, 200, '{"a": 3}'), (2, 1, 200, '{"a": '),
         (2, 2, 500, "{}")], "doc_id bigint, tier int, status int, body string")
    good, bad = extraction.first_valid_tier(docs, responses, "a int")
    assert [(r.doc_id, r.tier, r.result.a) for r in good.collect()] == [(1, 2, 2)]
    assert sorted(r.doc_id for r in bad.collect()) == [2, 3]


def test_dead_letters_and_windows(spark):
    tries = spark.createDataFrame(
        [("a", True)] * 4 + [("b", True)] * 3 + [("c", True)] * 5 + [("c", False)], "item string, failed boolean")
    assert [(r.item, r.attempts) for r in health.dead_letters(tries, "item", "failed").collect()] == [("a", 4)]
    calls = spark.createDataFrame(
        [("2024-01-01 00:00:%02d" % i, "p", i < 3) for i in range(10)]
        + [("2024-01-01 00:01:%02d" % i, "p", i < 2) for i in range(10)], "t string, p string, failed boolean")
    out = health.error_windows(calls.withColumn("t", F.to_timestamp("t")), "t", "p", "failed").collect()
    assert [(r.calls, r.errors) for r in out] == [(10, 3)]  # exactly 20 % does not count


def test_reach_takes_least_hops(spark):
    edges = spark.createDataFrame(
        [("a", "b"), ("b", "c"), ("a", "c"), ("c", "d"), ("d", "e"), ("a", "b")], "src string, dst string")
    seeds = spark.createDataFrame([("x", "a"), ("y", "c")], "label string, node string")
    got = {(r.label, r.node): r.hop for r in graph.reach(edges, seeds, 2).collect()}
    assert got == {("x", "a"): 0, ("x", "b"): 1, ("x", "c"): 1, ("x", "d"): 2,
                   ("y", "c"): 0, ("y", "d"): 1, ("y", "e"): 2}


def test_reach_by_relation(spark):
    edges = spark.createDataFrame(
        [("a", "MAKES", "p"), ("b", "MAKES", "p"), ("b", "HIRES", "j"), ("p", "HIRES", "k")], "src string, rel string, dst string")
    seeds = spark.createDataFrame([("x", "a")], "label string, node string")
    got = {r.node: r.hop for r in graph.reach(edges, seeds, 3, ["MAKES", "^MAKES", "HIRES"]).collect()}
    assert got == {"a": 0, "p": 1, "b": 2, "j": 3}


def test_ids_from_wide_numbers(spark):
    df = spark.range(50).select((F.col("id") * 7).alias("seq"), (F.col("id") % 2).alias("part"))
    assert [(r.seq, r.id) for r in dedup.assign_ids(df, "seq", 5).orderBy("seq").collect()] == [(7 * i, i + 6) for i in range(50)]
    wide = df.withColumn("seq", (F.col("seq") + F.lit(Decimal(3 * 10**30))).cast("decimal(38,0)"))
    got = [(r.part, int(r.seq) - 3 * 10**30, r.id) for r in dedup.assign_ids(wide, "seq", 0, ("part",)).orderBy("part", "seq").collect()]
    assert got == [(i % 2, 7 * i, n + 1) for n, i in enumerate([*range(0, 50, 2), *range(1, 50, 2)])]


def test_retrieval(spark):
    df = spark.createDataFrame(
        [(1, [1.0, 0.0], "apple pie"), (2, [0.0, 1.0], "pear"), (3, [1.0, 1.0], "apple"), (4, [0.0, 0.0], None)],
        "id int, v array<float>, t string")
    assert [r.id for r in retrieve.vector_topk(df, "v", "id", [2.0, 0.0], 2).collect()] == [1, 3]
    top = retrieve.hybrid_topk(df, "v", "t", "id", [0.0, 1.0], ["apple", "pie"], 4).collect()
    assert [(r.id, r.score) for r in top] == [(3, 0.603553), (1, 0.5), (2, 0.5), (4, 0.0)]


def test_domains(spark):
    df = spark.range(1000).withColumn("url", F.when(F.col("id") % 3 == 0, "https://big.example/").otherwise(
        F.concat(F.lit("https://h"), F.col("id") % 9, F.lit(".example/x"))))
    buckets = domains.domain_buckets(df, "url").agg(F.sum("urls"), F.sum("hosts")).first()
    assert tuple(buckets) == (1000, 7)
    spread = domains.partition_by_domain(df, "url", 8, "id", slice_rows=50)
    big = spread.filter("url like '%big%'").groupBy(F.spark_partition_id()).count()
    assert spread.count() == 1000 and big.count() > 1


def test_page_bodies_take_the_first_wanted_page(spark):
    long = "a paragraph of more than thirty characters"
    pages = spark.createDataFrame([(2, "u", f"<p>{long} two</p>"), (1, "u", f"<p>{long} one</p>"), (3, "v", "<p>x</p>")],
                                  "n int, url string, html string")
    wanted = spark.createDataFrame([("u",), ("u",), (None,)], "link string")
    assert [tuple(r) for r in lookups.page_bodies(pages, "n", wanted).collect()] == [("u", f"{long} one")]
    assert lookups.page_bodies(pages, "n").count() == 2


def test_reach_moves_the_edges_once(spark):
    """Each relation's edges are shuffled when they are written, by source node, and in no hop after that; a hub is spread."""
    edges = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "hub").otherwise(F.concat(F.lit("n"), F.col("id") % 500)).alias("src"),
        F.lit("R").alias("rel"), F.concat(F.lit("n"), F.col("id") % 700).alias("dst"))
    seeds = spark.createDataFrame([("x", "n1"), ("y", "hub")], "label string, node string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        placed = graph.by_source(edges.select("src", "dst"))
        step = graph.one_hop(placed, seeds, 1)
        plan = step._jdf.queryExecution().executedPlan().toString()
        scan = plan[:plan.index("Bucketed: true")].rsplit("Scan parquet", 1)[0]
        assert plan.count("Bucketed: true") == 1 and sum("Exchange" in line for line in scan.split("\n")[:6]) <= 1
        got = {(r.label, r.node): r.hop for r in graph.reach(edges, seeds, 3).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    near = {}
    for r in edges.collect():
        near.setdefault(r.src, set()).add(r.dst)
    want = {}
    for label, node in [("x", "n1"), ("y", "hub")]:
        front = {node}
        for hop in range(4):
            for n in front:
                want.setdefault((label, n), hop)
            front = set().union(*[near.get(n, set()) for n in front])
    assert got == want
