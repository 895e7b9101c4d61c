"""Loads as one version, the prefilter of stored keys, and the plans that compare a batch with a large table."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from signalbase.operators import dedup, limits, prefilter
from signalbase.sinks import commits, tables

STARTUP = ("hash_key string, entity_name string, employee_count int, source_name string, source_url string, "
           "collected_at string, raw_payload string, ingest_seq bigint")
LOG = "raw_name string, canonical_name string, method string, confidence double, resolved_at timestamp, ingest_seq bigint"


def startups(spark, *keys, first=0):
    return spark.createDataFrame([(k, f"name {k}", 1, "s", f"u{k}", "t", "p", first + i) for i, k in enumerate(keys)], STARTUP)


def log(spark, *names):
    return spark.createDataFrame([(n, n.upper(), "RULE", 0.8, None, i) for i, n in enumerate(names)], LOG)


def keys_of(spark, root):
    return [(r.id, r.hash_key) for r in tables.read_table(spark, root, "startups").orderBy("id").collect()]


def test_repeated_loads_keep_first_rows_and_go_on_numbering(spark, tmp_path):
    root = str(tmp_path / "t")
    tables.append_new(spark, root, "startups", startups(spark, "b", "a", "b", "c"))
    tables.append_new(spark, root, "startups", startups(spark, "c", "d", "a"))
    tables.append_new(spark, root, "startups", startups(spark, "a"))
    assert keys_of(spark, root) == [(1, "b"), (2, "a"), (3, "c"), (4, "d")]
    assert commits.versions(spark, root) == [0, 1, 2, 3]


def test_a_run_killed_between_tables_leaves_the_old_state(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    tables.load_tables(spark, root, {"startups": startups(spark, "a")}, [log(spark, "x")])
    before = commits.read(spark, root)
    monkeypatch.setattr(tables, "_load_log", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):
        tables.load_tables(spark, root, {"startups": startups(spark, "b", "c")}, [log(spark, "y")])
    assert commits.read(spark, root) == before and keys_of(spark, root) == [(1, "a")]
    monkeypatch.undo()
    tables.load_tables(spark, root, {"startups": startups(spark, "b", "c")}, [log(spark, "y")])
    assert keys_of(spark, root) == [(1, "a"), (2, "b"), (3, "c")]
    assert sorted((r.id, r.raw_name) for r in tables.read_table(spark, root, tables.LOG).collect()) == [(1, "x"), (2, "y")]


def test_of_two_writers_the_second_decides_again(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    tables.append_new(spark, root, "startups", startups(spark, "a"))
    real, rivals = commits.publish, []

    def publish(spark_, root_, version, manifest):
        if not rivals:
            rivals.append(1)
            tables.load_tables(spark, root, {"startups": startups(spark, "c", "rival")}, [log(spark, "r")])
        return real(spark_, root_, version, manifest)

    monkeypatch.setattr(commits, "publish", publish)
    tables.load_tables(spark, root, {"startups": startups(spark, "b", "c", "d")}, [log(spark, "one", "two")])
    assert keys_of(spark, root) == [(1, "a"), (2, "c"), (3, "rival"), (4, "b"), (5, "d")]
    assert sorted((r.id, r.raw_name) for r in tables.read_table(spark, root, tables.LOG).collect()) == [(1, "r"), (2, "one"), (3, "two")]


def test_publishing_is_exclusive(spark, tmp_path):
    root = str(tmp_path)
    assert commits.read(spark, root) is None
    assert commits.publish(spark, root, 0, {"a": 1}) and not commits.publish(spark, root, 0, {"a": 2})
    assert commits.read(spark, root) == {"a": 1, "version": 0}


def test_a_named_run_is_loaded_once(spark, tmp_path):
    root = str(tmp_path / "t")
    for _ in range(2):
        state = tables.load_tables(spark, root, {"startups": startups(spark, "a")}, [log(spark, "x")], run_id="monday")
    assert state["version"] == 1 and tables.read_table(spark, root, tables.LOG).count() == 1
    tables.load_tables(spark, root, {}, [log(spark, "x")], run_id="tuesday")
    assert tables.read_table(spark, root, tables.LOG).count() == 2
    assert tables.read_table(spark, root, tables.LOG, state).count() == 1       # an older version stays readable


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_keys_are_not_moved(spark, tmp_path, monkeypatch):
    """Neither with few doubtful keys, where only their buckets are read, nor with many, where buckets are joined as they lie."""
    root = str(tmp_path / "t")
    many = spark.range(4000).select(F.sha2(F.col("id").cast("string"), 256).alias("hash_key"), F.lit("n").alias("entity_name"),
                                    F.lit(1).alias("employee_count"), F.lit("s").alias("source_name"), F.lit("u").alias("source_url"),
                                    F.lit("t").alias("collected_at"), F.lit("p").alias("raw_payload"), F.col("id").alias("ingest_seq"))
    tables.append_new(spark, root, "startups", many)
    state = tables.current(spark, root)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = tables.new_keys(spark, root, "startups", many.where("id < 1"), state, "ingest_seq")
        assert "SelectedBucketsCount: 1 out of 4" in _plan(few).replace("\n", "") and few.count() == 0
        monkeypatch.setattr(tables, "FEW_KEYS", 10)
        plan = _plan(tables.new_keys(spark, root, "startups", many, state, "ingest_seq"))
        stored = plan[plan.index("LeftAnti"):]
        scans = [part for part in stored.split("Scan parquet") if "startups" in part.split("\n")[0]]
        assert scans and "Bucketed: true" in scans[0]
        lines = stored.split("\n")
        at = next(i for i, line in enumerate(lines) if "Scan parquet" in line and "startups" in line)
        depth = lines[at].index("+-") if "+-" in lines[at] else lines[at].index("FileScan")
        above = [line for line in lines[:at] if "Exchange" in line]
        assert len(above) <= 1, stored      # the batch's own side
        assert tables.new_keys(spark, root, "startups", many, state, "ingest_seq").count() == 0 and depth
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_prefilter_forgets_no_key_and_rarely_doubts_a_new_one(spark):
    keys = spark.range(30_000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"))
    segments = prefilter.segments_for(15_000)       # full: 30,000 keys in segments meant for that many
    built = prefilter.merge(prefilter.build(keys.where("k < '8'"), "k", segments), prefilter.build(keys.where("k >= '8'"), "k", segments))
    whole = prefilter.build(keys, "k", segments)
    assert built.exceptAll(whole).count() == whole.exceptAll(built).count() == 0
    assert prefilter.with_maybe(keys, "k", built, segments).where("maybe_stored").count() == 30_000
    fresh = spark.range(1_000_000).select(F.sha2(F.concat(F.lit("new"), "id"), 256).alias("k"))
    assert prefilter.with_maybe(fresh, "k", built, segments).where("maybe_stored").count() <= 10      # 0.001 %
    none = prefilter.build(keys.limit(0), "k", 1)
    assert none.count() == 1 and prefilter.with_maybe(keys.limit(5), "k", none, 1).where("maybe_stored").count() == 0


def test_filter_grows_with_the_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(prefilter, "KEYS", 4)
    root = str(tmp_path / "t")
    for part in range(3):
        tables.append_new(spark, root, "startups", startups(spark, *[f"{part}-{i}" for i in range(20)], "0-3"))
    entry = tables.current(spark, root)["tables"]["startups"]
    assert entry["rows"] == 60 and entry["segments"] >= 16
    assert [k for _, k in keys_of(spark, root)].count("0-3") == 1


def test_ids_are_dense_over_a_million_blocks(spark):
    """Arrival numbers as far apart as byte places in a large dump: a million of them, a million apart."""
    rows = spark.range(1_000_000).select((F.col("id") * 1_000_003 % 1_000_000 * 1_000_000).alias("seq"))
    numbered = dedup.assign_ids(rows, "seq", 7)
    assert "Window" not in _plan(numbered)
    got = numbered.agg(F.count("*"), F.count_distinct("id"), F.min("id"), F.max("id"),
                       F.sum(F.when(F.col("id") != F.col("seq") / 1_000_000 + 8, 1).otherwise(0))).first()
    assert tuple(got) == (1_000_000, 1_000_000, 8, 1_000_007, 0)


def test_large_and_small_targets_take_the_same_rows(spark, monkeypatch):
    rows = spark.range(5000).select((F.col("id") * 37 % 5000).alias("seq"), (F.col("id") % 11).alias("at"))
    small = [limits.cap_rows(rows, "seq", 700), limits.backfill(rows.limit(40), rows, "seq", 700), limits.newest_n(rows, "at", "seq", 700)]
    want = [sorted(map(tuple, d.collect())) for d in small]
    monkeypatch.setattr(limits, "SORTED_ROWS", 10)
    large = [limits.cap_rows(rows, "seq", 700), limits.backfill(rows.limit(40), rows, "seq", 700), limits.newest_n(rows, "at", "seq", 700)]
    assert [sorted(map(tuple, d.select(s.columns).collect())) for d, s in zip(large, small)] == want


def test_staged_tables_go_at_the_end(tmp_path, spark):
    from signalbase import session
    from signalbase.operators.resolve import Catalogue

    kept = session._written.pop(spark.sparkContext.applicationId, [])       # those of other tests
    try:
        staged = session.stage(spark.range(5).toDF("k"), "x"), session.stage_by(spark.range(5).toDF("k"), ["k"], "y")
        catalogue = Catalogue.built_in(spark)
        places = [d.inputFiles()[0].removeprefix("file:").removeprefix("//").rsplit("/", 1)[0] for d in (*staged, catalogue.frame)]
        assert all(os.path.exists(p) for p in places)
        session.drop_stages(spark)
        assert not any(os.path.exists(p) for p in places)
        assert Catalogue.built_in(spark).frame.count() > 100
    finally:
        session._written.setdefault(spark.sparkContext.applicationId, []).extend(kept)


def test_a_load_moves_no_key_and_finishes_rows_in_their_buckets(spark, tmp_path, monkeypatch):
    """Rows with columns of their own become table rows after the last shuffle; repeated and null keys and arrival numbers as before."""
    root, plans, numbered = str(tmp_path / "t"), [], tables.assign_ids
    monkeypatch.setattr(tables, "assign_ids", lambda df, *a, **b: plans.append(_plan(df)) or numbered(df, *a, **b))
    written, append = [], tables._append
    monkeypatch.setattr(tables, "_append", lambda s, r, n, rows, *a: written.append(_plan(rows)) or append(s, r, n, rows, *a))

    def finish(rows, keep):
        return rows.select(F.lower("name").alias("hash_key"), F.col("name").alias("entity_name"), F.lit(1).alias("employee_count"),
                           F.lit("s").alias("source_name"), F.concat(F.lit("u"), "name").alias("source_url"), F.lit("t").alias("collected_at"),
                           F.repeat("name", 50).alias("raw_payload"), *keep)

    batch = spark.createDataFrame([("B", 5), ("a", 3), ("b", 2), ("A", 9), ("c", 4), ("d", 4), ("a", 3)], "name string, ingest_seq bigint")
    for _ in range(2):
        tables.load_tables(spark, root, {"startups": batch}, finish={"startups": finish})
    got = [(r.hash_key, r.entity_name, r.raw_payload) for r in tables.read_table(spark, root, "startups").orderBy("id").collect()]
    assert sorted(got) == sorted((k, k, k * 50) for k in ("b", "a", "a", "c", "d"))
    assert got[0][0] == "b" and got[1][0] == got[2][0] == "a"       # both rows of one key and arrival number stay
    assert "md5" in plans[0] and "repeat(" in written[0] and written[0].count("- Exchange ") == 1
    assert "repeat(" not in written[0][written[0].index("Exchange"):]


def test_a_filter_is_built_with_one_shuffle_of_the_keys(spark):
    keys = spark.range(500).select(F.col("id").cast("string").alias("k"))
    assert _plan(prefilter.build(keys, "k", 8)).count("Exchange") == 1
    assert prefilter.build(keys, "k", 8).where("size(words) = 512").count() == 8
