from datetime import timedelta

from pyspark.sql import functions as F

from signalbase.operators.dedup import first_wins
from signalbase.streaming import loads


def put(spark, folder, name, rows):
    spark.createDataFrame(rows, "seq bigint, k string").coalesce(1).write.parquet(f"{folder}/{name}")


def stream(spark, folder):
    return spark.readStream.schema("seq bigint, k string").option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def test_idempotent_load_equals_batch(spark, tmp_path):
    folder, table, state = (str(tmp_path / n) for n in ("in", "table", "state"))
    put(spark, folder, "1", [(1, "a"), (2, "b"), (3, "a")])
    loads.idempotent_load(stream(spark, folder), table, state, "seq", "k").awaitTermination()
    put(spark, folder, "2", [(4, "b"), (5, "c"), (6, "c")])
    loads.idempotent_load(stream(spark, folder), table, state, "seq", "k").awaitTermination()
    whole = spark.read.parquet(f"{folder}/*")
    got = sorted((r.seq, r.k) for r in spark.read.parquet(table).collect())
    assert got == sorted((r.seq, r.k) for r in first_wins(whole, "k", "seq").collect()) == [(1, "a"), (2, "b"), (5, "c")]


def test_a_batch_run_again_changes_nothing(spark, tmp_path):
    folder, table = str(tmp_path / "in"), str(tmp_path / "table")
    put(spark, folder, "1", [(1, "a"), (2, "b")])
    for state in ("state1", "state2"):  # a lost checkpoint replays batch 0
        loads.idempotent_load(stream(spark, folder), table, str(tmp_path / state), "seq", "k").awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(table).collect()) == ["a", "b"]


def test_dedup_within_the_watermark(spark, tmp_path):
    folder = str(tmp_path / "in")
    for name, rows in {"1": [("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:01:00")],
                       "2": [("a", "2024-01-01 00:02:00"), ("b", "2024-01-01 03:00:00")],
                       "3": [("a", "2024-01-01 03:01:00")], "4": [("a", "2024-01-01 03:02:00")]}.items():
        spark.createDataFrame(rows, "k string, t string").select("k", F.to_timestamp("t").alias("t")).coalesce(
            1).write.parquet(f"{folder}/{name}")
    src = spark.readStream.schema("k string, t timestamp").option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")
    out = str(tmp_path / "out")
    (loads.stream_dedup(src, "k", "t", "10 minutes").writeStream.format("parquet").option(
        "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(out).awaitTermination())
    got = sorted((r.k, str(r.t)) for r in spark.read.parquet(out).collect())
    assert [k for k, _ in got] == ["a", "a", "b"]  # the copy within the delay is gone, the one after three hours stays


def test_memory_follows_event_time_over_batches(spark, tmp_path):
    """Five batches with an hour of memory: the first arrival stays, late rows go, a key comes again once it is forgotten."""
    folder, table = str(tmp_path / "in"), str(tmp_path / "table")
    batches = [[(1, "a", "10:00"), (2, "a", "09:55"), (3, "n", None)], [(4, "a", "10:40"), (5, "b", "12:00")],
               [(6, "late", "10:59"), (7, "b", "11:30"), (8, "c", "11:00"), (9, "n", None)], [(10, "a", "12:10"), (11, "c", "13:30")],
               [(12, "b", "13:00"), (13, "a", "12:20"), (14, "a", "12:31"), (15, "c", "13:31")]]
    for i, rows in enumerate(batches):
        (spark.createDataFrame([(s, k, t and f"2024-06-03 {t}:00") for s, k, t in rows], "seq bigint, k string, t string")
         .select("seq", "k", F.to_timestamp("t").alias("t")).coalesce(1).write.parquet(f"{folder}/{i}"))
    src = spark.readStream.schema("seq bigint, k string, t timestamp").option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")
    loads.idempotent_load(src, table, str(tmp_path / "state"), "seq", "k", "t", timedelta(hours=1)).awaitTermination()
    # Memory reaches back to 9:00, 11:00, 11:00 and 12:30 at the starts of batches 1 to 4.
    got = sorted(r.seq for r in spark.read.parquet(table).collect())
    assert got == [1, 3, 5, 8, 10, 12, 14, 15]
    assert {r.day for r in spark.read.parquet(table).select("day").distinct().collect() if r.day} and spark.read.parquet(table).filter("seq = 11").count() == 0
