"""Streams of records into a table, each key once."""

from __future__ import annotations

from datetime import timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedup import anti_existing, first_wins
from ..operators.health import error_windows
from ..session import stage

PARTS = 64      # parts of the stored keys, by hash


def stream_dedup(records: DataFrame, key: str, ts: str, delay: str) -> DataFrame:
    """One row per key among rows that arrive within ``delay``; state older than that is dropped."""
    return records.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def stream_error_windows(calls: DataFrame, ts: str, provider: str, failed: str, delay: str) -> DataFrame:
    """Failing windows, each sent once after the watermark has passed it."""
    return error_windows(calls, ts, provider, failed, watermark=delay)


def idempotent_load(records: DataFrame, table: str, checkpoint: str, seq: str, key: str = "hash_key", ts: str | None = None,
                    delay: timedelta | None = None) -> StreamingQuery:
    """Append the first row of each key in ``seq``, exactly, over all batches and restarts.

    With ``ts`` and ``delay`` a key is remembered until the greatest event time of all batches before has passed that of its
    row by ``delay``; rows later than that are dropped. Without them it is remembered for good.

    A batch owns the partition ``(run, batch_id)`` of the table and overwrites it. The run is the query's id, which Spark
    keeps in the checkpoint folder: a new checkpoint is a new run and touches no partition of an older one. If a batch is
    run again after a failure, it is compared with all other partitions and replaces what it wrote, so nothing is doubled
    or lost. Rows lie by the hash of their key (and the day of their event time), and a batch reads the keys of its own
    hashes and of the days not yet forgotten only. The greatest event time of each batch lies under ``_marks``.
    """
    spark = records.sparkSession

    def load(batch: DataFrame, batch_id: int) -> None:
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        own = (F.col("run") == run) & (F.col("batch_id") == batch_id)
        place = f"run={run}/batch_id={batch_id}"
        fresh, forgotten = F.lit(True), F.lit(False)
        if ts is not None:
            marks = _stored(spark, f"{table}/_marks")
            latest = None if marks is None else marks.filter(~own).agg(F.max("latest")).first()[0]
            if latest is not None:
                fresh = F.col(ts).isNull() | (F.col(ts) >= F.lit(latest - delay))
                # By day only as far as whole partitions are old in every zone.
                old = F.col("day") < F.lit((latest - delay - timedelta(days=1)).date())
                forgotten = F.coalesce(old, F.lit(False)) | ~fresh
        dealt = first_wins(batch.filter(fresh), key, seq).withColumn("part", F.pmod(F.hash(key), F.lit(PARTS)))
        winners = stage(dealt if ts is None else dealt.withColumn("day", F.to_date(ts)), "arrivals")
        new, stored = winners, _stored(spark, table)
        if stored is not None:
            parts = [row[0] for row in winners.select("part").distinct().collect()]     # PARTS at most
            new = anti_existing(winners, stored.filter(~own & F.col("part").isin(parts) & ~forgotten), key)
        by = ["part"] if ts is None else ["day", "part"]
        new.repartition(*by).write.mode("overwrite").partitionBy(*by).parquet(f"{table}/{place}")
        if ts is not None:
            batch.agg(F.max(ts).alias("latest")).write.mode("overwrite").parquet(f"{table}/_marks/{place}")

    return (records.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def _stored(spark: SparkSession, table: str) -> DataFrame | None:
    """The rows of all batches; None if there is none yet."""
    try:
        return spark.read.option("basePath", table).parquet(f"{table}/run=*")
    except AnalysisException as problem:
        if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
