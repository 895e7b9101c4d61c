"""Streaming forms over the events table, run to the end of the available data."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamReader

from ..functions.keys import hash_key
from ..session import fresh_path
from ..streaming import loads
from .base import Tables, hash_sql, query
from .declared import CALLS_SQL, calls, shown_windows


def _events(t: Tables) -> DataFrame:
    """The events table as a stream."""
    schema = t.spark.read.parquet(f"{t.folder}/events.parquet").schema
    reader: DataStreamReader = t.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    return reader.parquet(t.folder).withColumn("ts", F.col("ts").cast("timestamp"))


def _drain(stream: DataFrame, t: Tables, mode: str = "append") -> DataFrame:
    """Run a stream over what is there and read back what it wrote."""
    out, state = fresh_path(t.spark, "stream"), fresh_path(t.spark, "stream-state")
    (stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", state)
     .trigger(availableNow=True).start(out).awaitTermination())
    return t.spark.read.schema(stream.schema).parquet(out)


@query("SELECT DISTINCT user_id % 700 AS user_key, event_type FROM events")
def stream_dedup(t: Tables):
    """Keys are equal over the whole table here, since all rows come in one batch, before any state is dropped."""
    keyed = _events(t).select(
        "ts", (F.col("user_id") % 700).alias("user_key"), "event_type",
        F.concat_ws("/", F.col("user_id") % 700, "event_type").alias("key"))
    return _drain(loads.stream_dedup(keyed, "key", "ts", "400 days"), t).select("user_key", "event_type")


@query(CALLS_SQL + """ AND x.window_start + INTERVAL '60 seconds' <=
    (SELECT max(ts) FROM events) - INTERVAL '10 minutes'""")
def stream_error_windows(t: Tables):
    """Windows that the watermark has passed at the end of the data."""
    windows = _drain(loads.stream_error_windows(calls(_events(t)), "ts", "provider", "failed", "10 minutes"), t)
    return shown_windows(windows)


@query(f"""SELECT arg_min(event_id, event_id) AS event_id, {hash_sql("event_type", "CAST(user_id AS VARCHAR)")} AS hash_key
    FROM events GROUP BY 2""")
def stream_idempotent(t: Tables):
    table, state = fresh_path(t.spark, "stream-table"), fresh_path(t.spark, "stream-state")
    keyed = _events(t).select("event_id", hash_key("event_type", "user_id").alias("hash_key"))
    loads.idempotent_load(keyed, table, state, "event_id").awaitTermination()
    return t.spark.read.schema("event_id bigint, hash_key string").parquet(table).select("event_id", "hash_key")


_BATCHES, _DAYS = 5, 3


def _arrivals_sql() -> str:
    """Batch by batch: what is late goes, and a key is compared with the kept rows that are not forgotten yet."""
    steps = [f"keyed AS (SELECT event_id, ts, event_id % {_BATCHES} AS batch, user_id % 40 || '/' || event_type AS key FROM events)"]
    for b in range(_BATCHES):
        horizon = f"(SELECT max(ts) - INTERVAL '{_DAYS} days' FROM keyed WHERE batch < {b})"
        late = f" AND ts >= {horizon}" if b else ""
        before = " UNION ALL ".join(f"SELECT key, ts FROM kept{i}" for i in range(b))
        known = f" WHERE key NOT IN (SELECT key FROM ({before}) k WHERE ts >= {horizon})" if b else ""
        steps.append(f"""kept{b} AS (SELECT * FROM (SELECT arg_min(event_id, event_id) AS event_id, arg_min(ts, event_id) AS ts, key FROM keyed
            WHERE batch = {b}{late} GROUP BY key) x{known})""")
    every = " UNION ALL ".join(f"SELECT event_id, key FROM kept{b}" for b in range(_BATCHES))
    return f"WITH {', '.join(steps)} {every}"


@query(_arrivals_sql())
def stream_first_arrivals(t: Tables):
    """Events in five batches that each span all days, with three days of memory: late rows go, first arrivals stay."""
    source, table, state = (fresh_path(t.spark, f"stream-{n}") for n in ("batches", "arrivals", "state"))
    keyed = t.events.select("event_id", "ts", F.concat_ws("/", F.col("user_id") % 40, "event_type").alias("key"))
    for b in range(_BATCHES):
        keyed.filter(F.col("event_id") % _BATCHES == b).coalesce(1).write.mode("append").parquet(source)
    stream = t.spark.readStream.schema(keyed.schema).option("maxFilesPerTrigger", 1).parquet(source)
    loads.idempotent_load(stream, table, state, "event_id", "key", "ts", timedelta(days=_DAYS)).awaitTermination()
    return t.spark.read.schema(keyed.schema).parquet(table).select("event_id", "key")
