"""The six stored tables under one folder, loaded and published together.

A load writes its rows to ``<table>/load=<id>``, in files bucketed by ``hash_key``, and a Bloom filter of the table's keys next
to them; one manifest then lists the loads and filters of all tables. Until it is published nothing of a load is visible,
so a run that dies half-way leaves the old state, and of two runs at once the second decides again on what the first has added.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .. import schemas
from ..operators import prefilter
from ..operators.dedup import anti_existing, assign_ids, first_places
from ..session import at_once, stage
from . import commits

KEY = "hash_key"
LOG = "entity_mapping_logs"
TRIES = 20
Finish = Callable[[DataFrame, tuple[str, ...]], DataFrame]
FEW_KEYS = 10_000   # doubtful keys up to here are looked for by value, in their buckets only; more are joined bucket by bucket


def _new_state(spark: SparkSession) -> dict:
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return {"id": uuid.uuid4().hex, "buckets": buckets, "runs": [],
            "tables": {name: {"loads": [], "rows": 0, "filter": None, "segments": 0} for name in schemas.TABLES}}


def current(spark: SparkSession, root: str) -> dict:
    state = commits.read(spark, root.rstrip("/"))
    if state is None:
        raise ValueError(f"no tables under {root}")
    return state


def ensure_tables(spark: SparkSession, root: str) -> None:
    """Publish the first version, with six empty tables, where there is none; leaves existing tables as they are."""
    root = root.rstrip("/")
    if not commits.versions(spark, root):
        commits.publish(spark, root, 0, _new_state(spark))


def table_exists(spark: SparkSession, root: str, name: str) -> bool:
    state = commits.read(spark, root.rstrip("/"))
    return state is not None and name in state["tables"]


def column_names(name: str) -> list[str]:
    return [field.split(" ")[0] for field in schemas.TABLES[name].split(", ")]


def _attached(spark: SparkSession, root: str, name: str, state: dict, loads: Sequence[str]) -> str:
    """The session's name for the files of a table, with at least ``loads`` as partitions.

    The catalogue entry is what tells Spark that the files are bucketed; which of them count is up to the manifest.
    """
    table = f"signalbase_{hashlib.md5(root.encode()).hexdigest()[:8]}_{state['id'][:8]}_{name}"
    if not spark.catalog.tableExists(table):
        buckets = f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {state['buckets']} BUCKETS" if name != LOG else ""
        spark.sql(f"CREATE TABLE {table} ({schemas.TABLES[name]}, load string) USING parquet OPTIONS (compression 'zstd') PARTITIONED BY (load) {buckets} "
                  f"LOCATION '{root}/{name}'")
    known = {row[0].removeprefix("load=") for row in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    missing = " ".join(f"PARTITION (load='{load}')" for load in loads if load not in known)
    if missing:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {missing}")
    return table


def read_table(spark: SparkSession, root: str, name: str, state: dict | None = None) -> DataFrame:
    """The rows of a table as of the newest version, or of the manifest ``state``."""
    root = root.rstrip("/")
    state = state or current(spark, root)
    loads = state["tables"][name]["loads"]
    rows = spark.table(_attached(spark, root, name, state, loads))
    return rows.where(F.col("load").isin(loads)).select(column_names(name))


def new_keys(spark: SparkSession, root: str, name: str, batch: DataFrame, state: dict, seq: str) -> DataFrame:
    """(hash_key, seq) of the batch's rows to append: first of each key, none that is stored.

    Keys that the filter has never seen are new without a look at the table. The others are compared with the stored keys: a
    few by value, which reads the buckets that can hold them; many by a join on the buckets as they lie, which moves no
    stored key.
    """
    firsts, entry = first_places(batch, seq, KEY), state["tables"][name]
    if not entry["filter"]:
        return firsts
    probed = stage(prefilter.with_maybe(firsts, KEY, spark.read.parquet(entry["filter"]), entry["segments"]), "probed")
    doubtful = probed.where("maybe_stored").drop("maybe_stored")
    stored = read_table(spark, root, name, state).select(KEY)
    few = [row[0] for row in doubtful.select(KEY).limit(FEW_KEYS + 1).collect()]
    if len(few) <= FEW_KEYS:
        stored = stored.where(F.col(KEY).isin(few))
    return probed.where("NOT maybe_stored").drop("maybe_stored").unionByName(anti_existing(doubtful, stored, KEY))


def _append(spark: SparkSession, root: str, name: str, rows: DataFrame, state: dict, load: str) -> None:
    """Write rows, dealt by their buckets unless they are log rows, as one load that no manifest lists yet."""
    table = _attached(spark, root, name, state, ())
    rows.select(*column_names(name), F.lit(load).alias("load")).write.insertInto(table)


def _filter_with(spark: SparkSession, root: str, name: str, state: dict, entry: dict, load: str) -> dict:
    """The table's filter with the keys of ``load`` added, written anew; with more segments once the present ones are full."""
    path = f"{root}/{name}_keys/{load}"
    full = not entry["filter"] or entry["rows"] > entry["segments"] * prefilter.KEYS
    loads = entry["loads"] if full else [load]
    keys = read_table(spark, root, name, {**state, "tables": {name: {**entry, "loads": loads}}}).select(KEY)
    segments = prefilter.segments_for(entry["rows"]) if full else entry["segments"]
    built = prefilter.build(keys, KEY, segments)
    (built if full else prefilter.merge(spark.read.parquet(entry["filter"]), built)).write.parquet(path)
    return {"filter": path, "segments": segments}


def _digest(key: Column) -> Column:
    return F.unhex(F.md5(key))


def _load_new(spark: SparkSession, root: str, name: str, batch: DataFrame, finish: Finish | None, state: dict, load: str, seq: str) -> dict:
    """Append the new rows of one table; its entry for the next manifest.

    Keys are compared by 128 bits of theirs, and a row is found again by its arrival number and 64 bits of its key, so a key
    travels with neither. Rows travel once, as they come; they meet their numbers and are finished in their buckets.
    """
    entry = state["tables"][name]
    finish = finish or (lambda rows, keep: rows.select(*dict.fromkeys([*(c for c in column_names(name) if c in rows.columns), *keep])))
    flat = finish(batch.withColumn("_row", F.struct(*batch.columns)), (seq, "_row"))
    mark = F.when(F.col(KEY).isNotNull(), F.xxhash64(_digest(F.col(KEY)))).alias("_mark")
    bucket = F.pmod(F.hash(KEY), F.lit(state["buckets"])).alias("_bucket")
    if entry["filter"]:
        firsts = new_keys(spark, root, name, flat.select(KEY, seq), state, seq).select(bucket, mark, seq)
    else:
        grouped = flat.groupBy(_digest(F.col(KEY)).alias("_digest"), bucket).agg(F.min(seq).alias(seq))
        firsts = grouped.select("_bucket", F.when(F.col("_digest").isNotNull(), F.xxhash64("_digest")).alias("_mark"), seq)
    ids = assign_ids(firsts, seq, entry["rows"])
    count = ids.count()
    if not count:
        return entry
    met = flat.select(bucket, mark, seq, "_row").unionByName(ids, allowMissingColumns=True).where(F.col("_mark").isNotNull() & F.col(seq).isNotNull())
    one = Window.partitionBy("_bucket", "_mark", seq)       # a number and the rows it is for
    numbered = met.repartitionById(state["buckets"], "_bucket").withColumn("id", F.max("id").over(one))
    rows = numbered.where("id IS NOT NULL AND _row IS NOT NULL").select("_row.*", "id")
    _append(spark, root, name, finish(rows, (seq, "id")), state, load)
    entry = {**entry, "loads": [*entry["loads"], load], "rows": entry["rows"] + count}
    return entry | _filter_with(spark, root, name, state, entry, load)


def _load_log(spark: SparkSession, root: str, logs: Sequence[DataFrame], state: dict, load: str, seq: str) -> dict:
    """Append resolution log rows, one frame after the other; nothing is deduplicated."""
    entry = state["tables"][LOG]
    rows = logs[0].withColumn("_part", F.lit(0))
    for i, more in enumerate(logs[1:], 1):
        rows = rows.unionByName(more.withColumn("_part", F.lit(i)))
    placed = assign_ids(rows, seq, entry["rows"], lead=("_part",))
    count = placed.count()
    if not count:
        return entry
    _append(spark, root, LOG, placed, state, load)
    return {**entry, "loads": [*entry["loads"], load], "rows": entry["rows"] + count}


def load_tables(spark: SparkSession, root: str, batches: dict[str, DataFrame], logs: Sequence[DataFrame] = (),
                seq: str = "ingest_seq", run_id: str | None = None, finish: dict[str, Finish] | None = None) -> dict:
    """Insert-or-ignore ``batches`` (table columns without ``id``, plus ``seq``) and append ``logs``, all in one version.

    Where ``finish`` has a function for a table, its batch may hold other columns, of which that function makes the table's, and
    passes on those that it is told to keep.

    If another writer publishes first, everything is decided again against what it has added; ids go on from there. A
    ``run_id`` that was published before changes nothing, so a run that is repeated does not double its log. Returns the
    manifest that holds the load. Batches are read once per try: pass written tables, not long plans.
    """
    root = root.rstrip("/")
    ensure_tables(spark, root)
    for _ in range(TRIES):
        state = current(spark, root)
        if run_id is not None and run_id in state["runs"]:
            return state
        load = uuid.uuid4().hex
        works = {name: partial(_load_new, spark, root, name, batch, (finish or {}).get(name), state, load, seq) for name, batch in batches.items()}
        if logs:
            works[LOG] = partial(_load_log, spark, root, logs, state, load, seq)
        entries = dict(zip(works, at_once(works.values())))
        after = {**state, "tables": state["tables"] | entries, "runs": state["runs"] + ([run_id] if run_id else [])}
        if commits.publish(spark, root, state["version"] + 1, after):
            return {**after, "version": state["version"] + 1}
    raise RuntimeError(f"{TRIES} other writers were first")


def append_new(spark: SparkSession, root: str, name: str, batch: DataFrame, seq: str = "ingest_seq") -> None:
    """Insert-or-ignore one table's batch as a version of its own."""
    load_tables(spark, root, {name: batch}, seq=seq)


def append_log(spark: SparkSession, root: str, rows: DataFrame, seq: str = "ingest_seq") -> None:
    """Append resolution log rows as a version of their own."""
    load_tables(spark, root, {}, [rows], seq)
