"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")


def build_session(app: str = "signalbase", master: str | None = None, **conf) -> SparkSession:
    """A session with UTC, AQE and skew-join handling on.

    Shuffle partitions start high and AQE coalesces them, so one setting serves a laptop and a
    large cluster. Pass ``**{"spark.sql.shuffle.partitions": ...}`` style overrides in ``conf``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Text dates are rendered in the session zone, so every entry point pins it to UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    A machine-local folder is made only in local mode with nothing set; on a cluster that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="signalbase-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


_written: dict[str, list[str]] = {}      # staged paths by application
_STAGED_TABLE = "signalbase_stage_"
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder."""
    path = f"{shared_dir(spark)}/signalbase/{name}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def is_staged(spark: SparkSession, df: DataFrame) -> bool:
    """Whether the written table that ``df`` reads was not dropped since."""
    held = _written.get(spark.sparkContext.applicationId, [])
    return any(path.rsplit("/", 1)[1] in file for file in df.inputFiles()[:1] for path in held)


def drop_stages(spark: SparkSession) -> None:
    """Remove what this application has staged. For the end of a run: frames that hang on staged tables are void after it."""
    for table in spark.catalog.listTables():
        if table.name.startswith(_STAGED_TABLE):
            spark.sql(f"DROP TABLE {table.name}")
    for path in _written.pop(spark.sparkContext.applicationId, []):
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several outputs hang on one expensive parent: the lineage is cut by a table that
    outlives any executor, instead of a cache that dies with it.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_by(df: DataFrame, keys: Sequence[str], name: str, dealt: bool = False) -> DataFrame:
    """Write ``df`` once, bucketed by ``keys``: joins on them read it as it lies, without a shuffle, however often.

    The files lie in the shared folder; the session's catalogue has an entry for them, which tells Spark of the buckets.
    Rows that come ``dealt`` by these keys to as many partitions as Spark is set to are written from where they are.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{_STAGED_TABLE}{uuid.uuid4().hex}"
    rows = df if dealt else df.repartition(buckets, *keys)
    held = spark.conf.get(_WRITERS)
    spark.conf.set(_WRITERS, str(max(1, int(held))))    # a task has one bucket; without this Spark sorts all its rows by bucket first
    try:
        (rows.write.option("path", fresh_path(spark, name)).bucketBy(buckets, *keys).saveAsTable(table))
    finally:
        spark.conf.set(_WRITERS, held)
    return spark.table(table)


def at_once(works: Iterable[Callable[[], T]]) -> list[T]:
    """Results of works that do not hang on each other, their jobs run side by side."""
    works, inherited = list(works), inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(max(1, len(works))) as pool:
        return [done.result() for done in [pool.submit(inherited(work)) for work in works]]
