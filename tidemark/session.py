"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
# One state store to a join's partition in place of four, each with a commit of its own.
JOIN_STATE = "spark.sql.streaming.join.stateFormatVersion"
JOIN_STATE_VERSION = "3"
# For totals of very many keys.  To count a store's rows, each key is read a second time before it
# is written.  A cache of 8 MB, the default, holds few of a store's blocks.
MANY_KEYS = {
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.rocksdb.blockCacheSizeMB": "64",
}
SPLIT_HOT_JOINS = "spark.sql.adaptive.forceOptimizeSkewedJoin"

SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"

# One folder per application, used only where the cluster names none.
_local_dirs: dict[str, str] = {}
# Paths of stored tables, by the ``scratch`` that owns them.
_owned: list[list[str]] = []


def build(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or fetch) a session with the settings this package expects.

    Pass Spark settings with dots written as double underscores, e.g.
    ``spark__sql__shuffle__partitions="8"``.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config(SPLIT_HOT_JOINS, "true")
        .config(STATE_STORE, ROCKSDB)
        .config(JOIN_STATE, JOIN_STATE_VERSION)
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Give a session made elsewhere the settings this package relies on.

    UTC makes zone-less table timestamps mean one instant.  Joins are split where
    one key is hot, even if a later grouping then needs a shuffle of its own.
    RocksDB keeps streaming state off the executor heap, so it may outgrow memory.
    A stream join that goes on from a checkpoint keeps the state format it began with.
    The number of shuffle partitions is left alone: adaptive execution merges them, and
    streams are told theirs (``sinks.start``).
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set(SPLIT_HOT_JOINS, "true")
    spark.conf.set(STATE_STORE, ROCKSDB)
    spark.conf.set(JOIN_STATE, JOIN_STATE_VERSION)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    ``spark.checkpoint.dir`` is read from the session.  Only a local master may
    go without it: there the driver's disk is the executors' disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="tidemark-")
    return _local_dirs[context.applicationId]


def run_dir(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Store a result as a table and read it back.

    Cuts lineage in a way that survives lost executors.  The planner then knows
    the real size, so it broadcasts the table only if it is below
    ``spark.sql.autoBroadcastJoinThreshold``, and shuffles otherwise.
    """
    spark = df.sparkSession
    path = run_dir(spark, name)
    if _owned:
        _owned[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that ``written`` makes in here when it is left.

    Results that depend on them must be stored, or used up, before.
    """
    _owned.append([])
    try:
        yield
    finally:
        for path in _owned.pop():
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
