"""A durable stop between two queries: written by one, read by the next."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark import session
from tidemark.streaming import sinks


def through(df: DataFrame, name: str = "hop") -> DataFrame:
    """Write a table and read it back; records and their times stay as they are."""
    return session.written(df, name)


def start_writing(
    df: DataFrame, path: str, *, name: str, checkpoint: str, every: str | None = "10 seconds"
) -> StreamingQuery:
    """First half on a stream: append records to the stop."""
    return sinks.start(df, sinks.to_parquet(path), name=name, checkpoint=checkpoint, every=every)


def read(spark: SparkSession, path: str, schema: StructType, **options: str) -> DataFrame:
    """Second half on a stream: the records of the stop, including those to come."""
    return spark.readStream.schema(schema).options(**options).parquet(path)


# ---- a stop laid out by time: readers that start late skip what lies before ----

DAY = "day"


def start_writing_days(
    df: DataFrame, path: str, *, name: str, checkpoint: str, ts: str = "ts", every: str | None = "10 seconds"
) -> StreamingQuery:
    """Append records to a stop with a folder for each day of their times."""
    dated = df.withColumn(DAY, F.to_date(ts))
    return sinks.start(dated, sinks.to_parquet(path, DAY), name=name, checkpoint=checkpoint, every=every)


def read_days(
    spark: SparkSession,
    path: str,
    schema: StructType,
    start: datetime | None = None,
    *,
    ts: str = "ts",
    streaming: bool = False,
    **options: str,
) -> DataFrame:
    """The records of such a stop from ``start`` on; files of earlier days are not opened."""
    reader = (spark.readStream if streaming else spark.read).options(**options)
    found = reader.schema(StructType(list(schema.fields)).add(DAY, "date")).parquet(path)
    if start is not None:
        # The folder's day decides which files are read, the time which of their records.
        found = found.where((F.col(DAY) >= F.lit(start.date())) & (F.col(ts) >= F.lit(start)))
    return found.drop(DAY)


# ---- a stop laid out by key: joins on the key need not move it again ----


def through_buckets(df: DataFrame, keys: Sequence[str], buckets: int, name: str = "buckets") -> DataFrame:
    """Write a table in buckets of its keys, sorted by them, and read it back.

    A join or aggregate on these keys takes the buckets as they are, one task each, and only
    the other side is shuffled.  The table lies in the shared folder and its entry in the
    session's catalog.  Give about a bucket per 128 MB, and let no key hold more than a task
    may read: adaptive execution does not split buckets.
    """
    spark = df.sparkSession
    path = session.run_dir(spark, name)
    table = f"{name}_{path.rsplit('-', 1)[1]}".replace("-", "_")
    writer = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
    writer.option("path", path).format("parquet").saveAsTable(table)
    return spark.table(table)
