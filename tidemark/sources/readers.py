"""Batch and streaming readers."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import session
from tidemark.sources import envelope


def kafka_options(
    servers: str,
    topic: str,
    start: str | None = None,
    options: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of Spark's Kafka source; security settings pass through unchanged."""
    chosen = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if start is not None:
        chosen["startingOffsets"] = start
    chosen.update(options or {})
    return chosen


def kafka(
    spark: SparkSession,
    servers: str,
    topic: str,
    start: str = "latest",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A topic as an unbounded stream, by default from its newest record on."""
    chosen = kafka_options(servers, topic, start, options)
    return envelope.from_kafka(spark.readStream.format("kafka").options(**chosen).load())


def kafka_table(
    spark: SparkSession,
    servers: str,
    topic: str,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """What a topic holds now, as a table."""
    chosen = kafka_options(servers, topic, "earliest", options)
    return envelope.from_kafka(spark.read.format("kafka").options(**chosen).load())


def text(
    spark: SparkSession, path: str, topic: str, *, streaming: bool = False, start: datetime | None = None
) -> DataFrame:
    """Lines of the text files at ``path`` (plain words or one JSON object a line).

    Of a table, files last changed before ``start`` are not read; Spark's file streams can't
    leave files out by time, so there only older records are left out.
    """
    if streaming:
        return since(envelope.from_text(spark.readStream.text(path), topic), start)
    reader = spark.read.options(**modified_since(start))
    return envelope.from_text(reader.text(path), topic)


def lines_in_order(spark: SparkSession, path: str, topic: str) -> DataFrame:
    """Lines of the text files at ``path`` as a table, numbered: ``offset`` counts on from file to file.

    Files come in the order of their paths.  Spark reads a file in splits, each by one task
    from its first line to its last, so a line's number is that within its split plus the lines
    of all splits before.  The lines are stored with their place in the task, and then
    counted per split: one row for each, so that adding those up is little work.  No line is
    sorted or shuffled while the splits' table is below the planner's broadcast limit.
    """
    split = ["file", "begin"]
    raw = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_modification_time").alias("ts"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("begin"),
        F.monotonically_increasing_id().alias("place"),
    )
    stored = session.written(raw, "lines")
    # Rows of a split follow one another in its task, so their places do.
    splits = stored.groupBy(*split).agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("lines"))
    files = splits.groupBy("file").agg(F.sum("lines").alias("file_lines"))
    earlier_files = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    earlier_splits = Window.partitionBy("file").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    begun = files.select("file", F.coalesce(F.sum("file_lines").over(earlier_files), F.lit(0)).alias("files_before"))
    counted = splits.withColumn("splits_before", F.coalesce(F.sum("lines").over(earlier_splits), F.lit(0)))
    bases = counted.join(begun, "file").select(
        *split, (F.col("files_before") + F.col("splits_before") - F.col("first")).alias("base")
    )
    numbered = stored.join(session.written(bases, "splits"), split)
    return envelope.from_table(
        numbered, value="value", topic=topic, ts="ts", offset=F.col("base") + F.col("place")
    )


def table(spark: SparkSession, path: str, *, streaming: bool = False, **options: str) -> DataFrame:
    """A Parquet table, one file or a folder of them.

    A streaming reader accepts a single file only through a glob, so the last
    letter of the name is written as a one-letter class that matches just it.
    """
    if not streaming:
        return spark.read.options(**options).parquet(path)
    schema = spark.read.parquet(path).schema
    path = path.rstrip("/")
    exact = f"{path[:-1]}[{path[-1]}]"
    return spark.readStream.schema(schema).options(**options).parquet(exact)


def since(df: DataFrame, start: datetime | None) -> DataFrame:
    """Leave out records before ``start``; file sources have no starting offset.

    To leave out whole files, say so when reading: ``modified_since``, or the days of a stop
    laid out by time (``streaming.hop.read_days``).
    """
    return df if start is None else df.where(F.col("ts") >= F.lit(start))


def modified_since(start: datetime | None) -> dict[str, str]:
    """Options of a file reader that skip files last changed before ``start`` (UTC).

    A file is listed but not opened.  Only tables take these options.
    """
    return {} if start is None else {"modifiedAfter": start.strftime("%Y-%m-%dT%H:%M:%S")}
