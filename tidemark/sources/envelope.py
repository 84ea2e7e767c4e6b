"""The record envelope every operator reads: key, value, ts, topic, partition, offset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COLUMNS = ("key", "value", "ts", "topic", "partition", "offset")


def _as_column(given: Column | str | None, default: Column) -> Column:
    if given is None:
        return default
    return F.col(given) if isinstance(given, str) else given


def from_kafka(raw: DataFrame) -> DataFrame:
    """Rows of the Kafka source; key and value read as UTF-8 text."""
    return raw.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").alias("ts"),
        "topic",
        "partition",
        "offset",
    )


def from_text(raw: DataFrame, topic: str) -> DataFrame:
    """Lines of text files.  A line has no key and no offset of its own.

    Its time is the file's.  Operators that need record order want ``offset``:
    ``readers.lines_in_order`` numbers the lines of a table of files.
    """
    return raw.select(
        F.lit(None).cast("string").alias("key"),
        "value",
        F.col("_metadata.file_modification_time").alias("ts"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.lit(None).cast("bigint").alias("offset"),
    )


def from_table(
    df: DataFrame,
    *,
    value: Column | str,
    topic: str,
    key: Column | str | None = None,
    ts: Column | str | None = None,
    partition: Column | str | None = None,
    offset: Column | str | None = None,
) -> DataFrame:
    """Rows of a table, told which column or expression plays which part.

    ``partition`` and ``offset`` must not be null where record order matters,
    and ``offset`` must be unique within a partition.
    """
    return df.select(
        _as_column(key, F.lit(None)).cast("string").alias("key"),
        _as_column(value, F.lit(None)).alias("value"),
        _as_column(ts, F.lit(None)).cast("timestamp").alias("ts"),
        F.lit(topic).alias("topic"),
        _as_column(partition, F.lit(0)).cast("int").alias("partition"),
        _as_column(offset, F.lit(None)).cast("bigint").alias("offset"),
    )
