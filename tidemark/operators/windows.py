"""Tumbling windows, stream time, late records and final results.

Records arrive in ``order`` within each ``partition``.  Stream time is the
largest ``ts`` met so far in the partition.  A window [start, end) closes when
stream time reaches end + grace.  A record is late if its window has closed;
a final result is what a closed window holds without the late records.

Three forms exist of the last step:

* ``tumbling_final`` replays a table and follows those rules exactly;
* ``streaming.replay.start_final`` follows them on a stream, batch by batch;
* ``tumbling_stream`` lets Spark's watermark close windows in an unbounded
  query.  The watermark moves between micro-batches, so with one partition it is
  never stricter than the replay.  With several it follows the fastest one, and
  records of a slow partition that the replay keeps may be dropped.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.durations import (
    index_start,
    interval,
    interval_text,
    time_index,
)
from tidemark.operators.aggregates import measure
from tidemark.operators.running import running
from tidemark.operators.stateless import with_key

NO_GRACE = timedelta(0)


def tumbling(
    df: DataFrame,
    size: timedelta,
    how: str = "sum",
    key: str = "key",
    value: str = "value",
    ts: str = "ts",
) -> DataFrame:
    """Total per (window, key) over epoch-aligned windows, start inclusive."""
    frame = F.window(ts, interval_text(size)).alias("window")
    totals = with_key(df, key).groupBy(frame, key).agg(measure(how, value).alias(value))
    return totals.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        key,
        value,
    )


def tumbling_stream(
    df: DataFrame,
    size: timedelta,
    grace: timedelta = NO_GRACE,
    how: str = "sum",
    key: str = "key",
    value: str = "value",
    ts: str = "ts",
) -> DataFrame:
    """``tumbling`` on a stream; in append mode each window comes out once, closed.

    Late records are dropped and counted in the query's progress.
    """
    return tumbling(df.withWatermark(ts, interval_text(grace)), size, how, key, value, ts)


def stream_time(
    df: DataFrame,
    partition: Sequence[str] = ("partition",),
    order: Sequence[str] = ("offset",),
    ts: str = "ts",
    block_on: str | None = None,
    widths: Sequence[int] = (1 << 20,),
    start: DataFrame | None = None,
) -> DataFrame:
    """Add ``stream_time``: the largest ``ts`` of the partition up to this record.

    ``start`` has that of each partition before the first record.
    """
    if not partition:
        raise ValueError("stream time needs partition columns; one global order does not scale")
    return running(
        df,
        partition,
        order,
        {"stream_time": ("max", ts)},
        block_on=block_on or order[0],
        widths=widths,
        start=start,
    )


def closings(
    df: DataFrame,
    size: timedelta,
    grace: timedelta = NO_GRACE,
    partition: Sequence[str] = ("partition",),
    offset: str = "offset",
    ts: str = "ts",
    key: str = "key",
) -> DataFrame:
    """Where each window closes: (partition, window_index, closed_at).

    A window closes at the first record whose ``ts`` is at or past end + grace.
    In terms of windows that is the least offset among the records whose
    ``ts - grace`` lies in a later window, so it follows from one least offset
    per (partition, window): records are never sorted, nor moved in full.
    Records without a key never reach the windows and so close none.
    Windows that stay open are left out.  The table has one row per closed
    window; store it with ``session.written`` so that its size is known.
    """
    if not partition:
        raise ValueError("closing times need partition columns; one global order does not scale")
    partition = list(partition)
    own = time_index(F.col(ts), size)
    shifted = time_index(F.col(ts) - interval(grace), size)
    marks = (
        with_key(df, key)
        .groupBy(*partition, own.alias("own"), shifted.alias("shifted"))
        .agg(F.min(offset).alias("first"))
        .select(
            *partition,
            F.explode(
                F.array(
                    F.struct(F.col("shifted").alias("window_index"), "first"),
                    F.struct(F.col("own").alias("window_index"), F.lit(None).cast("bigint").alias("first")),
                )
            ).alias("mark"),
        )
        .groupBy(*partition, F.col("mark.window_index").alias("window_index"))
        .agg(F.min("mark.first").alias("first"))
    )
    later = (
        Window.partitionBy(*partition)
        .orderBy(F.desc("window_index"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    closed = marks.select(*partition, "window_index", F.min("first").over(later).alias("closed_at"))
    return closed.where(F.col("closed_at").isNotNull())


def _in_closed_windows(
    df: DataFrame, closed: DataFrame, size: timedelta, partition: Sequence[str], ts: str
) -> DataFrame:
    return indexed(df, size, ts).join(closed, [*partition, "window_index"])


def indexed(df: DataFrame, size: timedelta, ts: str = "ts") -> DataFrame:
    """Add ``window_index``, the number of the window that a record lies in."""
    return df.withColumn("window_index", time_index(F.col(ts), size))


def ends(size: timedelta, grace: timedelta = NO_GRACE) -> Column:
    """From which stream time on the window of that index is closed."""
    return index_start(F.col("window_index") + 1, size) + interval(grace)


def bounds(size: timedelta) -> tuple[Column, Column]:
    """First and last instant of the window with that index."""
    index = F.col("window_index")
    return (
        index_start(index, size).alias("window_start"),
        index_start(index + 1, size).alias("window_end"),
    )


def late(
    df: DataFrame,
    closed: DataFrame,
    size: timedelta,
    partition: Sequence[str] = ("partition",),
    offset: str = "offset",
    ts: str = "ts",
    key: str = "key",
) -> DataFrame:
    """The records with a key that arrive after their window closed, with the window's bounds.

    ``closed`` is ``closings`` of the same records, size and grace.
    """
    found = _in_closed_windows(with_key(df, key), closed, size, partition, ts)
    return found.where(F.col(offset) >= F.col("closed_at")).select(*df.columns, *bounds(size))


def tumbling_final(
    df: DataFrame,
    closed: DataFrame,
    size: timedelta,
    how: str = "sum",
    partition: Sequence[str] = ("partition",),
    offset: str = "offset",
    key: str = "key",
    value: str = "value",
    ts: str = "ts",
) -> DataFrame:
    """Final total per (partition, closed window, key), late records left out.

    ``closed`` is ``closings`` of the same records, size and grace.  ``partition``
    may be the key itself, which gives every key a stream time of its own.
    """
    found = _in_closed_windows(with_key(df, key), closed, size, partition, ts)
    others = [name for name in partition if name != key]
    totals = (
        found.where(F.col(offset) < F.col("closed_at"))
        .groupBy(*others, "window_index", key)
        .agg(measure(how, value).alias(value))
    )
    return totals.select(*others, *bounds(size), key, value)


def emitted(results: DataFrame) -> DataFrame:
    """Add the wall-clock time at which a result leaves the query."""
    return results.withColumn("emitted_at", F.current_timestamp())
