"""Inner join of two record streams on a key, within a time interval."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.durations import interval_text, time_index
from tidemark.operators import windows
from tidemark.operators.running import running
from tidemark.operators.stateless import with_key

MICROSECOND = timedelta(microseconds=1)
SLOT = "__slot"


def _seconds(span: timedelta) -> Column:
    return F.expr(f"INTERVAL '{span.total_seconds():.6f}' SECOND")


def with_slots(
    right: DataFrame, before: timedelta, after: timedelta, *, key: str = "key", ts: str = "ts"
) -> DataFrame:
    """A right record of ``interval_join`` once for each slot of time its partners can be in."""
    width = max(before + after, MICROSECOND)
    first, last = F.col(ts) - _seconds(after), F.col(ts) + _seconds(before)
    slots = F.sequence(time_index(first, width), time_index(last, width))
    return with_key(right, key).withColumn(SLOT, F.explode(slots))


def interval_join(
    left: DataFrame,
    right: DataFrame,
    before: timedelta,
    after: timedelta,
    columns: Sequence[Column | str],
    *,
    key: str = "key",
    ts: str = "ts",
    grace: timedelta | None = None,
    salts: int = 1,
    salt_on: Sequence[str] = ("partition", "offset"),
    also: Column | None = None,
) -> DataFrame:
    """All pairs with one key and ``left.ts - before <= right.ts <= left.ts + after``.

    Both ends are inclusive and no pair is merged: a record sent twice matches
    twice.  ``columns`` are taken from the aliases ``left`` and ``right``.  The
    result starts with ``key`` and ``ts``, the later of the two times.  Records
    without a key match nothing.  ``also`` is a further condition on a pair.

    Time is cut into slots as long as the interval and the slot joins along with
    the key.  A left record lies in one slot, a right one in the two slots its
    partners can be in (so give the smaller input as ``right``).  A key that
    holds a third of all records is thereby spread over its slots, and records
    are compared with those near in time only.

    One slot of one key may still be too much for a task, after a bulk load with
    one time stamp.  Tables: adaptive execution splits such a partition.  Streams
    have no such help: ``salts`` splits the left records of each (key, slot) by a
    hash of ``salt_on`` and repeats the right ones that many times.

    ``right`` may come with its slots (``with_slots``), for instance from a stop in buckets of
    key and slot (``streaming.hop.through_buckets``), and is then not shuffled again.

    On streams ``grace`` says how late a record may be and still join; it is the
    watermark on both inputs, and with the interval it bounds the kept state.
    """
    if left.isStreaming or right.isStreaming:
        if grace is None:
            raise ValueError("a streaming join needs a grace period, or its state never shrinks")
        left = left.withWatermark(ts, interval_text(grace))
        right = right.withWatermark(ts, interval_text(grace))
    width = max(before + after, MICROSECOND)
    back, ahead = _seconds(before), _seconds(after)

    left = with_key(left, key).withColumn(SLOT, time_index(F.col(ts), width))
    if SLOT not in right.columns:
        right = with_slots(right, before, after, key=key, ts=ts)
    on = [key, SLOT]
    if salts > 1:
        left = left.withColumn("__salt", F.pmod(F.xxhash64(*salt_on), F.lit(salts)))
        every = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
        right = right.withColumn("__salt", F.explode(every))
        on.append("__salt")

    left, right = left.alias("left"), right.alias("right")
    left_ts, right_ts = F.col(f"left.{ts}"), F.col(f"right.{ts}")
    condition = (right_ts >= left_ts - back) & (right_ts <= left_ts + ahead)
    if also is not None:
        condition = condition & also
    for name in on:
        condition = condition & (F.col(f"left.{name}") == F.col(f"right.{name}"))
    return left.join(right, condition).select(
        F.col(f"left.{key}").alias(key),
        F.greatest(left_ts, right_ts).alias(ts),
        *columns,
    )


def both_sides(
    left: DataFrame, right: DataFrame, key: str = "key", ts: str = "ts", place: Sequence[str] = ("partition", "offset")
) -> DataFrame:
    """The records with a key of both sides in one table: their place and time, and the record
    itself in ``left`` or ``right``."""
    sides = [
        with_key(df, key).select(*place, ts, F.struct(*df.columns).alias(side))
        for side, df in (("left", left), ("right", right))
    ]
    return sides[0].unionByName(sides[1], allowMissingColumns=True)


def in_time(
    before: timedelta,
    after: timedelta,
    grace: timedelta,
    partition: Sequence[str] = ("partition",),
    ts: str = "ts",
) -> Column:
    """That neither record of a pair had expired when the later one arrived.

    A record expires when stream time passes the end of its reach by more than the grace.
    Stream time never falls, so of the two (``__stream_time``) the larger one is that at the
    later arrival, and a record that was late itself fails the same test.
    """
    stream_time = F.greatest("left.__stream_time", "right.__stream_time")
    first_end = F.least(F.col(f"left.{ts}") + _seconds(after), F.col(f"right.{ts}") + _seconds(before))
    condition = stream_time <= first_end + _seconds(grace)
    for name in partition:
        condition = condition & (F.col(f"left.{name}") == F.col(f"right.{name}"))
    return condition


def interval_join_replayed(
    left: DataFrame,
    right: DataFrame,
    before: timedelta,
    after: timedelta,
    columns: Sequence[Column | str],
    *,
    grace: timedelta,
    key: str = "key",
    ts: str = "ts",
    partition: Sequence[str] = ("partition",),
    offset: str = "offset",
    widths: Sequence[int] = (1 << 20,),
) -> DataFrame:
    """``interval_join`` of two tables as it would have gone record by record.

    Records of both sides arrive in the order of one ``offset`` within each ``partition``,
    which holds all records of a key.  Stream time is the largest ``ts`` of either side met so
    far in the partition.  A left record expires once stream time is past
    ``ts + after + grace``, a right one past ``ts + before + grace``: if it has expired as it
    arrives it is late and joins nothing, and later on nothing finds it any more.

    Stream time comes from ``windows.stream_time``, in blocks of offsets, so a partition with
    most of the records is no single task's work.  ``tidemark.streaming.replay.start_join`` is
    the form for streams.
    """
    both = both_sides(left, right, key, ts, [*partition, offset])
    timed = windows.stream_time(both, partition, [offset], ts, widths=widths)
    sides = [
        timed.where(F.col(s).isNotNull()).select(f"{s}.*", F.col("stream_time").alias("__stream_time"))
        for s in ("left", "right")
    ]
    return interval_join(
        *sides, before, after, columns, key=key, ts=ts, also=in_time(before, after, grace, partition, ts)
    )


def as_of_join(
    left: DataFrame,
    table: DataFrame,
    columns: Sequence[Column | str],
    *,
    key: str = "key",
    order: Sequence[str] = ("partition", "offset"),
    block_on: str = "offset",
    widths: Sequence[int] = (1 << 20,),
    hot: DataFrame | None = None,
    start: DataFrame | None = None,
) -> DataFrame:
    """Each left record with the table as it was when the record arrived.

    ``table`` is a stream of changes, read as a table: of each key the last change counts.
    Both sides arrive in one ``order``, unique over both.  A record joins the last change of
    its key before it; with none before it, it joins nothing, and no later one reaches back.
    ``columns`` are taken from the aliases ``left`` and ``right``.

    The last change is a running maximum over both sides together (``running``), so a key that
    holds most of the records is cut into blocks: give ``hot_keys`` of both sides as ``hot``.
    ``start`` may give changes (``key``, ``right``) from before, a struct of the order and row.
    """
    place = [*order, key]
    changes = with_key(table, key)
    row = F.struct(*order, F.struct(*table.columns).alias("row"))
    both = (
        with_key(left, key)
        .select(*place, F.struct(*left.columns).alias("left"))
        .unionByName(changes.select(*place, row.alias("right")), allowMissingColumns=True)
    )
    last = running(both, [key], order, {"right": ("max", "right")}, block_on=block_on, widths=widths, hot=hot, start=start)
    found = last.where(F.col("left").isNotNull() & F.col("right").isNotNull())
    return found.select(F.col(key), *order, "left", F.col("right.row").alias("right")).select(key, *columns)
