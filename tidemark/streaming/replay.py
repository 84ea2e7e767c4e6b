"""The record-order rules of windows and joins, exactly, on unbounded streams.

Spark's watermark is one for a whole query and moves between micro-batches.  Here stream time
is kept for each source partition and moves with each record, as in ``windows.closings`` and
``joins.interval_join_replayed``; what comes out over all batches is what they give for the
whole table.  A batch works on its own records, on the stream times it starts from, and on
what is still open: totals of windows, or records that may yet find a partner.  These
are handed on as tables (``batches.Carried``) and let go of as stream time passes.

Records must come in order within a partition from batch to batch.  A partition that falls
silent keeps what it has open; it holds back no other one, as a shared watermark would.
Each query's checkpoint, results and tables lie under one ``root`` and belong together.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark import session
from tidemark.functions.durations import interval
from tidemark.operators import joins, windows
from tidemark.operators.aggregates import measure
from tidemark.operators.stateless import with_key
from tidemark.streaming import sinks
from tidemark.streaming.batches import Carried, Results

FINAL, LATE, PAIRS = "final", "late", "pairs"


def _advanced(times: DataFrame, records: DataFrame, partition: Sequence[str], ts: str) -> DataFrame:
    """Stream time of each partition after these records."""
    mine = records.select(*partition, F.col(ts).alias("stream_time"))
    return times.unionByName(mine).groupBy(*partition).agg(F.max("stream_time").alias("stream_time"))


def _times_schema(records: DataFrame, partition: Sequence[str], ts: str) -> StructType:
    return records.select(*partition, F.col(ts).alias("stream_time")).schema


def start_final(
    records: DataFrame,
    root: str,
    size: timedelta,
    *,
    name: str,
    grace: timedelta = windows.NO_GRACE,
    how: str = "sum",
    partition: Sequence[str] = ("partition",),
    offset: str = "offset",
    key: str = "key",
    value: str = "value",
    ts: str = "ts",
    every: str | None = "10 seconds",
) -> StreamingQuery:
    """``windows.tumbling_final`` and ``windows.late`` of a stream, batch by batch.

    A batch closes the windows that its partition's stream time passes, whether they began
    in it or are open from before, and writes their totals once.  Records that come after
    their window closed are written as late.  The batch is never sorted.
    """
    spark = records.sparkSession
    partition = list(partition)
    merge = "sum" if how == "count" else how
    others = [p for p in partition if p != key]
    times_schema = _times_schema(records, partition, ts)
    nothing = spark.createDataFrame([], records.schema)
    open_schema = _partial(nothing, size, how, others, key, value, ts).schema
    for kind, shape in ((FINAL, _bounded(spark.createDataFrame([], open_schema), size)), (LATE, _late(nothing, size, ts))):
        spark.createDataFrame([], shape.schema).write.mode("overwrite").parquet(f"{root}/{kind}-schema")

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        times = Carried(spark, f"{root}/times", times_schema)
        still_open = Carried(spark, f"{root}/open", open_schema)
        batch = with_key(batch, key).persist()
        try:
            with session.scratch(spark):
                before = times.before(batch_id)
                after = times.leave(_advanced(before, batch, partition, ts), batch_id)
                closed = session.written(
                    windows.closings(batch, size, grace, partition, offset, ts, key), "closings"
                )
                placed = windows.indexed(batch, size, ts)
                placed = placed.join(before, partition, "left").join(closed, [*partition, "window_index"], "left")
                ended = windows.ends(size, grace) <= F.col("stream_time")
                too_late = F.coalesce(ended, F.lit(False)) | F.coalesce(F.col(offset) >= F.col("closed_at"), F.lit(False))
                placed = placed.withColumn("__late", too_late)
                late = placed.where("__late").select(*records.columns, *windows.bounds(size))
                Results(spark, f"{root}/{LATE}").write(late, batch_id)
                fresh = (
                    placed.where("NOT __late")
                    .groupBy(*others, "window_index", key)
                    .agg(measure(how, value).alias(value))
                )
                totals = (
                    still_open.before(batch_id)
                    .unionByName(fresh)
                    .groupBy(*others, "window_index", key)
                    .agg(measure(merge, value).alias(value))
                    .join(after, partition)
                )
                totals = session.written(totals.withColumn("__closed", windows.ends(size, grace) <= F.col("stream_time")), "totals")
                done = _bounded(totals.where("__closed").select(*open_schema.names), size)
                Results(spark, f"{root}/{FINAL}").write(done, batch_id)
                still_open.leave(totals.where("NOT __closed"), batch_id)
        finally:
            batch.unpersist()

    return sinks.start(
        records, sinks.to_batches(run_batch), name=name, checkpoint=f"{root}/progress", every=every
    )


def _partial(
    df: DataFrame, size: timedelta, how: str, others: Sequence[str], key: str, value: str, ts: str
) -> DataFrame:
    placed = windows.indexed(df, size, ts)
    return placed.groupBy(*others, "window_index", key).agg(measure(how, value).alias(value))


def _bounded(totals: DataFrame, size: timedelta) -> DataFrame:
    names = totals.columns
    at = names.index("window_index")
    return totals.select(*names[:at], *windows.bounds(size), *names[at + 1 :])


def _late(df: DataFrame, size: timedelta, ts: str) -> DataFrame:
    return windows.indexed(df, size, ts).select(*df.columns, *windows.bounds(size))


def start_join(
    left: DataFrame,
    right: DataFrame,
    root: str,
    before: timedelta,
    after: timedelta,
    columns: Sequence[Column | str],
    *,
    name: str,
    grace: timedelta,
    key: str = "key",
    ts: str = "ts",
    partition: Sequence[str] = ("partition",),
    offset: str = "offset",
    every: str | None = "10 seconds",
) -> StreamingQuery:
    """``joins.interval_join_replayed`` of two streams, batch by batch.

    Both sides share the stream time of their partition, so the one that goes on lets go of
    the other's records as well.  A batch joins its records with each other and with those
    of before that have not expired; at its end it keeps the ones that a record still to
    come could find.
    """
    spark = left.sparkSession
    partition = list(partition)
    schemas = {"left": left.schema, "right": right.schema}
    reach = {"left": after, "right": before}
    both = joins.both_sides(left, right, key, ts, [*partition, offset])
    times_schema = _times_schema(both, partition, ts)
    held_schemas = {s: StructType(list(f.fields)).add("__stream_time", "timestamp") for s, f in schemas.items()}

    def matched(one: DataFrame, other: DataFrame) -> DataFrame:
        return joins.interval_join(
            one, other, before, after, columns, key=key, ts=ts,
            also=joins.in_time(before, after, grace, partition, ts),
        )

    shape = matched(*[spark.createDataFrame([], held_schemas[s]) for s in ("left", "right")]).schema
    spark.createDataFrame([], shape).write.mode("overwrite").parquet(f"{root}/{PAIRS}-schema")

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        times = Carried(spark, f"{root}/times", times_schema)
        batch = batch.persist()
        try:
            with session.scratch(spark):
                earlier = times.before(batch_id)
                now = times.leave(_advanced(earlier, batch, partition, ts), batch_id)
                timed = session.written(
                    windows.stream_time(batch, partition, [offset], ts, start=earlier), "timed"
                )
                held = {s: Carried(spark, f"{root}/held-{s}", held_schemas[s]) for s in schemas}
                old = {s: held[s].before(batch_id) for s in schemas}
                new = {
                    s: timed.where(F.col(s).isNotNull()).select(f"{s}.*", F.col("stream_time").alias("__stream_time"))
                    for s in schemas
                }
                found = matched(old["left"].unionByName(new["left"]), new["right"])
                found = found.unionByName(matched(new["left"], old["right"]))
                Results(spark, f"{root}/{PAIRS}").write(found, batch_id)
                for s in schemas:
                    ends = F.col(ts) + interval(reach[s]) + interval(grace)
                    alive = old[s].unionByName(new[s]).join(now, partition).where(ends >= F.col("stream_time"))
                    held[s].leave(alive, batch_id)
        finally:
            batch.unpersist()

    return sinks.start(
        both, sinks.to_batches(run_batch), name=name, checkpoint=f"{root}/progress", every=every
    )


def read(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """What the complete batches have put out: FINAL or LATE of ``start_final``, PAIRS of ``start_join``."""
    schema = spark.read.parquet(f"{root}/{kind}-schema").schema
    return Results(spark, f"{root}/{kind}").read(schema).drop("batch")


def held(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables that the next batch goes on from, by their names under ``root``."""
    found = {}
    for name in ("times", "open", "held-left", "held-right"):
        stored = Carried(spark, f"{root}/{name}", StructType())
        newest = stored.newest()
        if newest is not None:
            found[name] = spark.read.parquet(newest)
    return found
