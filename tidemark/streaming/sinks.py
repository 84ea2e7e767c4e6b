"""Starting streaming queries and the sinks they write to."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from tidemark import session
from tidemark.functions import codecs
from tidemark.operators.aggregates import compact
from tidemark.streaming.batches import Results

Sink = Callable[[DataStreamWriter], DataStreamWriter]


def to_parquet(path: str, *folders: str) -> Sink:
    """Append-only table, exactly once; with a folder for each value of the columns named."""

    def sink(writer: DataStreamWriter) -> DataStreamWriter:
        writer = writer.format("parquet").option("path", path)
        return writer.partitionBy(*folders) if folders else writer

    return sink


def to_json_lines(path: str) -> Sink:
    """Append-only text files with one JSON object a line."""
    return lambda writer: writer.format("json").option("path", path)


def to_memory() -> Sink:
    """A driver-side table named like the query; for tests and small results only."""
    return lambda writer: writer.format("memory")


def to_console() -> Sink:
    return lambda writer: writer.format("console").option("truncate", "false")


def to_each(action: Callable) -> Sink:
    """Call ``action(row)`` on the executors for every result row."""
    return lambda writer: writer.foreach(action)


def to_batches(action: Callable[[DataFrame, int], None]) -> Sink:
    """Call ``action(rows, batch_id)`` on the driver for every micro-batch."""
    return lambda writer: writer.foreachBatch(action)


def kafka_sink_options(
    servers: str, topic: str, options: Mapping[str, str] | None = None
) -> dict[str, str]:
    """Options of Spark's Kafka sink; security settings pass through unchanged."""
    return {"kafka.bootstrap.servers": servers, "topic": topic, **(options or {})}


def to_messages(
    servers: str,
    topic: str,
    encode: Callable[[DataFrame], DataFrame],
    options: Mapping[str, str] | None = None,
) -> Sink:
    """A topic; ``encode`` turns result rows into the columns of ``keyed_message``.

    Like any Kafka sink, it may send a message again after a failure.
    """
    chosen = kafka_sink_options(servers, topic, options)

    def send(rows: DataFrame, _: int) -> None:
        encode(rows).write.format("kafka").options(**chosen).save()

    return to_batches(send)


def keyed_message(df: DataFrame, key: Column | str, value: Column | str) -> DataFrame:
    """The two columns the Kafka sink wants: a text key and an encoded value."""
    key = F.col(key) if isinstance(key, str) else key
    value = F.col(value) if isinstance(value, str) else value
    return df.select(key.cast("string").alias("key"), value.alias("value"))


def long_messages(df: DataFrame) -> DataFrame:
    """Totals as messages: text key, 8-byte value."""
    return keyed_message(df, "key", codecs.long_to_bytes(F.col("value")))


def to_updates(path: str) -> Sink:
    """Table of update-mode results: the changed rows of each micro-batch, in its own folder.

    Keep ``path`` and the query's checkpoint together: batch numbers belong to both.  The
    table grows with every change; ``state_table`` reads the totals alone.
    """
    return to_batches(lambda rows, batch_id: Results(rows.sparkSession, path).write(rows, batch_id))


def to_nothing() -> Sink:
    """No output: the query's state is what is read."""
    return lambda writer: writer.format("noop")


TOTALS = StructType().add("key", "string").add("value", "long")


def latest_of_updates(
    spark: SparkSession,
    path: str,
    key: str = "key",
    value: str = "value",
    schema: StructType = TOTALS,
) -> DataFrame:
    """The table that the changed rows written by ``to_updates`` add up to."""
    return compact(Results(spark, path).read(schema), ["batch"], key, value)


def state_table(
    spark: SparkSession,
    checkpoint: str,
    key: str = "key",
    value: str = "value",
    batch: int | None = None,
    operator: int = 0,
) -> DataFrame:
    """The totals that a query of ``aggregates.grouped`` keeps in its state, as a table.

    They are those of its last complete micro-batch, or of an earlier ``batch`` that the
    checkpoint still has.  No second table of totals is needed; each state partition is read
    by a task.  ``operator`` is the number of the aggregate, if the query has several.
    """
    reader = spark.read.format("statestore").option("operatorId", operator)
    if batch is not None:
        reader = reader.option("batchId", batch)
    state = reader.load(checkpoint)
    total = state.schema["value"].dataType.fieldNames()[0]
    own = state.schema["key"].dataType.fieldNames()[0]
    return state.select(F.col("key")[own].alias(key), F.col("value")[total].alias(value))


def checkpoint(spark: SparkSession, name: str, root: str | None = None, reset: bool = False) -> str:
    """Where a query keeps its progress and state.

    The same ``root`` goes on from where the query stopped.  ``reset`` picks a
    folder never used before, so the query starts over; nothing is deleted.
    """
    if root is None or reset:
        return session.run_dir(spark, f"checkpoint-{name}")
    return f"{root.rstrip('/')}/{name}"


def start(
    df: DataFrame,
    sink: Sink,
    *,
    name: str,
    checkpoint: str,
    mode: str = "append",
    every: str | None = "10 seconds",
    partitions: int | None = None,
    settings: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Start a query; ``every=None`` handles what is there now and stops.

    Give each query its own name and checkpoint.  ``partitions`` is the number of
    state partitions, which a query keeps for life: about one per core that it
    will ever have.  Left out, the session's shuffle partitions are taken.
    ``settings`` of the session are set for this query alone.
    """
    writer = sink(df.writeStream.queryName(name).outputMode(mode))
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    chosen = dict(settings or {})
    if partitions is not None:
        chosen[session.SHUFFLE_PARTITIONS] = str(partitions)
    # A query takes the settings of the moment it starts.
    conf = df.sparkSession.conf
    before = {key: conf.get(key, None) for key in chosen}
    try:
        for key, value in chosen.items():
            conf.set(key, value)
        return writer.start()
    finally:
        for key, value in before.items():
            if value is None:
                conf.unset(key)
            else:
                conf.set(key, value)


def drain(query: StreamingQuery) -> StreamingQuery:
    """Wait for a query started with ``every=None``; raises if it failed."""
    query.awaitTermination()
    return query
