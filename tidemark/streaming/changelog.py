"""Changelog of running totals on an unbounded stream: one row for each record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark import session
from tidemark.operators.aggregates import changelog, compact, measure
from tidemark.operators.running import HOT
from tidemark.operators.stateless import with_key
from tidemark.streaming import sinks
from tidemark.streaming.batches import Results

BLOCK = 1 << 20


def start_changelog(
    records: DataFrame,
    root: str,
    *,
    name: str,
    how: str = "sum",
    key: str = "key",
    value: str = "value",
    order: Sequence[str] = ("partition", "offset"),
    block_on: str = "offset",
    widths: Sequence[int] = (BLOCK, BLOCK * 1024),
    limit: int = HOT,
    every: str | None = "10 seconds",
    partitions: int | None = None,
) -> StreamingQuery:
    """Write every update of the total (sum or count) per key under ``root``, in record order.

    The totals are a grouped aggregate in Spark's own state: a micro-batch reads and
    writes the state of its own keys, and adds up before it shuffles.  What it puts out is
    its records and, beside them, the new totals of their keys.  A total less what the
    batch added is where the batch's changelog goes on from; that changelog is the one for
    tables, which cuts keys of more than ``limit`` records in a batch into blocks.

    A batch that is run again goes on from the same state; its rows, if they are there
    already, stay.  The query's checkpoint also lies under ``root``, since totals and
    progress belong together.  Records must come in order within a partition.
    """
    if how not in ("sum", "count"):
        raise ValueError(f"a stream's changelog is of sums or counts, not of {how}")
    spark = records.sparkSession
    shape = changelog(spark.createDataFrame([], records.schema), how, key, value, value, order, block_on).schema
    # Readers find the schema here before there is a batch.
    spark.createDataFrame([], shape).write.mode("overwrite").parquet(f"{root}/schema")

    def both(rows: DataFrame) -> list:
        """The total, and of how many values: a sum of none is not zero."""
        counted = F.count(value) if how == "sum" else F.count(F.lit(1))
        return [measure(how, value).alias("total"), counted.alias("values")]

    keyed = with_key(records, key)
    totals = keyed.groupBy(key).agg(*both(keyed))
    tagged = keyed.select(key, F.struct(*records.columns).alias("record"))
    out = tagged.unionByName(totals, allowMissingColumns=True)

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        conf = spark.conf
        usual = conf.get(session.SHUFFLE_PARTITIONS)
        batch = batch.persist()
        try:
            with session.scratch(spark):
                rows = batch.where("record IS NOT NULL").select("record.*")
                fresh = rows.groupBy(key).agg(*both(rows), F.count(F.lit(1)).alias("records"))
                fresh = fresh.select(key, *[F.col(c).alias(f"new_{c}") for c in ("total", "values")], "records")
                after = batch.where("record IS NULL").select(key, "total", "values")
                known = session.written(after.join(fresh, key), "totals")
                # The query's partitions are for its state; a large batch is cut into more.
                found = known.agg(F.sum("records")).first()[0] or 0
                conf.set(session.SHUFFLE_PARTITIONS, str(max(int(usual), found // BLOCK)))
                start = known.where(F.col("values") > F.col("new_values")).select(
                    key, (F.col("total") - F.coalesce("new_total", F.lit(0))).alias(value)
                )
                hot = session.written(known.where(F.col("records") > limit).select(key), "hot-keys")
                updates = changelog(
                    rows, how, key, value, value, order, block_on=block_on, widths=widths, hot=hot, start=start
                )
                Results(spark, f"{root}/changelog").write(updates, batch_id)
        finally:
            conf.set(session.SHUFFLE_PARTITIONS, usual)
            batch.unpersist()

    return sinks.start(
        out,
        sinks.to_batches(run_batch),
        name=name,
        checkpoint=f"{root}/progress",
        mode="update",
        every=every,
        partitions=partitions,
    )


def _schema(spark: SparkSession, root: str) -> StructType:
    return spark.read.parquet(f"{root}/schema").schema


def read_changelog(spark: SparkSession, root: str) -> DataFrame:
    """All updates of the complete batches so far; ``batch`` is the batch's number."""
    return Results(spark, f"{root}/changelog").read(_schema(spark, root))


def changelog_table(
    spark: SparkSession,
    root: str,
    order: Sequence[str] = ("partition", "offset"),
    key: str = "key",
    value: str = "value",
) -> DataFrame:
    """Latest total per key according to the updates written so far.

    ``order`` is that of ``start_changelog``; it holds within a batch, and batches
    come one after the other.
    """
    return compact(read_changelog(spark, root), ["batch", *order], key, value)


def totals_table(spark: SparkSession, root: str, key: str = "key", value: str = "value") -> DataFrame:
    """The same table as the query's state holds it, without its updates."""
    return sinks.state_table(spark, f"{root}/progress", key, value)
