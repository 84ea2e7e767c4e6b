"""Several results from one source."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.streaming import sinks


def tagged_union(branches: Mapping[str, DataFrame]) -> DataFrame:
    """All branches below each other, ``branch`` telling them apart; gaps are null."""
    tagged = [df.withColumn("branch", F.lit(name)) for name, df in branches.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def each_batch(branches: Mapping[str, Callable[[DataFrame, int], None]]) -> sinks.Sink:
    """Sink that gives every micro-batch to several writers, reading it once."""

    def write(rows: DataFrame, batch_id: int) -> None:
        rows = rows.persist()
        try:
            for action in branches.values():
                action(rows, batch_id)
        finally:
            rows.unpersist()

    return sinks.to_batches(write)
