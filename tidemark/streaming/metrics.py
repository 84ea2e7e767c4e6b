"""What ``stateless.peek`` counts on a stream, as a table with rows for each micro-batch.

``observe`` counts while records pass; the counts reach the driver with the progress of each
micro-batch, a few numbers whatever the batch holds.  ``Recorder`` is the listener that takes
them and writes them down.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from tidemark.streaming.batches import Results

SCHEMA = "query string, run string, batch long, input_rows long, name string, metric string, value long"


class Recorder(StreamingQueryListener):
    """Keeps the observed counts of every query it is added for, and stores them on ``flush``.

    Add it before the queries start: ``recorder = Recorder(spark, root).add()``.  Progress of a
    batch comes after its commit, so a batch whose run was lost is counted once, when it has
    run again.  ``flush`` writes what has come since the last one; the driver holds no more.
    """

    def __init__(self, spark: SparkSession, root: str, names: Sequence[str] | None = None):
        self._spark, self.root = spark, root
        self._names = set(names) if names is not None else None
        self._rows: list[tuple] = []
        self._lock = threading.Lock()

    def add(self) -> Recorder:
        self._spark.streams.addListener(self)
        return self

    def remove(self) -> Recorder:
        self._spark.streams.removeListener(self)
        return self

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = json.loads(event.progress.json)
        if self._names is not None and progress["name"] not in self._names:
            return
        place = (progress["name"], progress["runId"], progress["batchId"], progress["numInputRows"])
        found = [
            (*place, name, metric, value)
            for name, counts in progress.get("observedMetrics", {}).items()
            for metric, value in counts.items()
            if isinstance(value, int)
        ]
        with self._lock:
            self._rows += found

    def flush(self) -> DataFrame:
        """Write what has come, and return all counts written so far."""
        # Progress is reported behind the batches: wait for what has been sent.
        self._spark._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            self._spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.root)
        return self.counts()

    def counts(self) -> DataFrame:
        """The counts written so far; a batch reported twice counts once."""
        if not Results(self._spark, self.root).exists():
            return self._spark.createDataFrame([], SCHEMA)
        return self._spark.read.schema(SCHEMA).parquet(self.root).dropDuplicates(["query", "batch", "name", "metric"])
