from __future__ import annotations

import os
import sys
from datetime import datetime, timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark import session  # noqa: E402

START = datetime(2024, 1, 1)


@pytest.fixture(scope="session")
def spark():
    made = session.build(
        "tidemark-tests",
        master="local[4]",
        spark__sql__shuffle__partitions="2",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
    )
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()


def at(seconds: float) -> datetime:
    """An instant that many seconds into the test's day."""
    return START + timedelta(seconds=seconds)


def rows(df, *columns):
    """The rows as a sorted list of tuples."""
    found = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in found.collect()), key=repr)


class Feed:
    """A folder of Parquet files that a stream reads one file per micro-batch."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema, self.files = spark, str(path), schema, 0

    def add(self, *batch):
        for records in batch:
            target = f"{self.path}/{self.files:04d}.parquet"
            frame = self.spark.createDataFrame(records, self.schema).coalesce(1)
            frame.write.parquet(f"{self.path}-parts/{self.files:04d}")
            part = next(
                name
                for name in sorted(os.listdir(f"{self.path}-parts/{self.files:04d}"))
                if name.endswith(".parquet")
            )
            os.makedirs(self.path, exist_ok=True)
            os.link(f"{self.path}-parts/{self.files:04d}/{part}", target)
            # Files are taken in the order of their times.
            os.utime(target, (1_700_000_000 + self.files, 1_700_000_000 + self.files))
            self.files += 1
        return self

    def stream(self, per_trigger=1):
        return (
            self.spark.readStream.schema(self.schema)
            .option("maxFilesPerTrigger", per_trigger)
            .parquet(self.path)
        )

    def table(self):
        return self.spark.read.schema(self.schema).parquet(self.path)


@pytest.fixture
def feed(spark, tmp_path):
    made = []

    def make(schema):
        made.append(Feed(spark, tmp_path / f"feed{len(made)}", schema))
        return made[-1]

    return make
