"""Tables that micro-batches write: one folder for each batch.

``Results`` collects what the batches put out; ``Carried`` hands on what the next batch
goes on from.  A batch that runs again, after its commit was lost, has the same records and
goes on from the same table, so it makes the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType


class _Folders:
    """Folders ``batch=N`` under a root, on whatever file system that is."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def folder(self, batch: int) -> str:
        return f"{self.root}/batch={batch}"

    def written(self, batch: int) -> bool:
        """Whether the batch's folder is complete."""
        return self._fs.exists(self._path(f"{self.folder(batch)}/_SUCCESS"))

    def exists(self) -> bool:
        return self._fs.exists(self._path(self.root))

    def batches(self) -> list[int]:
        """The numbers of the complete folders."""
        if not self.exists():
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(self.root))]
        found = sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))
        return [b for b in found if self.written(b)]

    def drop(self, batch: int) -> None:
        self._fs.delete(self._path(self.folder(batch)), True)


class Results:
    """The rows of all batches; ``batch`` tells them apart."""

    def __init__(self, spark: SparkSession, root: str):
        self._folders = _Folders(spark, root)

    def exists(self) -> bool:
        return self._folders.exists()

    def write(self, rows: DataFrame, batch: int) -> None:
        """Add the rows of a batch.  If it has them already, they stay, and readers miss nothing."""
        if not self._folders.written(batch):
            rows.write.mode("overwrite").parquet(self._folders.folder(batch))

    def read(self, schema: StructType) -> DataFrame:
        """The rows of all complete batches; none if there are none."""
        folders, spark = self._folders, self._folders.spark
        whole = StructType(list(schema.fields)).add("batch", LongType())
        paths = [folders.folder(b) for b in folders.batches()]
        if not paths:
            return spark.createDataFrame([], whole)
        return spark.read.schema(whole).option("basePath", folders.root).parquet(*paths)


class Carried:
    """A table that each batch reads as the one before left it, and leaves anew.

    It holds what is still open, and no more; the last ``KEEP`` versions are kept, as the
    last batch may run again.
    """

    KEEP = 2

    def __init__(self, spark: SparkSession, root: str, schema: StructType):
        self._folders, self.schema = _Folders(spark, root), schema

    def before(self, batch: int) -> DataFrame:
        """What the batches before left."""
        spark = self._folders.spark
        earlier = [b for b in self._folders.batches() if b < batch]
        if not earlier:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(self._folders.folder(earlier[-1]))

    def newest(self) -> str | None:
        """The folder of the last version."""
        found = self._folders.batches()
        return self._folders.folder(found[-1]) if found else None

    def leave(self, rows: DataFrame, batch: int) -> DataFrame:
        """What this batch leaves, in the order of the schema; it is returned as stored."""
        named = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema])
        folder = self._folders.folder(batch)
        named.write.mode("overwrite").parquet(folder)
        for old in self._folders.batches():
            if old <= batch - self.KEEP:
                self._folders.drop(old)
        return self._folders.spark.read.schema(self.schema).parquet(folder)
