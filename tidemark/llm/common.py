"""Helpers of this subpackage: stored tables, word hashes, bounded filters, components."""

from __future__ import annotations

import gc
import io
import os
import posixpath
import zipfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidemark import session
from tidemark.llm import chunks

PIECE = 1 << 17  # bytes of text hashed at a time


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a result to the shared folder and read it back; survives lost executors."""
    return session.written(df, name)


def free(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of jobs whose results are stored.

    It does so when the driver's garbage is collected, which may otherwise take long.
    """
    gc.collect()
    spark._jvm.System.gc()


def discard(df: DataFrame) -> None:
    """Delete a table made by `store` once nothing reads it any more."""
    spark = df.sparkSession
    shared = session.shared_dir(spark)
    jvm = spark._jvm
    for folder in {posixpath.dirname(f) for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        if posixpath.basename(shared) not in folder:
            raise ValueError(f"{folder} is not in the shared folder")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of the table has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        found.append(name)
    return found


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a shared path, and the path within it."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application."""
    # Rows are whole texts here: a batch of Spark's fixed default, 10000, would be large.
    if int(spark.conf.get(BATCH)) == 10_000:
        spark.conf.set(BATCH, "1000")
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(session.__file__))
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(package)))
    target = session.run_dir(spark, "package") + ".zip"
    fs, path = filesystem(target)
    fs.create_dir(posixpath.dirname(path), recursive=True)
    with fs.open_output_stream(path) as out:
        out.write(held.getvalue())
    context.addPyFile(target)
    _shipped.add(context.applicationId)


def narrow(batch: pa.RecordBatch, rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Slices of few rows, so that what is made of them stays small."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def in_batches(
    df: DataFrame, function: Callable, schema: str | StructType, rows: int = 4096, keeps: bool = False
) -> DataFrame:
    """`mapInArrow` for a function from one record batch to several.

    Spark takes no column names with dots there: such tables go through under numbers.
    Workers serve one stage after the other: what an encoder of an earlier one has kept in them
    (``chunks.kept``) is let go of, unless this function says that it ``keeps`` things itself.
    """
    ship(df.sparkSession)
    shape = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    numbered = any("." in name or "`" in name for name in [*df.columns, *shape.names])
    names = [f"_{i}" for i in range(len(shape))]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if keeps:
            chunks.spare()
        else:
            chunks.release()
        for batch in batches:
            for part in narrow(batch, rows):
                for made in function(part):
                    yield pa.RecordBatch.from_arrays(made.columns, names=names) if numbered else made

    if not numbered:
        return df.mapInArrow(run, schema)
    plain = StructType([StructField(n, f.dataType) for n, f in zip(names, shape.fields, strict=True)])
    return df.toDF(*[f"_{i}" for i in range(len(df.columns))]).mapInArrow(run, plain).toDF(*shape.names)


def in_groups(df: DataFrame, keys: list[str], function: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """`applyInArrow` for a function from the rows of a group to others; a group must fit a worker."""
    ship(df.sparkSession)

    def run(rows: pa.Table) -> pa.Table:
        return function(rows.combine_chunks())

    return df.groupBy(*keys).applyInArrow(run, schema)


# Odd constants for mixing; any others would do.
_R = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.array(
    [0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB],
    dtype=np.uint64,
)
_powers = np.full(1, _R)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _hash_blob(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word of a text in bytes; A-Z lower-cased."""
    global _powers
    data = np.frombuffer(blob, np.uint8)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64), starts
    lengths = ends - starts
    if lengths.max() > len(_powers):
        _powers = np.cumprod(np.full(int(lengths.max()) * 2, _R, np.uint64))
    data = data[inside]
    data = data + (((data >= 65) & (data <= 90)) * np.uint8(32))
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(data)) - np.repeat(first, lengths)
    values = (data.astype(np.uint64) + np.uint64(1)) * _powers[place]
    hashes = np.add.reduceat(values, first)
    return mix(hashes + lengths.astype(np.uint64) * _ODD[0]), starts


def cut(text: bytes) -> Iterator[bytes]:
    """Pieces of a long text, cut after white space."""
    at = 0
    while len(text) - at > PIECE:
        end = at + PIECE
        while end < len(text) and text[end] not in b" \t\n\v\f\r":
            end += 1
        yield text[at:end]
        at = end
    yield text[at:]


def hash_bytes(data: bytes) -> np.ndarray:
    """Hashes of the words of UTF-8 bytes."""
    return _hash_blob(data)[0]


def small_hash(value: str | None) -> int:
    return 0 if value is None else xxhash.xxh3_64_intdigest(value) >> 1


def hashed_words(texts: list[str | None]) -> Iterator[np.ndarray]:
    """64-bit hashes of each text's words `[^\\x20\\x09-\\x0D]+`, A-Z lower-cased.

    Long texts are hashed piece by piece; a null text has no words.
    """
    return hashed_bytes(b"" if text is None else text.encode() for text in texts)


def hashed_bytes(texts: Iterable[bytes]) -> Iterator[np.ndarray]:
    """The same for texts in UTF-8."""
    group: list[bytes] = []
    size = 0

    def flush() -> Iterator[np.ndarray]:
        hashes, starts = _hash_blob(b"\n".join(group))
        bounds = np.cumsum([0] + [len(t) + 1 for t in group])
        at = np.searchsorted(starts, bounds)
        for i in range(len(group)):
            yield hashes[at[i] : at[i + 1]]

    for data in texts:
        if group and size + len(data) > PIECE:
            yield from flush()
            group, size = [], 0
        if len(data) > PIECE:
            yield np.concatenate([_hash_blob(piece)[0] for piece in cut(data)])
        else:
            group.append(data)
            size += len(data)
    if group:
        yield from flush()


def _rolled(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word shingles, in their order."""
    n = len(words) - k + 1
    total = np.full(n, k, np.uint64)
    for i in range(k):
        total ^= words[i : i + n]
        total *= _ODD[i % 5]
        total ^= total >> np.uint64(29)
    return mix(total)


def _distinct(hashes: np.ndarray) -> np.ndarray:
    found = np.sort(hashes)
    fresh = np.empty(len(found), bool)
    fresh[0] = True
    np.not_equal(found[1:], found[:-1], out=fresh[1:])
    return found[fresh]


def shingles(words: np.ndarray, k: int = 5) -> np.ndarray:
    """Sorted distinct hashes of k-word shingles; fewer words make one shingle."""
    if not len(words):
        return np.empty(0, np.uint64)
    return _distinct(_rolled(words, min(k, len(words))))


def shingled(texts: Iterable[np.ndarray], k: int = 5) -> Iterator[np.ndarray]:
    """The same for the words of each of many texts; those of several texts are hashed at a time."""
    group: list[np.ndarray] = []
    size = 0

    def flush() -> Iterator[np.ndarray]:
        words = np.concatenate([np.empty(0, np.uint64), *group])
        rolled = _rolled(words, k) if len(words) >= k else words
        at = 0
        for each in group:
            # Shingles that reach into the next text are in none.
            yield _distinct(rolled[at : at + len(each) - k + 1]) if len(each) >= k else shingles(each, k)
            at += len(each)

    for words in texts:
        group.append(words)
        size += len(words)
        if size > PIECE // 8:
            yield from flush()
            group, size = [], 0
    yield from flush()


# --- filters of a fixed size ------------------------------------------------

BITS = 1 << 26  # eight megabytes, whatever the data


def bitmap(df: DataFrame, column: str) -> np.ndarray:
    """A bitmap of fixed size with one bit set for each value of a long column.

    Never more than BITS / 64 rows reach the driver.  A value may share its bit with
    another, so a set bit means "perhaps".
    """
    return bitmap_of(df.where(F.col(column).isNotNull()).select(slot_of(column).alias("slot")))


def bitmap_of(slots: DataFrame) -> np.ndarray:
    """The bitmap of a table with one column `slot`."""
    rows = (
        slots.groupBy(F.shiftright("slot", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits"))
        .toArrow()
    )
    words = np.zeros(BITS // 64, np.int64)
    words[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return words


def perhaps(words: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Which slots, made by `slot_of`, have their bit set."""
    return (words[slots >> 6] >> (slots & 63)) & 1 == 1


def slot_of(column: str):
    """The slot of a long column in `bitmap`."""
    return F.pmod(F.xxhash64(F.col(column)), F.lit(BITS))


# --- components -------------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """Components of undirected links (a long, b long): rows (node, root), root the least node.

    Alternates large-star and small-star steps (Kiveris et al., 2014): the links of a
    component become a star around its least node after a number of rounds that grows
    with the logarithm of its size.  Minima are taken before the shuffle, so a node
    with very many links costs a row per task.  Nodes without links are left out.
    """
    edges = store(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    seen = None
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        least = least.select("n", F.least("n", "m").alias("m"))
        large = (
            both.join(least, both.a == least.n)
            .where("b > a and b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        least = large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        small = (
            large.join(least, large.a == least.n)
            .select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e"))
            .select("e.a", F.col("e.m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        after = store(small, "links")
        state = after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        discard(edges)
        edges = after
        if state == seen:
            break
        seen = state
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)


def require(spark: SparkSession) -> None:
    """Times without zones mean UTC in every operator here."""
    session.configure(spark)
