"""Near copies among embeddings by a pivot-permutation index, verified by exact cosine.

A vector is described by its NEAREST nearest reference points, in order.  Vectors meet in
inverted lists; a list's key is SHARED reference points at once, so two vectors in one list
share at least so many of their nearest.  That is the shared-pivot count, kept in the key:
lists of single points would grow with the square of a dense region.  Lists over BLOCK
vectors are cut into blocks that meet pairwise, each pair of blocks in a task's memory only;
what leaves it is one row per vector, its links and the least of its group, never pairs.

A pair that meets in several lists is verified in one: that of the SHARED least
reference points it has in common.  Cosines are in double precision.

Reference points are rows of the table, PIVOTS at most, chosen farthest-first from SAMPLE rows
by a hash of vec_id; none is nearer than APART to another, so that a large group of near copies
has one of them and its members agree on the others.  Every vector is indexed, each dimension by
itself.  Vectors that are null, of length zero, or that hold nulls or non-finite numbers link
with nothing.  Equal vectors are linked like others.  Rows
that repeat a vec_id are one node; links between them do not count.  A null vec_id is a
component of its own and links with nothing.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

PIVOTS = 256
SAMPLE = 4096
APART = 0.9
NEAREST = 7
SHARED = 3
BLOCK = 256
LEAST = 0.95


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and the vector in doubles, of those that can link at all."""
    values = F.col(vector_col).cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    picked = vectors.select(F.col(id_col).cast("long").alias("vec_id"), values.alias("v"))
    picked = picked.where("vec_id is not null and v is not null").where(F.size("v") > 0)
    kept = picked.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    del finite
    return kept.where(F.exists("v", lambda x: x != 0.0))


def unit(v: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that squares stay in range."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def spread(sample: np.ndarray, most: int, apart: float = APART) -> np.ndarray:
    """Rows of a sample, each the farthest from those before; none nearer than `apart` to another."""
    chosen = [0]
    nearest = sample @ sample[0]
    while len(chosen) < most:
        i = int(np.argmin(nearest))
        if nearest[i] > apart:
            break
        chosen.append(i)
        nearest = np.maximum(nearest, sample @ sample[i])
    return sample[chosen]


def permutations(v: np.ndarray, pivots: np.ndarray, nearest: int) -> np.ndarray:
    """The nearest reference points of each row, the nearest first; ties by their number."""
    near = min(nearest, len(pivots))
    return np.argsort(-(v @ pivots.T), axis=1, kind="stable")[:, :near]


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _cell(vec_ids: np.ndarray, side: np.ndarray, tops: np.ndarray, v: np.ndarray, key: list[int], same: bool, least: float):
    """Links of one pair of blocks: (vec_id, links, least vec_id of its group here)."""
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if same:
        right = left
    if not len(left) or not len(right):
        return []
    # Reference points below the key's largest, the key's own aside: a pair that has one
    # in common belongs to another list.
    width = int(tops.max()) + 1
    low = np.zeros((len(tops), width), np.float32)
    np.put_along_axis(low, tops, 1, axis=1)
    low[:, key] = 0
    low = low[:, : max(key)]
    linked = (v[left] @ v[right].T) >= least
    linked &= vec_ids[left][:, None] != vec_ids[right][None, :]
    linked &= (low[left] @ low[right].T) == 0
    links: dict[int, int] = {}
    group: dict[int, int] = {}

    def root(x: int) -> int:
        while group.setdefault(x, x) != x:
            group[x] = group[group[x]]
            x = group[x]
        return x

    for i in np.flatnonzero(linked.any(axis=1)):
        a = int(vec_ids[left[i]])
        others = vec_ids[right[linked[i]]].tolist()
        links[a] = links.get(a, 0) + len(others)
        for b in others:
            if not same:
                links[b] = links.get(b, 0) + 1
            ra, rb = root(a), root(b)
            if ra != rb:
                group[max(ra, rb)] = min(ra, rb)
    return [(x, n, root(x)) for x, n in links.items()]


def linked(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    least: float = LEAST,
    pivots: int = PIVOTS,
) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one per row of the table."""
    spark = vectors.sparkSession
    good = common.store(usable(vectors, id_col, vector_col).dropDuplicates(["vec_id"]), "vectors")
    chosen = {}
    for size in sorted(r["size"] for r in good.select(F.size("v").alias("size")).distinct().collect()):
        sample = good.where(F.size("v") == size).orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE)
        chosen[size] = spread(unit(_matrix(sample.select("v").toArrow().column(0).combine_chunks())), pivots)
    out = vectors.select(F.col(id_col).cast("long").alias("vec_id"))
    if not chosen:
        zero = F.lit(0).cast("long")
        return out.select("vec_id", zero.alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    shared_pivots = spark.sparkContext.broadcast(chosen)

    def picked(points: int) -> list[tuple[int, ...]]:
        """Which of the nearest make a key; so few points that all are near make one."""
        return list(itertools.combinations(range(min(NEAREST, points)), SHARED if points > NEAREST else points))

    def describe(batch: pa.RecordBatch):
        sizes = batch.column(1).value_lengths().to_numpy()
        for size in np.unique(sizes).tolist():
            part = batch.filter(pa.array(sizes == size))
            points = shared_pivots.value[size]
            v = unit(_matrix(part.column(1)))
            tops = np.sort(permutations(v, points, NEAREST), axis=1)
            picks = np.array(picked(len(points)))
            # The least reference point below the key's largest that the key leaves out, if any.
            spare = [next((x for x in range(p[-1]) if x not in p), None) for p in picks.tolist()]
            lows = np.stack([np.full(len(v), -1) if x is None else tops[:, x] for x in spare], axis=1)
            keys = np.zeros((len(v), len(picks)), np.int64)
            for i in range(picks.shape[1]):
                keys = keys * len(points) + tops[:, picks[:, i]]
            lists, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(list(v), pa.list_(pa.float64())),
                    pa.array(list(tops), lists),
                    pa.array(list(keys), lists),
                    pa.array(list(lows.astype(np.int32)), ints),
                ],
                names=["vec_id", "v", "tops", "keys", "lows"],
            )

    indexed = common.store(
        common.in_batches(
            good, describe, "vec_id long, v array<double>, tops array<long>, keys array<long>, lows array<int>", rows=2048
        ),
        "indexed",
    )
    zipped = F.inline(F.arrays_zip(F.col("keys").alias("key"), F.col("lows").alias("low")))
    postings = indexed.select("vec_id", F.size("v").alias("size"), zipped)
    # Where all of a list share one more reference point, another list verifies their pairs.
    lists = postings.groupBy("size", "key").agg(F.count("*").alias("k"), F.min("low").alias("a"), F.max("low").alias("b"))
    lists = lists.where("k > 1 and (a < 0 or a <> b)").drop("a", "b")
    # A long list becomes blocks; each vector goes to the pairs of blocks that its own is in.
    block = F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")
    cells = (
        postings.join(lists, ["size", "key"])
        .withColumn("blocks", F.ceil(F.col("k") / BLOCK).cast("int"))
        .withColumn("own", block)
        .select("vec_id", "size", "key", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .select(
            "vec_id",
            "size",
            "key",
            F.least("own", "other").alias("x"),
            F.greatest("own", "other").alias("y"),
            (F.col("own") > F.col("other")).cast("int").alias("side"),
        )
    )
    members = F.collect_list(F.struct("vec_id", "side", "tops", "v"))
    grouped = cells.join(indexed.select("vec_id", "tops", "v"), "vec_id")
    grouped = grouped.groupBy("size", "key", "x", "y").agg(members.alias("members"))

    def verify(batch: pa.RecordBatch):
        rows = []
        column = batch.column(4)
        flat = column.flatten()
        ids, side = flat.field(0).to_numpy(), flat.field(1).to_numpy()
        tops, v = flat.field(2), flat.field(3)
        at = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())])
        for i, (size, key, x, y) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True)):
            part, n = slice(at[i], at[i + 1]), at[i + 1] - at[i]
            points = len(shared_pivots.value[size])
            digits = []
            for _ in picked(points)[0]:
                digits.append(key % points)
                key //= points
            rows += _cell(
                ids[part], side[part], _matrix(tops.slice(at[i], n)), _matrix(v.slice(at[i], n)), digits, x == y, least
            )
        columns = zip(*rows, strict=True) if rows else [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["vec_id", "links", "root"])

    found = common.store(common.in_batches(grouped, verify, "vec_id long, links long, root long", rows=64), "links-found")
    counts = found.groupBy(F.col("vec_id").alias("node")).agg(F.sum("links").alias("links"))
    roots = common.components(found.select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    joined = out.join(counts, out.vec_id == counts.node, "left").drop("node")
    joined = joined.join(roots, F.col("vec_id") == F.col("node"), "left")
    component = F.coalesce("root", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
