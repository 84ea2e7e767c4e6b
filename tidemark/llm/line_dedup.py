"""Delete runs of lines that an earlier document, or an earlier place, has already.

A window is the least run of lines from a line on, or up to a line, that has WORDS words, so
every line of a run of WORDS words or more lies in a window within it.  Within a window, the least
hash among its grams, runs of GRAM words, is selected as fingerprint; windows with the same
content select the same one.  Places are joined by fingerprint and window to the first such
place, in order of doc_id and then of lines; the match is extended line by line both ways,
and its later side is deleted.  So all lines of a run of WORDS words or more that stands
earlier, in whichever document, are deleted, and no shorter run ever is.

Of each deleted line an equal one stays.  Lines are compared as they are.  A null text stays
null.  A null doc_id comes first.  Rows that repeat a doc_id are told apart by their text; rows
equal in both are one document.  A column n_deleted of the input gives way to the result's.  A document that is wholly deleted keeps its row, with empty text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

WORDS = 50
GRAM = 25


def _ends(sums: np.ndarray, least: int) -> np.ndarray:
    """Last line of the least run from each line that has so many words; the length if none."""
    before = np.concatenate([[0], sums[:-1]])
    return np.searchsorted(sums, before + least)


def fingerprints(hashes: np.ndarray, words: np.ndarray) -> list[tuple[int, int, int]]:
    """(first line, selected gram, window content) for each window."""
    sums = np.cumsum(words)
    n = len(hashes)
    if not n or sums[-1] < WORDS:
        return []
    data = np.ascontiguousarray(hashes).tobytes()

    def content(a: int, b: int) -> int:
        return xxhash.xxh3_64_intdigest(data[8 * a : 8 * b + 8]) - (1 << 63)

    gram_ends = _ends(sums, GRAM)
    grams = [content(i, e) if e < n else 0 for i, e in enumerate(gram_ends.tolist())]
    gram_ends = gram_ends.tolist()
    spans = {(i, e) for i, e in enumerate(_ends(sums, WORDS).tolist()) if e < n}
    # The last line from which up to this one there are so many words.
    starts = np.searchsorted(np.concatenate([[0], sums[:-1]]), sums - WORDS, side="right") - 1
    spans |= {(i, e) for e, i in enumerate(starts.tolist()) if i >= 0}
    out = []
    for i, e in sorted(spans):
        least = min(grams[k] for k in range(i, e + 1) if gram_ends[k] <= e)
        out.append((i, least, content(i, e)))
    return out


def _described(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, mark, line hashes, words per line, and the fingerprints."""

    def run(batch: pa.RecordBatch):
        hashes, words, places, grams, windows = [], [], [], [], []
        for text in batch.column(2).to_pylist():
            lines = text.split("\n")
            h = np.array([xxhash.xxh3_64_intdigest(x) for x in lines], np.uint64).view(np.int64)
            w = np.array([len(x.split()) for x in lines], np.int32)
            found = fingerprints(h, w)
            hashes.append(h)
            words.append(w)
            for column, values in zip((places, grams, windows), zip(*found, strict=True) if found else ((), (), ()), strict=True):
                column.append(values)
        longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
        columns = [
            batch.column(0),
            batch.column(1),
            pa.array(hashes, longs),
            pa.array(words, ints),
            pa.array(places, ints),
            pa.array(grams, longs),
            pa.array(windows, longs),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "mark", "lines", "words", "at", "gram", "window"])

    picked = _keyed(docs, id_col, text_col).where("text is not null")
    schema = "doc_id long, mark long, lines array<long>, words array<int>, at array<int>, gram array<long>, window array<long>"
    return common.in_batches(picked, run, schema, rows=1024)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("mark"), F.col(text_col).alias("text"))


def _extended(batch: pa.RecordBatch):
    """Lines of the later document that lie in a match with the earlier one."""
    doc_ids, marks, deleted = [], [], []
    for row in batch.to_pylist():
        lines, earlier, words = row["lines"], row["earlier"], row["words"]
        same = row["same"]
        gone: set[int] = set()
        done: dict[int, int] = {}
        for place in sorted(row["places"], key=lambda p: p["at"]):
            at, first = place["at"], place["first"]
            shift = at - first
            if at < done.get(shift, -1):
                continue
            a = at
            while a > 0 and a - shift > 0 and lines[a - 1] == earlier[a - 1 - shift]:
                a -= 1
            b = at
            while b < len(lines) and b - shift < len(earlier) and lines[b] == earlier[b - shift]:
                b += 1
            done[shift] = b
            if (not same or shift > 0) and sum(words[a:b]) >= WORDS:
                gone.update(range(a, b))
        if gone:
            doc_ids.append(row["doc_id"])
            marks.append(row["mark"])
            deleted.append(sorted(gone))
    yield pa.RecordBatch.from_arrays(
        [pa.array(doc_ids, pa.int64()), pa.array(marks, pa.int64()), pa.array(deleted, pa.list_(pa.int32()))],
        names=["doc_id", "mark", "deleted"],
    )


def _matches(described: DataFrame) -> DataFrame:
    """Rows (doc_id, mark, deleted): line numbers from 0, of documents that lose some."""
    places = described.select("doc_id", "mark", F.inline(F.arrays_zip("at", "gram", "window")))
    key = F.struct("doc_id", "mark", "at")
    # One row per window and task is shuffled, however many places have it.
    first = places.groupBy("gram", "window").agg(F.min(key).alias("first"), F.count("*").alias("k")).where("k > 1")
    later = (
        places.join(first.drop("k"), ["gram", "window"])
        .where(key > F.col("first"))
        .groupBy("doc_id", "mark", F.col("first.doc_id").alias("f_id"), F.col("first.mark").alias("f_mark"))
        .agg(F.collect_set(F.struct("at", F.col("first.at").alias("first"))).alias("places"))
    )
    own = described.select(F.col("doc_id").alias("o_id"), F.col("mark").alias("o_mark"), "lines", "words").dropDuplicates(["o_id", "o_mark"])
    theirs = own.select(F.col("o_id").alias("t_id"), F.col("o_mark").alias("t_mark"), F.col("lines").alias("earlier"))

    def same(a: str, b: str, c: str, d: str) -> Column:
        return F.col(a).eqNullSafe(F.col(b)) & (F.col(c) == F.col(d))

    paired = later.join(own, same("doc_id", "o_id", "mark", "o_mark")).join(theirs, same("f_id", "t_id", "f_mark", "t_mark"))
    paired = paired.select(
        "doc_id", "mark", "places", "lines", "words", "earlier", same("doc_id", "f_id", "mark", "f_mark").alias("same")
    )
    found = common.in_batches(paired, _extended, "doc_id long, mark long, deleted array<int>", rows=1024)
    return found.groupBy("doc_id", "mark").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("deleted")))).alias("deleted"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All documents and columns, texts without their later repeated runs; adds n_deleted lines."""
    described = common.store(_described(docs, id_col, text_col), "lines")
    lost = common.store(_matches(described), "repeated-lines")
    common.free(docs.sparkSession)
    own_id, own_mark, own_slot, gone = common.unused(docs, "_id", "_mark", "_slot", "_deleted")
    lost = lost.select(F.col("doc_id").alias(own_id), F.col("mark").alias(own_mark), F.col("deleted").alias(gone))
    text = F.col(f"`{text_col}`")
    slot = F.pmod(F.xxhash64(text), F.lit(common.BITS))
    bits = docs.sparkSession.sparkContext.broadcast(common.bitmap_of(lost.select((F.pmod(own_mark, F.lit(common.BITS))).alias("slot"))))

    def split(chosen: bool) -> DataFrame:
        """Rows whose text may have been found, or those whose text has certainly not."""

        def run(batch: pa.RecordBatch):
            mask = common.perhaps(bits.value, batch.column(0).to_numpy())
            yield batch.select(range(1, batch.num_columns)).filter(pa.array(mask == chosen, pa.bool_()))

        return common.in_batches(docs.select(slot.alias(own_slot), "*"), run, docs.schema, rows=1024)

    # Only texts that may lose lines are shuffled.
    same = F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(own_id)) & (F.xxhash64(text) == F.col(own_mark))
    left = F.filter(F.split(text, "\n", -1), lambda line, i: ~F.array_contains(gone, i))
    changed = split(True).join(lost, same, "left")
    changed = changed.withColumn(text_col, F.when(F.col(gone).isNull(), text).otherwise(F.array_join(left, "\n")))
    changed = changed.withColumn("n_deleted", F.coalesce(F.size(gone), F.lit(0)).cast("long"))
    columns = [*[F.col(f"`{c}`") for c in docs.columns if c != "n_deleted"], F.col("n_deleted")]
    return changed.select(columns).unionAll(split(False).withColumn("n_deleted", F.lit(0).cast("long")).select(columns))
