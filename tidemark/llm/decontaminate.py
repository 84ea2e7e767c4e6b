"""Find benchmark items in documents: windows of ten words, with DataFrame functions only.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after A-Z are lower-cased.  An item's windows
are its runs of ten words, or all its words if it has fewer.  Their hashes are a set that is
broadcast, up to MOST of them, and joined by a shuffle beyond.  Every window of a document, of
ten words and of each shorter length that an item has, is hashed and looked up in the set; only
its place and hash go on.  Where hashes are met, the texts are read again and the words compared.

Documents and items that are null or without words have no windows.  Rows that repeat a
doc_id count by themselves unless their texts are equal, when they get the same result.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

WINDOW = 10
MOST = 500_000  # windows whose hashes are broadcast, 12 bytes each

# What stands between words, and the characters of a word before lower-casing.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased and nothing else; plain ASCII texts take a shorter way."""
    plain = F.octet_length(text) == F.char_length(text)
    whole = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(plain, F.lower(text)).otherwise(whole)


def split_words(text: Column) -> Column:
    """The words of a text, and an empty piece before or after them where separators stand there.

    Splitting is several times as fast as collecting matches; no word is empty.
    """
    return F.split(text, SEPARATORS, -1)


def words(text: Column) -> Column:
    return F.filter(split_words(lower_ascii(text)), lambda w: w != "")


def count_words(text: Column) -> Column:
    pieces = split_words(text)
    ends = [(F.element_at(pieces, i) == "").cast("int") for i in (1, -1)]
    return F.greatest(F.size(pieces) - ends[0] - ends[1], F.lit(0)).cast("long")


def windows(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (item_id, length, run, hash): the items' windows."""
    listed = items.select(F.col(id_col).alias("item_id"), words(F.col(text_col)).alias("w")).where("size(w) > 0")
    listed = listed.withColumn("length", F.least(F.size("w"), F.lit(WINDOW)))
    starts = F.sequence(F.lit(1), F.size("w") - F.col("length") + 1)
    runs = listed.select("item_id", "length", F.explode(F.transform(starts, lambda i: F.slice("w", i, F.col("length")))).alias("run"))
    return runs.distinct().withColumn("hash", F.xxhash64("run"))


def _hashed(docs: DataFrame, lengths: list[int], text_col: str) -> DataFrame:
    """Rows (doc_id, mark, length, at, hash): every window of those lengths of every text."""
    texts = docs.select("doc_id", "mark", F.explode(F.array(words(F.col(text_col)))).alias("w"))

    def hashes(length: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size("w") - length + 1, F.lit(1)))
        found = F.transform(starts, lambda i: F.xxhash64(F.slice("w", i, F.lit(length))))
        return F.struct(F.lit(length).alias("length"), F.when(F.size("w") >= length, found).alias("hashes"))

    by_length = texts.select("doc_id", "mark", F.inline(F.array(*map(hashes, lengths))))
    spread = by_length.select("doc_id", "mark", "length", F.posexplode("hashes").alias("i", "hash"))
    return spread.select("doc_id", "mark", "length", (F.col("i") + 1).alias("at"), "hash")


def hits(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Rows (doc_id, mark, at, length, item_id): where windows of items occur, in words from 1.

    `mark` is a hash of the text; it tells rows with one doc_id apart.
    """
    known = common.store(windows(items, item_id_col, item_text_col), "windows")
    lengths = sorted(r["length"] for r in known.select("length").distinct().collect())  # WINDOW at most
    texts = docs.where(F.col(f"`{text_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.xxhash64(F.col(f"`{text_col}`")).alias("mark"),
        F.col(f"`{text_col}`").alias("text"),
    )
    if not lengths:
        return texts.select("doc_id", "mark", F.lit(0).alias("at"), F.lit(0).alias("length"), F.lit(None).alias("item_id")).limit(0)
    wanted = known.select("length", "hash").distinct()
    if known.count() <= MOST:
        wanted = F.broadcast(wanted)
    met = common.store(_hashed(texts, lengths, "text").join(wanted, ["length", "hash"]).distinct(), "windows-met")
    # Whether the words are the same: only texts in which a hash was met are read for that.
    where = met.groupBy("doc_id", "mark").agg(F.collect_set(F.struct("at", "length", "hash")).alias("met"))
    where = where.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), "met")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark"))
    found = texts.join(where, same).select("doc_id", "mark", "met", F.explode(F.array(words(F.col("text")))).alias("w"))
    runs = F.transform("met", lambda m: F.struct(m["at"], m["length"], m["hash"], F.slice("w", m["at"], m["length"]).alias("run")))
    return (
        found.select("doc_id", "mark", F.inline(runs))
        .join(known.select("item_id", "hash", "run"), ["hash", "run"])
        .select("doc_id", "mark", "at", "length", "item_id")
        .distinct()
    )


def reported(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    met = common.store(hits(docs, items, id_col, text_col), "hits")
    covered = F.flatten(
        F.transform(F.collect_set(F.struct("at", "length")), lambda r: F.sequence(r["at"], r["at"] + r["length"] - 1))
    )
    per_doc = met.groupBy("doc_id", "mark").agg(
        F.size(F.array_distinct(covered)).cast("long").alias("n_hit"),
        F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
    )
    per_doc = common.store(per_doc, "contaminated").select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), "n_hit", "items")
    counted = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(text_col).alias("mark"),
        F.coalesce(count_words(F.col(text_col)), F.lit(0).cast("long")).alias("n_words"),
    )
    same = counted["doc_id"].eqNullSafe(F.col("_id")) & (counted["mark"] == F.col("_mark"))
    joined = counted.join(per_doc, same, "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return joined.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def _of(docs: DataFrame, found: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, Column]:
    """The found rows with names that the documents don't have, and when one is of a document."""
    own_id, own_mark = common.unused(docs, "_id", "_mark")
    found = found.withColumnsRenamed({"doc_id": own_id, "mark": own_mark})
    same_id = F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(own_id))
    return found, same_id & (F.xxhash64(F.col(f"`{text_col}`")) == F.col(own_mark))


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents in which no window of an item occurs, as they are."""
    met = common.store(hits(docs, items, id_col, text_col).select("doc_id", "mark").distinct(), "contaminated")
    met, same = _of(docs, met, id_col, text_col)
    return docs.join(met, same, "left_anti")


def without_spans(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All documents; words within an occurring window are taken out, with what follows each.

    Only the text changes, and only that of contaminated documents.
    """
    hit, places = common.unused(docs, "_hit", "_places")
    met = hits(docs, items, id_col, text_col).groupBy("doc_id", "mark")
    covered = F.transform(F.collect_set(F.struct("at", "length")), lambda r: F.sequence(r["at"], r["at"] + r["length"] - 1))
    met = common.store(met.agg(F.array_distinct(F.flatten(covered)).alias(hit)), "contaminated")
    met, same = _of(docs, met, id_col, text_col)
    text = F.col(f"`{text_col}`")
    # The text before the first word, then each word with what follows it.
    piece = WORD_ANY_CASE + r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
    head = F.regexp_extract(text, r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*", 0)
    pieces = F.regexp_extract_all(text, F.lit(piece), F.lit(0))
    known = F.map_from_arrays(hit, F.array_repeat(F.lit(True), F.size(hit)))
    kept = F.filter(pieces, lambda p, i: F.element_at(F.col(places), i + 1).isNull())
    joined = docs.join(met, same, "left").withColumn(places, F.when(F.col(hit).isNotNull(), known))
    changed = F.when(F.col(hit).isNull(), text).otherwise(F.concat(head, F.array_join(kept, "")))
    return joined.withColumn(text_col, changed).select([F.col(f"`{c}`") for c in docs.columns])
