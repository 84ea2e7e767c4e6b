"""Job 1: how often each word occurs in lines of text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import session
from tidemark.functions.durations import floor_div
from tidemark.operators.aggregates import changelog_in_blocks, grouped
from tidemark.operators.running import HOT
from tidemark.operators.stateless import tokenize
from tidemark.streaming import sinks
from tidemark.streaming.changelog import start_changelog

# Words of a block of texts.
BLOCK = 1 << 20


def counts(lines: DataFrame, value: str = "value") -> DataFrame:
    """(key, value): word and its count so far."""
    words = tokenize(lines, value, word="key").drop("pos")
    return grouped(words, how="count")


def count_changes(
    lines: DataFrame,
    value: str = "value",
    order: Sequence[str] = ("partition", "offset"),
    limit: int = HOT,
) -> DataFrame:
    """One row per word read, in record order, with the word's count at that point.

    A text is much smaller than its words with their places, so texts are moved and words
    are not: texts are laid out in blocks of their order, split there, and only each block's
    counts meet those of the other blocks.  A block is as many texts as hold about BLOCK words
    on average, or fewer, so that the most frequent word has about ``limit`` records in it.
    """
    words = tokenize(lines, value, word="key")
    # One pass for all: a text with words has one in place 0, even if that is the empty word.
    begun = F.count_if(F.col("pos") == 0).alias("texts")
    counted = words.groupBy("key").agg(F.count(F.lit(1)).alias("words"), begun)
    sums = [F.sum("words").alias("words"), F.sum("texts").alias("texts"), F.max("words").alias("most")]
    found = counted.agg(*sums).first().asDict()
    total, texts, most = (found[name] or 0 for name in ("words", "texts", "most"))
    width = max(1, min(BLOCK, limit * total // max(1, most)) * texts // max(1, total))
    *lead, number = order
    blocks = {f"__lead{i}": F.col(name) for i, name in enumerate(lead)} | {"__block": floor_div(F.col(number), width)}
    parts = max(lines.sparkSession.sparkContext.defaultParallelism, 2 * total // BLOCK)
    laid = lines.select(*order, value).withColumns(blocks).repartition(parts, *blocks)
    found = changelog_in_blocks(
        tokenize(laid, value, keep=[*order, *blocks], word="key"),
        how="count",
        order=[*order, "pos"],
        blocks=list(blocks),
        parts=parts,
    )
    # Stored, so that a reader of the result splits no text again.
    return session.written(found, "word-changes")


def start_changes(
    lines: DataFrame,
    root: str,
    *,
    order: Sequence[str] = ("partition", "offset"),
    name: str = "word-changes",
    every: str | None = "10 seconds",
    partitions: int | None = None,
) -> StreamingQuery:
    """The same on a stream: each micro-batch adds a row for every word it read."""
    words = tokenize(lines, keep=order, word="key")
    return start_changelog(
        words,
        root,
        name=name,
        how="count",
        order=[*order, "pos"],
        block_on=order[-1],
        every=every,
        partitions=partitions,
    )


def start(
    lines: DataFrame,
    sink: sinks.Sink,
    *,
    checkpoint: str,
    name: str = "word-count",
    every: str | None = "10 seconds",
    partitions: int | None = None,
) -> StreamingQuery:
    """Keep counting; each trigger sends on the counts that changed.

    The state's rows are not counted in the query's progress (``session.MANY_KEYS``).
    """
    return sinks.start(
        counts(lines),
        sink,
        name=name,
        checkpoint=checkpoint,
        mode="update",
        every=every,
        partitions=partitions,
        settings=session.MANY_KEYS,
    )
