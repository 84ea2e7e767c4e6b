"""Operators that look at one record at a time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text


def tokenize(
    df: DataFrame,
    value: str = "value",
    keep: Sequence[str] = (),
    word: str = "word",
    position: str = "pos",
) -> DataFrame:
    """One row per word of the text in ``value``, with its place in the text.

    A null text gives no row; the empty text gives one empty word.
    """
    flagged = df.withColumn("__leading", text.has_leading_piece(F.col(value)))
    # The split stands inside the generator: over a column of its own the
    # optimizer would infer a "not empty" filter and split every text twice more.
    spread = flagged.select(
        *keep, "__leading", F.posexplode(text.pieces(F.col(value))).alias(position, word)
    )
    kept = spread.where(text.is_word(F.col(word), F.col(position), F.col("__leading")))
    return kept.drop("__leading")


def rekey(df: DataFrame, key: Column | str, value: Column | str | None = None) -> DataFrame:
    """Give each record a new key, and a new value if one is named."""
    moved = df.withColumn("key", F.col(key) if isinstance(key, str) else key)
    if value is None:
        return moved
    return moved.withColumn("value", F.col(value) if isinstance(value, str) else value)


def rekey_by_number(df: DataFrame, number: Column | str) -> DataFrame:
    """Key each record by a number written as text."""
    column = F.col(number) if isinstance(number, str) else number
    return rekey(df, column.cast("string"))


def with_key(df: DataFrame, *keys: str) -> DataFrame:
    """Drop records without a key; grouping and joining never see them."""
    for key in keys or ("key",):
        df = df.where(F.col(key).isNotNull())
    return df


def peek(df: DataFrame, name: str, *metrics: Column) -> DataFrame:
    """Watch records go by: rows pass unchanged, counts reach query listeners."""
    return df.observe(name, F.count(F.lit(1)).alias("records"), *metrics)
