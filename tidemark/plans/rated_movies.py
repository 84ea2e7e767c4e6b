"""Job 3: ratings joined to the movies announced around the same time."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.functions import codecs
from tidemark.functions.records import MOVIE, RATED_MOVIE, RATING
from tidemark.operators.joins import interval_join
from tidemark.operators.stateless import peek, rekey_by_number
from tidemark.streaming import hop, sinks

# How far apart a rating and its movie may be, and how late.
REACH = timedelta(seconds=30)
GRACE = timedelta(seconds=30)


def by_id(messages: DataFrame, schema: StructType) -> DataFrame:
    """Decode messages and key them by their ``id`` field; bad ones are left out."""
    good = codecs.accepted(codecs.decode(messages, schema))
    flat = good.select("decoded.*", "ts", "topic", "partition", "offset")
    return rekey_by_number(flat, "id")


def movies(messages: DataFrame) -> DataFrame:
    return by_id(messages, MOVIE)


def ratings(messages: DataFrame) -> DataFrame:
    return by_id(messages, RATING)


def rated(
    ratings: DataFrame,
    movies: DataFrame,
    reach: timedelta = REACH,
    grace: timedelta = GRACE,
    salts: int = 1,
) -> DataFrame:
    """Every rating with every movie of its id at most ``reach`` away in time."""
    return interval_join(
        ratings,
        movies,
        reach,
        reach,
        ["right.id", "right.title", "right.releaseyear", "left.rating"],
        grace=grace,
        salts=salts,
    )


def messages(rated: DataFrame) -> DataFrame:
    """Rated movies as topic messages: text key, JSON value."""
    return sinks.keyed_message(rated, "key", codecs.encode(*RATED_MOVIE.fieldNames()))


def start(
    movie_messages: DataFrame,
    rating_messages: DataFrame,
    movie_table: str,
    sink: sinks.Sink,
    *,
    checkpoint_root: str,
    every: str | None = "10 seconds",
    reach: timedelta = REACH,
    grace: timedelta = GRACE,
    salts: int = 1,
    rejected_sink: sinks.Sink | None = None,
    partitions: int | None = None,
    **read: str,
) -> tuple[StreamingQuery, ...]:
    """Two queries: one stores the keyed movies, one joins ratings to what is stored.

    With ``every=None`` the first is finished before the second starts.  ``salts`` splits
    the ratings of one id and time slot.  ``rejected_sink`` gets what of either input does
    not decode, from a query of its own.  ``read`` are options of reading the table.
    """
    keyed = movies(movie_messages)
    first = hop.start_writing(
        keyed,
        movie_table,
        name="keyed-movies",
        checkpoint=f"{checkpoint_root}/keyed-movies",
        every=every,
    )
    if every is None:
        sinks.drain(first)
    stored = hop.read(movie_messages.sparkSession, movie_table, keyed.schema, **read)
    second = sinks.start(
        rated(ratings(rating_messages), stored, reach, grace, salts),
        sink,
        name="rated-movies",
        checkpoint=f"{checkpoint_root}/rated-movies",
        every=every,
        partitions=partitions,
    )
    if rejected_sink is None:
        return first, second
    rejected = codecs.quarantined(codecs.decode(movie_messages, MOVIE)).unionByName(
        codecs.quarantined(codecs.decode(rating_messages, RATING))
    )
    third = sinks.start(
        peek(rejected, "rejected"),
        rejected_sink,
        name="rejected-messages",
        checkpoint=f"{checkpoint_root}/rejected-messages",
        every=every,
    )
    return first, second, third
