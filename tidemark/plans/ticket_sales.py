"""Job 2: ticket revenue per title, as a running total and per closed minute."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import session
from tidemark.functions import codecs
from tidemark.functions.records import TICKET_SALE
from tidemark.operators.aggregates import grouped
from tidemark.operators.stateless import peek, rekey, with_key
from tidemark.operators.windows import closings, emitted, tumbling_final, tumbling_stream
from tidemark.streaming import hop, replay, sinks
from tidemark.streaming.changelog import start_changelog

MINUTE = timedelta(minutes=1)


def decoded(messages: DataFrame) -> DataFrame:
    """Messages with the sale in ``decoded`` or why there is none in ``reject_reason``."""
    return codecs.decode(messages, TICKET_SALE)


def amounts(messages: DataFrame) -> DataFrame:
    """Amounts keyed by title; undecodable sales and sales without a title are left out."""
    return keyed_amounts(decoded(messages))


def keyed_amounts(sales: DataFrame) -> DataFrame:
    """The same, of messages that are decoded already."""
    sales = codecs.accepted(sales)
    keyed = rekey(sales, F.col("decoded.title"), F.col("decoded.tickettotalvalue"))
    return with_key(keyed.drop("decoded"))


def totals(messages: DataFrame) -> DataFrame:
    """Running total per title."""
    return grouped(amounts(messages))


def closed_minutes(messages: DataFrame, size: timedelta = MINUTE) -> DataFrame:
    """Replay of a table: total per title of each window that closed, without grace.

    Lateness is decided within the envelope's ``partition``.  The amounts are
    stored first, far smaller than the messages, so that each message is decoded
    once; a second job finds where each window closes.
    """
    rows = session.written(amounts(messages).drop("topic"), "amounts")
    closed = session.written(closings(rows, size), "closed-minutes")
    return tumbling_final(rows, closed, size)


def closed_minutes_stream(amounts: DataFrame, size: timedelta = MINUTE) -> DataFrame:
    """The same for a stream of amounts, closed by Spark's watermark; run it in append mode.

    ``emitted_at`` tells when a result came out.
    """
    return emitted(tumbling_stream(amounts, size))


def minute_messages(minutes: DataFrame) -> DataFrame:
    """Closed windows as topic messages: the title as key, a JSON value."""
    fields = [name for name in minutes.columns if name != "key"]
    return sinks.keyed_message(minutes, "key", codecs.encode(*fields))


def rejected_messages(rejected: DataFrame) -> DataFrame:
    """Rejected sales as topic messages: the reason as key, the text as it came."""
    return sinks.keyed_message(rejected, "reject_reason", "value")


def start(
    messages: DataFrame,
    totals_sink: sinks.Sink | None,
    minutes_sink: sinks.Sink | None,
    rejected_sink: sinks.Sink | None = None,
    *,
    sales_table: str,
    checkpoint_root: str,
    changes_root: str | None = None,
    exact_root: str | None = None,
    size: timedelta = MINUTE,
    every: str | None = "10 seconds",
    partitions: int | None = None,
    **read: str,
) -> tuple[StreamingQuery, ...]:
    """All results from one reading of the messages, each as its own query.

    The first query decodes each message once and stores it in ``sales_table``, the rejected ones
    with their reason; the others read that.  ``changes_root`` asks for the changelog of
    totals, a row per sale, in place of the changed totals.  ``exact_root`` asks for closed
    windows by the record-order rule and for the late sales (``replay.start_final``), in place
    of those that the watermark closes.  With ``every=None`` the first is
    finished before the others start.  ``read`` are options of reading the table.
    """
    sales = decoded(messages)
    queries = [
        hop.start_writing(
            sales,
            sales_table,
            name="ticket-sales",
            checkpoint=f"{checkpoint_root}/ticket-sales",
            every=every,
        )
    ]
    if every is None:
        sinks.drain(queries[0])
    stored = hop.read(messages.sparkSession, sales_table, sales.schema, **read)
    amounts = keyed_amounts(stored)

    def begin(df: DataFrame, sink: sinks.Sink, name: str, mode: str = "append") -> None:
        queries.append(
            sinks.start(
                df,
                sink,
                name=name,
                checkpoint=f"{checkpoint_root}/{name}",
                mode=mode,
                every=every,
                partitions=partitions,
            )
        )

    if changes_root is not None:
        queries.append(
            start_changelog(
                amounts, changes_root, name="ticket-changes", every=every, partitions=partitions
            )
        )
    elif totals_sink is not None:
        begin(grouped(amounts), totals_sink, "ticket-totals", "update")
    if exact_root is not None:
        queries.append(replay.start_final(amounts, exact_root, size, name="ticket-exact-minutes", every=every))
    elif minutes_sink is not None:
        begin(closed_minutes_stream(amounts, size), minutes_sink, "ticket-minutes")
    if rejected_sink is not None:
        rejected = peek(codecs.quarantined(stored), "rejected")
        begin(rejected, rejected_sink, "ticket-rejected")
    return tuple(queries)
