"""Running totals per key, as tables and as changelogs.

Sums are checked: a total beyond 64 bits raises instead of wrapping around.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.running import running, running_in_blocks
from tidemark.operators.stateless import with_key


def measure(how: str, value: str) -> Column:
    """The aggregate expression for one of the supported folds."""
    folds = {
        "sum": lambda: F.sum(value),
        "count": lambda: F.count(F.lit(1)),
        "min": lambda: F.min(value),
        "max": lambda: F.max(value),
    }
    return folds[how]()


def grouped(
    df: DataFrame, how: str = "sum", key: str = "key", value: str = "value", out: str = "value"
) -> DataFrame:
    """Latest total per key.

    On a stream, run it in update mode for the stream of changes or in complete
    mode for the whole table.  Totals are formed before the shuffle, so a key
    that holds most of the records costs one row per task.
    """
    return with_key(df, key).groupBy(key).agg(measure(how, value).alias(out))


def changelog(
    df: DataFrame,
    how: str = "sum",
    key: str = "key",
    value: str = "value",
    out: str = "value",
    order: Sequence[str] = ("partition", "offset"),
    block_on: str = "offset",
    widths: Sequence[int] = (1 << 20,),
    hot: DataFrame | None = None,
    start: DataFrame | None = None,
) -> DataFrame:
    """Every update of the total per key: one row for each record, in record order.

    Batch only; ``tidemark.streaming.changelog`` is the streaming form.  ``hot``
    may give the keys too large for one task (``hot_keys``; else every key is
    treated as one), ``start`` totals (key, out) to go on from.
    """
    keyed = with_key(df, key)
    source = None if how == "count" else value
    return running(
        keyed,
        [key],
        order,
        {out: (how, source)},
        block_on=block_on,
        widths=widths,
        hot=hot,
        start=start,
    )


def changelog_in_blocks(
    df: DataFrame,
    how: str = "sum",
    key: str = "key",
    value: str = "value",
    out: str = "value",
    order: Sequence[str] = ("partition", "offset"),
    *,
    blocks: Sequence[str],
    parts: int,
) -> DataFrame:
    """``changelog`` of records laid out by blocks of their order (``running_in_blocks``)."""
    source = None if how == "count" else value
    return running_in_blocks(with_key(df, key), [key], order, {out: (how, source)}, blocks=blocks, parts=parts)


def compact(
    changes: DataFrame, order: Sequence[str], key: str = "key", value: str = "value"
) -> DataFrame:
    """The table a changelog stands for: the last value per key.

    With one numeric order column this is a hash aggregate with partial results.
    """
    by = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    return with_key(changes, key).groupBy(key).agg(F.max_by(value, by).alias(value))
