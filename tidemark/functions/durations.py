"""Time arithmetic in whole microseconds, the resolution of a Spark timestamp."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def micros(span: timedelta) -> int:
    return span // timedelta(microseconds=1)


def interval_text(span: timedelta) -> str:
    """The span as Spark's window and watermark functions read it."""
    return f"{micros(span)} microseconds"


def interval(span: timedelta) -> Column:
    """The span as a literal to add to a timestamp."""
    return F.lit(span)


def floor_div(value: Column, width: int) -> Column:
    """Exact integer floor of ``value / width``, for negative values too."""
    return F.call_function("div", value - F.pmod(value, F.lit(width)), F.lit(width))


def time_index(ts: Column, width: timedelta) -> Column:
    """Number of the epoch-aligned interval ``[start, start + width)`` holding ``ts``."""
    return floor_div(F.unix_micros(ts), micros(width))


def index_start(index: Column, width: timedelta) -> Column:
    """First instant of the interval with that number."""
    return F.timestamp_micros(index * F.lit(micros(width)))
