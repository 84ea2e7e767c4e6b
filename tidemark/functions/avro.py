"""Avro values; needs Spark's external Avro module on the class path."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: one marker byte and a four-byte schema id precede a framed value.
FRAME_BYTES = 5


def unframed(value: Column) -> Column:
    """Drop the prefix that a schema registry's serializer puts before the value."""
    return F.substring(value, FRAME_BYTES + 1, 2147483647)


def decode(value: Column, schema_json: str, framed: bool = False) -> Column:
    from pyspark.sql.avro.functions import from_avro

    return from_avro(unframed(value) if framed else value, schema_json)


def encode(value: Column, schema_json: str) -> Column:
    from pyspark.sql.avro.functions import to_avro

    return to_avro(value, schema_json)
