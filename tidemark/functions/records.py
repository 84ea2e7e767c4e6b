"""Record layouts, written as Spark schemas."""

from __future__ import annotations

import json

from pyspark.sql.types import (
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# Field names, types and order of the records on the wire.
MOVIE = StructType(
    [
        StructField("id", LongType()),
        StructField("title", StringType()),
        StructField("releaseyear", IntegerType()),
    ]
)
RATING = StructType(
    [
        StructField("id", LongType()),
        StructField("rating", DoubleType()),
    ]
)
RATED_MOVIE = StructType(
    [
        StructField("id", LongType()),
        StructField("title", StringType()),
        StructField("releaseyear", IntegerType()),
        StructField("rating", DoubleType()),
    ]
)
TICKET_SALE = StructType(
    [
        StructField("title", StringType()),
        StructField("salets", StringType()),
        StructField("tickettotalvalue", LongType()),
    ]
)

_AVRO_NAMES: dict[type[DataType], str] = {
    LongType: "long",
    IntegerType: "int",
    DoubleType: "double",
    StringType: "string",
}


def avro_schema(schema: StructType, name: str, namespace: str) -> str:
    """The Avro record schema (JSON) of a flat layout, all fields required."""
    fields = [{"name": f.name, "type": _AVRO_NAMES[type(f.dataType)]} for f in schema]
    return json.dumps({"type": "record", "name": name, "namespace": namespace, "fields": fields})
