"""Strict JSON decoding, JSON encoding and binary longs, as column expressions."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
)

_NUMBERS: dict[type[DataType], str] = {
    LongType: "bigint",
    IntegerType: "int",
    DoubleType: "double",
}

REPEATED_KEYS = "spark.sql.variant.allowDuplicateKeys"

MALFORMED = "malformed"
UNKNOWN_FIELD = "unknown field"
BAD_FIELD = "bad field"


def decode(df: DataFrame, schema: StructType, source: str = "value") -> DataFrame:
    """Read JSON text in ``source`` as ``schema``; add ``decoded`` and ``reject_reason``.

    Rules for a record to be accepted (``reject_reason`` null):

    * it is one JSON object with no field outside the schema;
    * a number field holds a number (a fraction is cut off toward zero for
      whole-number types), text that reads as one, or null; not true/false;
    * a string field holds a string, number, true/false or null.

    A missing or null number is 0; a missing or null string stays null.  A null
    or empty source is malformed.

    A repeated field keeps its last value, in any session.  A number in a string field
    keeps its digits as they were sent.

    The text is parsed once, each field read once and its shape looked up at most
    once.  ``explode`` of one-element arrays holds what was found: the optimizer does not
    push a later filter below it, which would repeat the work.
    """
    df.sparkSession.conf.set(REPEATED_KEYS, "true")
    fields = F.try_variant_get(F.try_parse_json(F.col(source)), "$", "map<string,variant>")
    parsed = df.withColumn("__fields", F.explode(F.array(fields)))
    found = F.col("__fields")
    names = F.array(*[F.lit(f.name) for f in schema])
    extra = F.size(F.array_except(F.map_keys(found), names)) > 0
    fault = F.when(found.isNull(), MALFORMED).when(extra, UNKNOWN_FIELD)
    first = [_look(found[f.name], f.dataType).alias(f.name) for f in schema]
    looked = parsed.withColumn("__looked", F.explode(F.array(F.struct(fault.alias("__fault"), *first))))
    seen = F.col("__looked")
    bad = reduce(lambda a, b: a | b, [_is_bad(seen[f.name], f.dataType) for f in schema])
    value = F.struct(
        *[_value(seen[f.name], f.name, f.dataType, F.col(source)).alias(f.name) for f in schema]
    )
    reason = F.coalesce(seen["__fault"], F.when(bad, BAD_FIELD))
    judged = looked.withColumn("__judged", F.explode(F.array(F.struct(reason.alias("reason"), value.alias("value")))))
    return (
        judged.withColumn("reject_reason", F.col("__judged.reason"))
        .withColumn("decoded", F.when(F.col("reject_reason").isNull(), F.col("__judged.value")))
        .drop("__fields", "__looked", "__judged")
    )


def accepted(decoded: DataFrame) -> DataFrame:
    """The records that decoded."""
    return decoded.where(F.col("reject_reason").isNull()).drop("reject_reason")


def quarantined(decoded: DataFrame) -> DataFrame:
    """The records that did not, with the reason, and the source left as it came."""
    return decoded.where(F.col("reject_reason").isNotNull()).drop("decoded")


def _look(field: Column, kind: DataType) -> Column:
    """A field as ``kind``, null where it does not read, and its shape where that matters."""
    shape = F.schema_of_variant(field)
    if isinstance(kind, StringType):
        read = F.try_variant_get(field, "$", "string")
        # Only what may be a number or nested text.
        shape = F.when(read.rlike(r"^[-0-9{\[]"), shape)
        return F.struct(read.alias("read"), shape.alias("shape"))
    if type(kind) not in _NUMBERS:
        raise TypeError(f"no JSON reading for {kind.simpleString()}")
    read = F.try_variant_get(field, "$", _NUMBERS[type(kind)])
    # true and false read as 1 and 0.
    shape = F.when(read.isNull() | read.isin(0, 1), shape)
    text = F.when(read.isNull(), F.try_variant_get(field, "$", "string"))
    return F.struct(read.alias("read"), shape.alias("shape"), text.alias("text"))


def _is_bad(seen: Column, kind: DataType) -> Column:
    """Whether the field must not be read as ``kind``."""
    shape = F.coalesce(seen["shape"], F.lit(""))
    if isinstance(kind, StringType):
        return shape.startswith("OBJECT") | shape.startswith("ARRAY")
    absent = shape.isin("", "VOID") | F.coalesce(F.trim(seen["text"]).isin("", "null"), F.lit(False))
    return F.when(seen["read"].isNotNull(), shape == "BOOLEAN").otherwise(~absent)


def _value(seen: Column, name: str, kind: DataType, source: Column) -> Column:
    if not isinstance(kind, StringType):
        return F.coalesce(seen["read"], F.lit(0).cast(kind))
    # Within JSON text a quoted name before a colon is a name, as quotes in strings are escaped.
    token = rf'"{re.escape(name)}"\s*:\s*(-?[0-9][0-9.eE+-]*)'
    sent = F.try_element_at(F.regexp_extract_all(source, F.lit(token), F.lit(1)), F.lit(-1))
    number = seen["shape"].rlike("^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL|DOUBLE|FLOAT)")
    return F.when(number, F.coalesce(sent, seen["read"])).otherwise(seen["read"])


def encode(*columns: Column | str) -> Column:
    """One JSON object of the columns, in order, nulls written out."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def long_to_bytes(value: Column) -> Column:
    """A long as 8 big-endian bytes, the usual binary form of a long on a topic."""
    return F.unhex(F.lpad(F.hex(value), 16, "0"))


def bytes_to_long(value: Column) -> Column:
    """Inverse of ``long_to_bytes``."""
    return F.conv(F.hex(value), 16, -10).cast("bigint")
