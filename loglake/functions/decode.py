"""Key/value decoders (the reference's pluggable ``Decoder`` classes).

Built-ins first: UTF-8 text is a cast, JSON is ``from_json``; both run in
generated code. ``decode_with`` takes any Column -> Column function, and
``pandas_decoder`` wraps a vectorised pandas function for foreign formats.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def utf8(c: str | Column) -> Column:
    """Bytes -> string (the reference's ``StringDecoder``)."""
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("string")


def json_value(c: str | Column, schema: T.StructType | str) -> Column:
    """Bytes holding UTF-8 JSON -> struct of ``schema``."""
    return F.from_json(utf8(c), schema)


def decode_records(log: DataFrame, key: Callable[[Column], Column] = utf8, value: Callable[[Column], Column] = utf8,
                   provenance: bool = True) -> DataFrame:
    """Decoded messages. With ``provenance`` the topic/partition/offset are
    kept (the reference drops them and yields only (key, value))."""
    decoded = [key(F.col("key")).alias("key"), value(F.col("value")).alias("value")]
    if provenance:
        return log.select("topic", "partition", "offset", *decoded)
    return log.select(*decoded)


def decode_with(log: DataFrame, column: str, fn: Callable[[Column], Column], out: str | None = None) -> DataFrame:
    """Apply a user decoder ``fn`` (Column -> Column) to ``key`` or ``value``."""
    return log.withColumn(out or column, fn(F.col(column)))


def pandas_decoder(fn: Callable, return_type: T.DataType | str) -> Callable[[Column], Column]:
    """Wrap ``fn(pd.Series[bytes]) -> pd.Series`` as an Arrow-batched decoder
    for formats Spark has no built-in for."""
    udf = F.pandas_udf(fn, return_type)
    return lambda c: udf(c)


EVENT_VALUE = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("props", T.StructType([T.StructField("k", T.LongType())])),
    ]
)
