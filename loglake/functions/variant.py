"""Payloads without a schema: VARIANT values, the schema they turn out to have, and a dead letter for the unreadable.

``decode_variant`` parses each payload once into a VARIANT; a payload that is no JSON (or no UTF-8 text) is not an error of
the batch but a row of the dead letter, with its place in the log and its bytes. ``discovered`` folds the schemas of all
payloads of a log into one, and ``shaped`` reads chosen paths, null where a payload has none or another type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLACE = ["topic", "partition", "offset"]


def _text(c: Column) -> Column:
    """Bytes as text, null where they are no UTF-8."""
    return F.when(F.is_valid_utf8(c.cast("string")), c.cast("string"))


def decode_variant(log: DataFrame, column: str = "value") -> DataFrame:
    """``log`` with ``payload`` (VARIANT, null where unreadable) and ``readable``. A null payload is readable and null."""
    parsed = log.withColumn("payload", F.try_parse_json(_text(F.col(column))))
    return parsed.withColumn("readable", F.col(column).isNull() | F.col("payload").isNotNull())


def readable(decoded: DataFrame) -> DataFrame:
    return decoded.filter("readable").drop("readable")


def dead_letter(decoded: DataFrame, column: str = "value") -> DataFrame:
    """Place, bytes and reason of each unreadable payload."""
    reason = F.when(F.is_valid_utf8(F.col(column).cast("string")), "not JSON").otherwise("not UTF-8")
    return decoded.filter("not readable").select(*PLACE, column, reason.alias("reason"))


def discovered(decoded: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The schema of all payloads (of each ``by`` group), merged: a column ``payload_schema``."""
    return decoded.filter("payload is not null").groupBy(*(by or [])).agg(F.schema_of_variant_agg("payload").alias("payload_schema"))


def shaped(decoded: DataFrame, paths: dict[str, tuple[str, str]]) -> DataFrame:
    """``decoded`` with a column for each name: (path, type)."""
    out = decoded
    for name, (path, kind) in paths.items():
        out = out.withColumn(name, F.try_variant_get("payload", path, kind))
    return out
