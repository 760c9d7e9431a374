"""Removing duplicate messages.

A message id may repeat any number of times (a replayed producer can write one
id millions of times). The survivor is the first row by ``row_number``: Spark
limits each group on the map side before the shuffle (window group limit), so
a hot id sends one row per task. A message without an id equals no other and
always stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_batch(df: DataFrame, id_col: str | Column, order: list[str] | None = None) -> DataFrame:
    """Keep, per id, the row that is first by ``order`` (default: topic,
    partition, offset -- the earliest copy). Deterministic. Rows whose id is
    null are all kept."""
    order = order or ["topic", "partition", "offset"]
    idc = F.col(id_col) if isinstance(id_col, str) else id_col
    cols = df.columns
    keyed = df.withColumn("_id", idc).withColumn("_alone", F.when(idc.isNull(), F.monotonically_increasing_id()))
    first = F.row_number().over(Window.partitionBy("_id", "_alone").orderBy(*order))
    return keyed.withColumn("_n", first).filter(F.col("_n") == 1).select(*cols)
