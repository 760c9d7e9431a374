"""Sinks for fetched batches.

* ``write_partitioned``: the per-partition sink -- one folder per topic
  partition, written by the tasks that hold the rows (no collect);
* ``write_batch``: idempotent batch sink -- batch ``n`` always goes to
  ``<root>/batch_id=n`` with overwrite, so a replayed batch (after a failure
  between sink and commit) replaces its first attempt instead of doubling it;
* ``for_each_partition``: hand each Spark partition of a batch to user code.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.accumulators import AccumulatorParam
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from loglake.session import path_exists


def write_partitioned(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).partitionBy("topic", "partition").parquet(path)


def partition_summary(spark: SparkSession, path: str) -> DataFrame:
    """Per topic partition of a sink: records, offset range, value bytes."""
    return (
        spark.read.parquet(path)
        .groupBy("topic", "partition")
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.min("offset").alias("min_offset"),
            F.max("offset").alias("max_offset"),
            F.sum(F.length("value")).cast("bigint").alias("value_bytes"),
        )
    )


def write_batch(df: DataFrame, root: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{root.rstrip('/')}/batch_id={int(batch_id)}")


def read_batches(spark: SparkSession, root: str, schema=None) -> DataFrame:
    """All batches written by ``write_batch`` with their ``batch_id``."""
    reader = spark.read.option("basePath", root)
    if schema is not None:
        reader = reader.schema(schema)
    if not path_exists(spark, root):
        raise FileNotFoundError(root)
    return reader.parquet(root)


class Tally(AccumulatorParam):
    """Accumulates {key: tuple of numbers}: what tasks report of each topic partition, once per task that ended well."""

    def zero(self, value: dict) -> dict:
        return {}

    def addInPlace(self, a: dict, b: dict) -> dict:
        for k, v in b.items():
            a[k] = tuple(x + y for x, y in zip(a[k], v)) if k in a else v
        return a


def for_each_partition(df: DataFrame, fn: Callable[[Iterator[Row]], None]) -> None:
    df.foreachPartition(fn)


def rebalance(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition a batch for parallelism (rows unchanged). With keys, rows
    are hashed by key but AQE splits any partition that grows past the advisory
    size, so a hot key cannot pin a third of the batch on one task."""
    return df.hint("rebalance", *keys) if keys else df.hint("rebalance")
