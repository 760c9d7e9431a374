"""Size checks before a broadcast.

A side is broadcast only after its row count is known to be under a limit;
otherwise the join is left to a shuffle (with AQE's skew-join splitting).
The sides checked here are per-partition metadata (one row per topic
partition or per range), never message data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Row limit for broadcasting per-partition metadata (a few columns per row).
METADATA_BROADCAST_ROWS = 1_000_000


def broadcast_if_small(df: DataFrame, limit: int = METADATA_BROADCAST_ROWS) -> DataFrame:
    """Count ``df`` (a small aggregate) and hint a broadcast only if the count
    is within ``limit``. Nothing is cached: a cached frame would outlive the
    call and could answer for a table that has grown since."""
    return F.broadcast(df) if df.count() <= limit else df


UNKNOWN = 1 << 60  # Catalyst's size of a leaf it knows nothing about is beyond this
TARGET_BYTES, LEAST_BYTES = 128 << 20, 4 << 20  # of a task, and of a file worth a task of its own


def input_bytes(df: DataFrame) -> int | None:
    """Bytes of the tables that ``df`` reads: the sizes of its scans, added up. (The estimate for a whole plan multiplies
    the sides of its joins.) None where a leaf has no size."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return None if any(s >= UNKNOWN for s in sizes) else sum(sizes)


def file_tasks(df: DataFrame) -> int:
    """Tasks for a range shuffle of ``df``: of about ``TARGET_BYTES`` each; below that, as many as there are cores, but none
    of less than ``LEAST_BYTES``. (A count that is asked for is kept as it is by AQE.)"""
    size, cores = input_bytes(df), df.sparkSession.sparkContext.defaultParallelism
    if size is None:
        return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(cores, size // LEAST_BYTES), -(-size // TARGET_BYTES))
