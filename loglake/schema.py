"""Fixed table schemas of the engine.

LOG      one row per message of a partitioned, offset-addressed log
WATER    retained bounds of each topic partition (``latest`` is exclusive)
OFFSETS  append-only history of consumer-group positions
PLAN     one half-open offset range per topic partition to fetch
"""

from __future__ import annotations

from pyspark.sql import types as T

LOG = T.StructType(
    [
        T.StructField("topic", T.StringType(), False),
        T.StructField("partition", T.IntegerType(), False),
        T.StructField("offset", T.LongType(), False),
        T.StructField("timestamp", T.TimestampType(), True),
        T.StructField("key", T.BinaryType(), True),
        T.StructField("value", T.BinaryType(), True),
    ]
)

WATER = T.StructType(
    [
        T.StructField("topic", T.StringType(), False),
        T.StructField("partition", T.IntegerType(), False),
        T.StructField("earliest", T.LongType(), False),
        T.StructField("latest", T.LongType(), False),
    ]
)

OFFSETS = T.StructType(
    [
        T.StructField("group_id", T.StringType(), False),
        T.StructField("topic", T.StringType(), False),
        T.StructField("partition", T.IntegerType(), False),
        T.StructField("committed", T.LongType(), False),
        T.StructField("commit_seq", T.LongType(), False),
        T.StructField("committed_at", T.TimestampType(), True),
    ]
)

PLAN = T.StructType(
    [
        T.StructField("group_id", T.StringType(), False),
        T.StructField("topic", T.StringType(), False),
        T.StructField("partition", T.IntegerType(), False),
        T.StructField("start_offset", T.LongType(), False),
        T.StructField("stop_offset", T.LongType(), False),
    ]
)

LOG_COLUMNS = [f.name for f in LOG.fields]
PLAN_COLUMNS = [f.name for f in PLAN.fields]
OFFSETS_COLUMNS = [f.name for f in OFFSETS.fields]
PARTITION_KEY = ["topic", "partition"]
