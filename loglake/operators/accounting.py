"""Offset accounting: retained bounds, committed positions, start resolution,
lag at partition / topic / group level, partition discovery.

All of these are small aggregates: the only pass over message data is
``watermarks``, which reads just the ``offset`` column (plus the directory
columns) and aggregates map-side first, so a hot partition costs one partial
min/max per task.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglake.schema import PARTITION_KEY

POSITION_KEY = ["group_id", "topic", "partition"]


class UnstableSourceError(RuntimeError):
    """Raised when a source reports negative bounds (E2)."""


def watermarks(log) -> DataFrame:
    """WATER: earliest retained offset and next offset (``latest``, exclusive)
    of each topic partition. A ``LogTable`` answers from its records."""
    if hasattr(log, "bounds") and not isinstance(log, DataFrame):
        return log.bounds()
    return log.groupBy(*PARTITION_KEY).agg(
        F.min("offset").alias("earliest"),
        (F.max("offset") + F.lit(1)).cast("bigint").alias("latest"),
    )


def check_bounds(water: DataFrame) -> DataFrame:
    """Refuse bounds below zero before planning: the source is not ready to
    be read. Returns ``water`` unchanged."""
    bad = water.filter((F.col("earliest") < 0) | (F.col("latest") < 0)).limit(1).collect()
    if bad:
        r = bad[0]
        raise UnstableSourceError(f"negative bounds for {r['topic']}[{r['partition']}]: {r['earliest']}..{r['latest']}")
    return water


def topic_partitions(water: DataFrame) -> DataFrame:
    """Partition count per topic plus a total row (topic NULL) carrying the
    total partition count and the number of topics."""
    return water.rollup("topic").agg(
        F.count(F.lit(1)).alias("partitions"),
        F.countDistinct("topic").alias("topics"),
    )


def committed_offsets(offsets: DataFrame) -> DataFrame:
    """Last committed position of each (group, topic, partition): the row with
    the highest ``commit_seq`` wins, not the highest offset (start resolution
    can move a position backwards)."""
    return offsets.groupBy(*POSITION_KEY).agg(
        F.max_by("committed", "commit_seq").alias("committed"),
        F.max("commit_seq").alias("commit_seq"),
    )


def registrations(spark: SparkSession, entries: Iterable[tuple[str, str, int]] | Iterable[tuple[str, str]]) -> DataFrame:
    """Registration table ``(group_id, topic, max_queue)``. The default
    ``max_queue`` is 5000; registering one (group, topic) twice is an error."""
    rows = []
    seen = set()
    for e in entries:
        group, topic, *rest = e
        max_queue = int(rest[0]) if rest else 5000
        if (group, topic) in seen:
            raise ValueError(f"topic {topic!r} is already registered for group {group!r}")
        seen.add((group, topic))
        rows.append((group, topic, max_queue))
    schema = T.StructType(
        [
            T.StructField("group_id", T.StringType(), False),
            T.StructField("topic", T.StringType(), False),
            T.StructField("max_queue", T.IntegerType(), False),
        ]
    )
    return spark.createDataFrame(rows, schema)


def require_topics(water: DataFrame, regs: DataFrame) -> None:
    """Every registered topic must exist in the log (partition discovery)."""
    missing = regs.select("topic").distinct().join(water.select("topic").distinct(), "topic", "left_anti").collect()
    if missing:
        raise ValueError(f"topic(s) not found: {sorted(r['topic'] for r in missing)}")


def resolve_start(
    water: DataFrame,
    regs: DataFrame,
    offsets: DataFrame | None = None,
    zero_is_missing: bool = True,
    reset: str = "latest",
) -> DataFrame:
    """Start position of each registered (group, topic, partition).

    Rule of the reference: nothing stored, **or 0 stored**, starts at
    ``latest`` (``reset``, or ``earliest``); stored below ``earliest`` moves to
    ``earliest``; above ``latest`` moves to ``latest``; else the stored value.
    ``zero_is_missing=False`` reads a stored 0 as a real position.

    Output: group_id, topic, partition, max_queue, earliest, latest, stored,
    position, status ('missing' | 'below' | 'above' | 'valid')."""
    if reset not in ("latest", "earliest"):
        raise ValueError("reset must be 'latest' or 'earliest'")
    # metadata joined with metadata (one row per partition / per registration):
    # no message data takes part, the planner picks the join
    base = water.join(regs, "topic")
    if offsets is not None:
        last = committed_offsets(offsets).select(*POSITION_KEY, F.col("committed").alias("stored"))
        base = base.join(last, POSITION_KEY, "left")
    else:
        base = base.withColumn("stored", F.lit(None).cast("bigint"))
    stored = F.col("stored")
    missing = stored.isNull() | (stored == 0) if zero_is_missing else stored.isNull()
    status = (
        F.when(missing, "missing")
        .when(stored < F.col("earliest"), "below")
        .when(stored > F.col("latest"), "above")
        .otherwise("valid")
    )
    position = (
        F.when(missing, F.col(reset))
        .when(stored < F.col("earliest"), F.col("earliest"))
        .when(stored > F.col("latest"), F.col("latest"))
        .otherwise(stored)
    )
    return base.select(
        *POSITION_KEY,
        "max_queue",
        "earliest",
        "latest",
        "stored",
        position.cast("bigint").alias("position"),
        status.alias("status"),
    )


def positions_at(water: DataFrame, regs: DataFrame, position) -> DataFrame:
    """Positions set directly (no stored offsets), e.g. ``F.lit(0)`` or an
    expression of ``earliest``/``latest``; clipped into the retained range."""
    base = water.join(regs, "topic")
    pos = F.least(F.greatest(position, F.col("earliest")), F.col("latest"))
    return base.select(
        *POSITION_KEY,
        "max_queue",
        "earliest",
        "latest",
        F.lit(None).cast("bigint").alias("stored"),
        pos.cast("bigint").alias("position"),
        F.lit("set").alias("status"),
    )


def lag_partition(positions: DataFrame) -> DataFrame:
    return positions.select(*POSITION_KEY, "position", "latest", (F.col("latest") - F.col("position")).alias("lag"))


def lag_topic(positions: DataFrame) -> DataFrame:
    return (
        lag_partition(positions)
        .groupBy("group_id", "topic")
        .agg(F.sum("lag").cast("bigint").alias("lag"), F.count(F.lit(1)).alias("partitions"))
    )


def lag_total(positions: DataFrame) -> DataFrame:
    return (
        lag_partition(positions)
        .groupBy("group_id")
        .agg(
            F.sum("lag").cast("bigint").alias("lag"),
            F.countDistinct("topic").alias("topics"),
            F.count(F.lit(1)).alias("partitions"),
        )
    )


def register_topics(water: DataFrame, group: str, max_queue: int = 5000) -> DataFrame:
    """Register every topic present in ``water`` for ``group``."""
    return (
        water.select("topic")
        .distinct()
        .select(F.lit(group).alias("group_id"), "topic", F.lit(int(max_queue)).cast("int").alias("max_queue"))
    )
