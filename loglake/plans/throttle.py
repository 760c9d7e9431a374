"""Throttled fetch plans: how far each partition may read in the next batch.

Input is a positions table (``resolve_start`` / ``positions_at``): one row per
(group, topic, partition) with ``position``, ``latest`` and ``max_queue``.
Output is PLAN: half-open ranges ``[start_offset, stop_offset)``. Positions
tables hold one row per topic partition, so the per-topic windows below see P
rows each -- metadata, never messages.

The three rules of the reference, exactly:

* partition (D1): lag > max_queue -> stop = min(pos + max(1, max_queue), latest); else latest
* topic (D2):     per_each = max(1, max_queue div P); if the *topic* lag > max_queue
                  every partition stops at min(pos + per_each, latest); else at latest
* group (D3):     topics without lag are left out; per_each as above; if the lag of
                  *all* registered topics > per_each: min(pos + per_each, latest),
                  else latest -- which is always min(pos + per_each, latest)

A position above ``latest`` (negative lag) is never planned backwards: the
stop is clamped to the start.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loglake.schema import PLAN_COLUMNS


def with_max_queue(positions: DataFrame, max_queue: int | dict | None) -> DataFrame:
    """Override the registered ``max_queue`` by one int or a {topic: int} map."""
    if max_queue is None:
        return positions
    if isinstance(max_queue, dict):
        mapping = F.create_map(*[x for t, q in max_queue.items() for x in (F.lit(t), F.lit(int(q)))])
        return positions.withColumn("max_queue", F.coalesce(mapping[F.col("topic")], F.col("max_queue")))
    return positions.withColumn("max_queue", F.lit(int(max_queue)))


def _lag() -> Column:
    return F.col("latest") - F.col("position")


def _plan(df: DataFrame, stop: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """PLAN rows (plus ``keep`` columns of the positions, for callers that
    want bounds and plan from one job)."""
    start = F.col("position")
    return df.select(
        "group_id",
        "topic",
        "partition",
        start.alias("start_offset"),
        F.greatest(start, stop).cast("bigint").alias("stop_offset"),
        *keep,
    ).select(*PLAN_COLUMNS, *keep)


def per_each(positions: DataFrame) -> DataFrame:
    """Add ``parts`` (P of the topic), ``topic_lag`` and ``per_each``. Callers
    that already know the per-topic ``parts`` and ``topic_lag`` (the planned
    loop holds them for its P rows) pass them as columns; the rule is then a
    plain projection with no shuffle."""
    topic = Window.partitionBy("group_id", "topic")
    if "parts" not in positions.columns:
        positions = positions.withColumn("parts", F.count(F.lit(1)).over(topic))
    if "topic_lag" not in positions.columns:
        positions = positions.withColumn("topic_lag", F.sum(_lag()).over(topic))
    return positions.withColumn("per_each", F.greatest(F.lit(1), F.expr("max_queue div parts")).cast("bigint"))


def plan_partition(positions: DataFrame, max_queue: int | dict | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """D1: each partition throttled on its own lag."""
    p = with_max_queue(positions, max_queue)
    cap = F.greatest(F.lit(1), F.col("max_queue")).cast("bigint")
    stop = F.when(_lag() > F.col("max_queue"), F.least(F.col("position") + cap, F.col("latest"))).otherwise(
        F.col("latest")
    )
    return _plan(p, stop, keep)


def plan_topic(positions: DataFrame, max_queue: int | dict | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """D2: a uniform share of ``max_queue`` per partition while the topic's lag
    exceeds ``max_queue``, everything up to ``latest`` otherwise."""
    p = per_each(with_max_queue(positions, max_queue))
    stop = F.when(
        F.col("topic_lag") > F.col("max_queue"), F.least(F.col("position") + F.col("per_each"), F.col("latest"))
    ).otherwise(F.col("latest"))
    return _plan(p, stop, keep)


def plan_group(positions: DataFrame, max_queue: int | dict | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """D3: one plan over all registered topics of a group; topics without lag
    are left out."""
    p = per_each(with_max_queue(positions, max_queue)).filter(F.col("topic_lag") > 0)
    stop = F.least(F.col("position") + F.col("per_each"), F.col("latest"))
    return _plan(p, stop, keep)


def plan_proportional(positions: DataFrame, max_queue: int | dict | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Spark's own ``maxOffsetsPerTrigger`` style: the budget is split in
    proportion to each partition's lag (floor, at least 1 while lagging). The
    product is a decimal: it exceeds 64 bits for a large lag and budget."""
    p = per_each(with_max_queue(positions, max_queue))
    share = F.greatest(F.lit(1), F.expr("(cast(max_queue as decimal(18,0)) * cast(latest - position as decimal(19,0))) div topic_lag")).cast("bigint")
    stop = F.when(
        F.col("topic_lag") > F.col("max_queue"), F.least(F.col("position") + share, F.col("latest"))
    ).otherwise(F.col("latest"))
    return _plan(p, stop, keep)


RULES = {"partition": plan_partition, "topic": plan_topic, "group": plan_group, "proportional": plan_proportional}


def stops(positions: dict[tuple[str, int], int], bounds: dict[tuple[str, int], tuple[int, int]], max_queue: dict[str, int], rule: str = "topic") -> dict[tuple[str, int], int]:
    """Where the rule lets each (topic, partition) stop, for callers that hold the P positions and bounds as values (a
    stream's source has no session). The same arithmetic as the DataFrame forms above."""
    out = dict(positions)
    parts = {t: [k for k in sorted(bounds) if k[0] == t and k in positions] for t in max_queue}
    for t, keys in parts.items():
        queue, lag = max_queue[t], sum(bounds[k][1] - positions[k] for k in keys)
        each = max(1, queue // len(keys)) if keys else 0
        for k in keys:
            latest, own = bounds[k][1], bounds[k][1] - positions[k]
            if rule == "partition":
                stop = min(positions[k] + max(1, queue), latest) if own > queue else latest
            elif rule == "topic":
                stop = min(positions[k] + each, latest) if lag > queue else latest
            elif rule == "group":
                stop = min(positions[k] + each, latest) if lag > 0 else positions[k]
            else:
                raise ValueError(f"no rule {rule!r}")
            out[k] = max(positions[k], stop)
    return out
