"""Batch number of every record when a static backlog is drained by repeated
fetch -> commit rounds, computed in closed form (no driver loop).

With ``rel = offset - start`` and ``e = per_each`` of the topic:

* group rule (D3): every round takes ``e`` more offsets from each partition,
  so ``batch_no = rel div e``;
* topic rule (D2): rounds are partial while the remaining topic lag exceeds
  ``max_queue``; with ``rem(k) = sum_p max(0, lag_p - k*e)`` and
  ``K = min{k : rem(k) <= max_queue}``, round ``K`` takes all the rest, so
  ``batch_no = least(rel div e, K)``.

Both hold with gaps in the offsets (lag counts offsets, not records).

``K`` comes from the positions table alone (P rows per topic): sort partitions
by lag, descending; while exactly the top ``j`` partitions still lag,
``rem(k) = S_j - j*k*e`` (``S_j`` the sum of those lags), so the first ``k``
with ``rem(k) <= max_queue`` in that stretch is a division. No enumeration of
rounds, whatever the backlog.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loglake.operators.sizing import broadcast_if_small
from loglake.plans.throttle import per_each, with_max_queue
from loglake.schema import PARTITION_KEY


def _ceil_div(a, b):
    """ceil(a / b) for a >= 0, b > 0, in integer arithmetic."""
    return F.expr(f"({a} + {b} - 1) div {b}")


def full_round(positions: DataFrame) -> DataFrame:
    """Per (group, topic): ``K``, the round in which the topic rule stops
    throttling. Input needs ``per_each`` (see ``throttle.per_each``)."""
    by_lag = Window.partitionBy("group_id", "topic").orderBy(F.desc("lag"), F.asc("partition"))
    ranked = (
        positions.withColumn("lag", F.greatest(F.lit(0), F.col("latest") - F.col("position")))
        .withColumn("j", F.row_number().over(by_lag))
        .withColumn("s", F.sum("lag").over(by_lag.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("next_lag", F.coalesce(F.lead("lag").over(by_lag), F.lit(0)))
    )
    # stretch j: ceil(next_lag / e) <= k <= ceil(lag / e) - 1
    lo = _ceil_div("next_lag", "per_each")
    hi = _ceil_div("lag", "per_each") - 1
    need = _ceil_div("greatest(s - max_queue, 0)", "(j * per_each)")
    k_j = F.greatest(lo, need)
    stretch = ranked.select(
        "group_id",
        "topic",
        F.when(k_j <= hi, k_j).alias("k_j"),
        _ceil_div("lag", "per_each").alias("k_empty"),
    )
    return stretch.groupBy("group_id", "topic").agg(
        F.least(F.min("k_j"), F.max("k_empty")).cast("bigint").alias("full_round")
    )


def _partition_info(positions: DataFrame, max_queue, rule: str) -> DataFrame:
    p = per_each(with_max_queue(positions, max_queue))
    if rule == "group":
        p = p.filter(F.col("topic_lag") > 0).withColumn("full_round", F.lit(None).cast("bigint"))
    else:
        p = p.join(full_round(p), ["group_id", "topic"])
    return p.select(
        "group_id", *PARTITION_KEY, "position", "latest", "per_each", "full_round"
    )


def drain(records: DataFrame, positions: DataFrame, max_queue: int | dict | None = None, rule: str = "topic") -> DataFrame:
    """Records of the backlog ``[position, latest)`` of every positioned
    partition with the round (``batch_no``, from 0) that delivers them.
    ``records`` is a log (any columns incl. topic, partition, offset)."""
    info = broadcast_if_small(_partition_info(positions, max_queue, rule))
    rel = F.col("offset") - F.col("position")
    step = F.expr("(offset - position) div per_each")
    batch = step if rule == "group" else F.least(step, F.col("full_round"))
    return (
        records.join(info, PARTITION_KEY)
        .filter((rel >= 0) & (F.col("offset") < F.col("latest")))
        .withColumn("batch_no", batch.cast("bigint"))
        .drop("position", "latest", "per_each", "full_round")
    )


def drain_topic(records: DataFrame, positions: DataFrame, max_queue: int | dict | None = None) -> DataFrame:
    return drain(records, positions, max_queue, rule="topic")


def drain_group(records: DataFrame, positions: DataFrame, max_queue: int | dict | None = None) -> DataFrame:
    return drain(records, positions, max_queue, rule="group")


def remaining_before(positions: DataFrame, rounds: int, max_queue: int | dict | None = None) -> DataFrame:
    """Topic lag left before each round ``k`` in ``0..rounds-1`` under the topic
    rule (``rem(k)`` for partial rounds, 0 after the full round). ``rounds`` is
    a small caller-chosen count (a gate's horizon), not data-driven."""
    p = per_each(with_max_queue(positions, max_queue))
    p = p.join(full_round(p), ["group_id", "topic"])
    ks = p.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))))
    rem = F.greatest(F.lit(0), F.col("latest") - F.col("position") - F.col("k") * F.col("per_each"))
    return (
        ks.withColumn("rem_p", F.when(F.col("k") <= F.col("full_round"), rem).otherwise(F.lit(0)))
        .groupBy("group_id", "topic", "k")
        .agg(F.sum("rem_p").cast("bigint").alias("remaining"))
    )
