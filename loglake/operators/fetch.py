"""Planned fetches: plan with a throttle rule, collect the plan (one row per
topic partition), read its ranges. The plan travels with the data so that
``OffsetStore.commit(fetched.plan)`` commits exactly what was read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from loglake.operators.accounting import UnstableSourceError
from loglake.operators.scan import plan_rows, range_scan
from loglake.plans.throttle import plan_group, plan_partition, plan_topic


@dataclass
class Fetched:
    plan: list[Row]
    data: DataFrame

    @property
    def size_bound(self) -> int:
        """Upper bound of the message count (ranges may contain gaps)."""
        return sum(r["stop_offset"] - r["start_offset"] for r in self.plan)


def _checked(rows: list[Row]) -> list[Row]:
    """Refuse plans made from negative bounds (E2); positions are clipped into the bounds, so they show them."""
    for r in rows:
        if r["start_offset"] < 0 or r["stop_offset"] < 0:
            at = f"{r['topic']}[{r['partition']}]"
            raise UnstableSourceError(f"negative bounds for {at}: {r['start_offset']}..{r['stop_offset']}")
    return rows


def fetch_plan(log, plan: DataFrame) -> Fetched:
    rows = _checked(plan_rows(plan))
    return Fetched(rows, range_scan(log, rows))


def fetch_partition(log: DataFrame, positions: DataFrame, topic: str, partition: int, max_queue=None) -> Fetched:
    """One partition throttled on its own lag (D1)."""
    one = positions.filter((F.col("topic") == topic) & (F.col("partition") == partition))
    return fetch_plan(log, plan_partition(one, max_queue))


def fetch_topic(log: DataFrame, positions: DataFrame, topic: str | None = None, max_queue=None) -> Fetched:
    """One topic under the topic rule (D2); all positioned topics, each on its
    own, when ``topic`` is None."""
    if topic is not None:
        positions = positions.filter(F.col("topic") == topic)
    return fetch_plan(log, plan_topic(positions, max_queue))


def fetch_group(log: DataFrame, positions: DataFrame, max_queue=None) -> Fetched:
    """All registered topics as one dataset under the group rule (D3), read by
    a single scan; topics without lag are left out. With no lag at all the
    result is an empty DataFrame with the log's schema."""
    return fetch_plan(log, plan_group(positions, max_queue))


def fetch_each(log: DataFrame, positions: DataFrame, max_queue=None) -> dict[str, Fetched]:
    """One dataset per lagging topic, planned together under the group rule."""
    rows = _checked(plan_rows(plan_group(positions, max_queue)))
    out: dict[str, Fetched] = {}
    for t in sorted({r["topic"] for r in rows}):
        sub = [r for r in rows if r["topic"] == t]
        out[t] = Fetched(sub, range_scan(log, sub))
    return out
