"""Offset-range reads of a log.

A plan is a handful of ranges -- one per topic partition and group -- so it is
held on the driver as values (plans are values: a replay reads exactly the
same ranges). A scan has UNION ALL meaning at every plan size: a message comes
once for each range that holds it. Two physical forms:

* up to ``LITERAL_SCANS`` scans of ``LITERAL_RANGES`` ranges: unions of scans
  with an OR of literal ``topic = .. AND partition = .. AND offset >= .. AND
  offset < ..`` terms. Catalyst turns the topic/partition part into directory
  pruning and pushes each partition's own offset bounds into the Parquet
  reader. Ranges that overlap go to different scans;
* beyond: one scan, joined on (topic, partition, band of offsets) with one row
  per range and band, broadcast up to ``BROADCAST_RANGES`` ranges.

Of a ``LogTable`` either form opens the files that overlap a range, found in the
sorted bounds of its files, and no others.

Empty ranges are dropped first; ranges may cover gaps in the offsets, so
``stop - start`` bounds the row count instead of equalling it.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglake.schema import PARTITION_KEY

LITERAL_RANGES = 64
LITERAL_SCANS = 16
BROADCAST_RANGES = 1_000_000

Range = tuple[str, int, int, int]  # topic, partition, start (incl.), stop (excl.)

_RANGE_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType(), False),
        T.StructField("partition", T.IntegerType(), False),
        T.StructField("start_offset", T.LongType(), False),
        T.StructField("stop_offset", T.LongType(), False),
    ]
)


def as_ranges(plan, topic: str | None = None) -> list[Range]:
    """Normalise a plan to a list of ranges. Accepts PLAN rows, a list of
    (topic, partition, start, stop) tuples, ``{partition: (start, stop)}`` with
    ``topic`` given (the reference's map form), ``{(topic, partition): (start,
    stop)}``, or a small plan DataFrame (collected: one row per partition)."""
    if isinstance(plan, DataFrame):
        plan = plan.select("topic", "partition", "start_offset", "stop_offset").collect()
    if isinstance(plan, Mapping):
        out = []
        for k, (lo, hi) in plan.items():
            if isinstance(k, tuple):
                out.append((str(k[0]), int(k[1]), int(lo), int(hi)))
            else:
                if topic is None:
                    raise ValueError("a {partition: (start, stop)} plan needs topic=")
                out.append((topic, int(k), int(lo), int(hi)))
        return out
    out = []
    for r in plan:
        if isinstance(r, Row):
            out.append((r["topic"], int(r["partition"]), int(r["start_offset"]), int(r["stop_offset"])))
        else:
            t, p, lo, hi = r
            out.append((str(t), int(p), int(lo), int(hi)))
    return out


def _literal_filter(ranges: list[Range]):
    by_topic: dict[str, list[Range]] = {}
    for r in ranges:
        by_topic.setdefault(r[0], []).append(r)
    terms = []
    for t, rs in by_topic.items():
        inner = reduce(
            lambda a, b: a | b,
            [
                (F.col("partition") == p) & (F.col("offset") >= lo) & (F.col("offset") < hi)
                for _, p, lo, hi in rs
            ],
        )
        terms.append((F.col("topic") == t) & inner)
    return reduce(lambda a, b: a | b, terms)


def _band_join(log: DataFrame, side: DataFrame, width: int, small: bool) -> DataFrame:
    """Rows of ``log`` once for each range that holds them. Offsets are cut into bands of ``width``, a range stands in each
    band that it touches, so a message meets the ranges of its band only, not all of its partition's."""
    cols = log.columns
    banded = side.select(*side.columns, F.explode(F.sequence(F.expr(f"start_offset div {width}"), F.expr(f"(stop_offset - 1) div {width}"))).alias("_band"))
    joined = log.withColumn("_band", F.expr(f"offset div {width}")).join(F.broadcast(banded) if small else banded, [*PARTITION_KEY, "_band"])
    return joined.filter((F.col("offset") >= F.col("start_offset")) & (F.col("offset") < F.col("stop_offset"))).select(*cols)


def _layers(ranges: list[Range]) -> list[list[Range]]:
    """Ranges in as few lists as their overlaps allow; inside a list no two overlap."""
    layers: list[list[Range]] = []
    ends: list[dict[tuple[str, int], int]] = []
    for r in sorted(ranges, key=lambda r: (r[0], r[1], r[2], r[3])):
        key = (r[0], r[1])
        for layer, end in zip(layers, ends):
            if end.get(key, r[2]) <= r[2]:
                break
        else:
            layer, end = [], {}
            layers.append(layer)
            ends.append(end)
        layer.append(r)
        end[key] = r[3]
    return layers


def range_scan(log, plan, topic: str | None = None) -> DataFrame:
    """Messages of ``log`` (a DataFrame or a ``LogTable``) inside the plan's
    half-open ranges, once for each range. A plan given as a DataFrame is
    counted first and only collected when it is bounded. Of a ``LogTable``
    only the files that overlap a range are opened, at every plan size."""
    table = None if isinstance(log, DataFrame) else log
    if isinstance(plan, DataFrame):
        side = plan.select("topic", "partition", "start_offset", "stop_offset").filter(
            F.col("stop_offset") > F.col("start_offset")
        )
        n, total = side.agg(F.count(F.lit(1)), F.sum(F.col("stop_offset") - F.col("start_offset"))).first()
        if n > BROADCAST_RANGES:
            return _band_join(table.read() if table else log, side, max(1, total // n), small=False)
        plan = side
    ranges = [r for r in as_ranges(plan, topic) if r[3] > r[2]]
    if not ranges:
        return (table.read() if table else log).filter(F.lit(False))
    scans = [layer[i : i + LITERAL_RANGES] for layer in _layers(ranges) for i in range(0, len(layer), LITERAL_RANGES)] if len(ranges) <= LITERAL_SCANS * LITERAL_RANGES else []
    if scans and len(scans) <= LITERAL_SCANS:
        parts = [(table.read_ranges(s) if table else log).filter(_literal_filter(s)) for s in scans]
        return reduce(DataFrame.unionByName, parts)
    # many ranges, or many on top of each other: one scan, between the least and the greatest offset
    low, high = min(r[2] for r in ranges), max(r[3] for r in ranges)
    source = (table.read_ranges(ranges) if table else log).filter((F.col("offset") >= low) & (F.col("offset") < high))
    topics = sorted({r[0] for r in ranges})
    if len(topics) <= LITERAL_RANGES:
        source = source.filter(F.col("topic").isin(*topics))
    side = source.sparkSession.createDataFrame(pd.DataFrame(ranges, columns=_RANGE_SCHEMA.names), _RANGE_SCHEMA)
    width = max(1, sum(r[3] - r[2] for r in ranges) // len(ranges))  # so that the bands of all ranges are at most twice as many
    return _band_join(source, side, width, len(ranges) <= BROADCAST_RANGES)


def plan_rows(plan: DataFrame) -> list[Row]:
    """Collect a plan (one row per topic partition) as values for the driver."""
    return plan.orderBy("group_id", "topic", "partition").collect()


def ranges_of(rows: Iterable[Row]) -> list[Range]:
    return as_ranges(list(rows))
