"""Duplicates in a stream, with ids that expire by event-time timers.

Per id the state holds one row, the place of its survivor, and a timer. The survivor of a batch is the copy with the least
(topic, partition, offset), whatever the order in which rows arrive. Once the watermark passes the survivor's time plus
``keep``, the id is forgotten (a timer frees its state), and a later copy is a new message (unlike a copy that comes before:
that one is dropped and does not prolong the id). Late rows, behind the watermark, are dropped by Spark.

Copies of one id are reduced on the map side before they meet: each Arrow batch of an input task sends one row per id, so an
id that a third of the rows carry is a few rows for its state. A message without an id equals no other: its place is its id.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StringType, StructField, StructType

PLACE = ["topic", "partition", "offset"]


def _reduced(event_time: str):
    """One row per ``_key`` of each Arrow batch, the one that stands first in the log, and the latest row of the batch: the
    watermark follows what came, not what stays."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in frames:
            if len(rows):
                first = rows.sort_values(PLACE, kind="stable").drop_duplicates("_key")
                yield pd.concat([first, rows.loc[[rows[event_time].idxmax()]]])

    return run


class FirstUntilExpiry(StatefulProcessor):
    def __init__(self, keep_ms: int, event_time: str, columns: list[str]):
        self.keep_ms, self.event_time, self.columns = keep_ms, event_time, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "until bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frames = list(rows)  # a row or two for each input batch of a task
        watermark = timerValues.getCurrentWatermarkInMs()
        # a batch's timers go off after its rows: what the watermark has passed is expired all the same
        if self.seen.exists() and self.seen.get()[0] > watermark:
            return
        first = pd.concat(frames).sort_values(PLACE, kind="stable").iloc[:1]
        at = first[self.event_time].iloc[0]
        until = max(int(at.timestamp() * 1000) + self.keep_ms, watermark + 1)
        self.seen.update((until,))
        self.handle.registerTimer(until)
        yield first[self.columns]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.seen.exists() and self.seen.get()[0] <= timerValues.getCurrentWatermarkInMs():
            self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def dedup_until_expiry(stream: DataFrame, id_cols: list[str], keep_ms: int, delay: str, event_time: str = "timestamp") -> DataFrame:
    """The first copy of each id, until it expires ``keep_ms`` after that copy's time. ``delay`` is the watermark's: how late
    messages may come. Rows without a time are dropped with the late ones. Needs the RocksDB state store
    (``structured.stateful_session``)."""
    whole = F.lit(True)
    for c in id_cols:
        whole = whole & F.col(c).isNotNull()
    key = F.when(whole, F.to_json(F.struct(*id_cols))).otherwise(F.concat(F.lit("@"), F.to_json(F.struct(*PLACE))))
    keyed = stream.filter(F.col(event_time).isNotNull()).withColumn("_key", key)
    reduced = keyed.mapInPandas(_reduced(event_time), StructType([*stream.schema.fields, StructField("_key", StringType())]))
    return reduced.withWatermark(event_time, delay).groupBy("_key").transformWithStateInPandas(
        FirstUntilExpiry(keep_ms, event_time, stream.columns), stream.schema, outputMode="append", timeMode="eventTime"
    )
