"""Positions of streaming queries in the OFFSETS table, so that lag covers them like any other group.

A listener turns the end offsets of each progress event into a commit of a group: the positions that the query's checkpoint
has passed. The checkpoint stays what the query restarts from; the rows are for the accounting (lag, watermarks, seeks of
other groups). Events come in the order of batches and are stored once each; an event that repeats a position adds nothing.
"""

from __future__ import annotations

import json
import logging

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from loglake.sources.offsets import OffsetStore

logger = logging.getLogger(__name__)


def positions_of(end_offset: str | dict | None) -> list[tuple[str, int, int]]:
    """(topic, partition, position) of a source's end offset in the form {topic: {partition: offset}}."""
    if not end_offset:
        return []
    parsed = json.loads(end_offset) if isinstance(end_offset, str) else end_offset
    if not isinstance(parsed, dict) or not all(isinstance(v, dict) for v in parsed.values()):
        return []  # a source of another kind
    return [(t, int(p), int(o)) for t, parts in sorted(parsed.items()) for p, o in sorted(parts.items())]


class PositionListener(StreamingQueryListener):
    """Stores the positions of the queries in ``groups`` (query name: group)."""

    def __init__(self, store: OffsetStore, groups: dict[str, str]):
        self.store, self.groups = store, dict(groups)
        self.names: dict[str, str] = {}
        self.ended: set[str] = set()

    def onQueryStarted(self, event):
        self.names[str(event.id)] = event.name

    def onQueryProgress(self, event):
        p = event.progress
        group = self.groups.get(p.name)
        if group is None:
            return
        for source in p.sources:
            moved = [x for x in positions_of(source.endOffset) if x[2] > 0]
            self.store.seek(group, moved)  # stores what differs

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.ended.add(self.names.get(str(event.id), ""))


def follow_positions(spark: SparkSession, store: OffsetStore, groups: dict[str, str]) -> PositionListener:
    """Start storing the positions of the session's queries by name; ``spark.streams.removeListener`` ends it."""
    listener = PositionListener(store, groups)
    spark.streams.addListener(listener)
    return listener


def flushed(spark: SparkSession, millis: int = 30_000) -> None:
    """Wait until every event so far has been delivered."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(millis)
