"""A log table as a stream whose batches are throttled exactly, message by message.

A Python data source: ``latestOffset`` applies a throttle rule (``plans.throttle.stops``) to the stream's positions and the
bounds in the table's records, so a batch holds the same offsets as one of the planned loop. Positions are the stream's
offsets, one per topic partition, kept in the query's checkpoint; a batch that failed is run again over the same offsets.
Each file that overlaps the batch is one task, which reads its rows as Arrow batches.

The source needs no session on the reading side: records and files are opened with Arrow's file systems, so the table must
lie in a store they know (local, HDFS, S3, GCS).
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from loglake.plans.throttle import stops
from loglake.schema import LOG
from loglake.session import register_source
from loglake.sources.chain import folded
from loglake.sources.log_state import LogState

NAME = "loglake"
_ARROW = pa.schema(
    [
        ("topic", pa.string()),
        ("partition", pa.int32()),
        ("offset", pa.int64()),
        ("timestamp", pa.timestamp("us", tz="UTC")),
        ("key", pa.binary()),
        ("value", pa.binary()),
    ]
)


class StreamDataLossError(RuntimeError):
    """Messages that the stream has not read have left the table."""


@dataclass
class FileRange(InputPartition):
    root: str  # may be a URI
    path: str  # below it, as it is in the store
    topic: str
    partition: int
    start: int
    stop: int


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    return pafs.LocalFileSystem(), path


def _positions(offset: dict) -> dict[tuple[str, int], int]:
    return {(t, int(p)): int(o) for t, parts in offset.items() for p, o in parts.items()}


def _offset(positions: dict[tuple[str, int], int]) -> dict:
    out: dict[str, dict[str, int]] = {}
    for (t, p), o in sorted(positions.items()):
        out.setdefault(t, {})[str(p)] = o
    return out


class LogStreamReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"].rstrip("/")
        self.max_queue = {t: int(q) for t, q in json.loads(options["maxqueue"]).items()}
        self.rule = options.get("rule", "topic")
        self.starting = options.get("starting", "earliest")
        self.checkpoint = options["checkpoint"].rstrip("/")
        self.source = int(options.get("source", "0"))
        self.state: tuple[LogState, int] | None = None
        self.first: dict | None = None
        self.end: dict[tuple[str, int], int] | None = None

    def _bounds(self) -> dict[tuple[str, int], tuple[int, int]]:
        fs, root = _opened(f"{self.path}/_records")
        self.state = folded(fs, root, LogState, self.state)
        return {k: v for k, v in self.state[0].bounds().items() if k[0] in self.max_queue}

    def initialOffset(self) -> dict:
        if self.first is None:
            at = 0 if self.starting == "earliest" else 1
            self.first = _offset({k: b[at] for k, b in self._bounds().items()})
        return self.first

    def _planned(self) -> dict | None:
        """The end of the last batch that the query's checkpoint knows, done or not: Spark runs it before it asks for more."""
        fs, folder = _opened(f"{self.checkpoint}/offsets")
        found = fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
        batches = [int(f.base_name) for f in found if f.base_name.isdigit()]
        if not batches:
            return None
        with fs.open_input_stream(f"{folder}/{max(batches)}") as f:
            lines = f.read().decode().split("\n")
        return json.loads(lines[2 + self.source])  # after the version and the batch's settings

    def latestOffset(self) -> dict:
        if self.end is None:
            self.end = _positions(self._planned() or self.initialOffset())
        bounds = self._bounds()
        for k, (earliest, _) in bounds.items():
            self.end.setdefault(k, earliest)  # a partition that came later
        self.end = stops(self.end, bounds, self.max_queue, self.rule)
        return _offset(self.end)

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        begin, bounds = _positions(start), self._bounds()
        out: list[InputPartition] = []
        for (t, p), stop in _positions(end).items():
            earliest, latest = bounds.get((t, p), (0, -1))
            a = begin.get((t, p), earliest)
            if a >= stop:
                continue
            if a < earliest or stop > latest:
                raise StreamDataLossError(f"{t}[{p}] {a}..{stop} is to be read, the table has {earliest}..{latest}")
            out += [FileRange(self.path, f, t, p, a, stop) for f in self.state[0].overlapping([(t, p, a, stop)])]
        return out

    def read(self, partition: FileRange) -> Iterator[pa.RecordBatch]:
        fs, root = _opened(partition.root)
        with fs.open_input_file(f"{root}/{partition.path}") as f:
            file = pq.ParquetFile(f)
            at = file.schema_arrow.get_field_index("offset")

            def meets(group: int) -> bool:
                s = file.metadata.row_group(group).column(at).statistics
                return s is None or not s.has_min_max or (s.min < partition.stop and s.max >= partition.start)

            groups = [g for g in range(file.num_row_groups) if meets(g)]
            for b in file.iter_batches(row_groups=groups, columns=["offset", "timestamp", "key", "value"]):
                offset = b.column("offset")
                b = b.filter(pc.and_(pc.greater_equal(offset, partition.start), pc.less(offset, partition.stop)))
                n = b.num_rows
                if n:
                    when = b.column("timestamp").cast(pa.timestamp("us"), safe=False).cast(pa.timestamp("us", tz="UTC"))
                    columns = [pa.array([partition.topic] * n), pa.array([partition.partition] * n, pa.int32()), b.column("offset"), when, b.column("key"), b.column("value")]
                    yield pa.RecordBatch.from_arrays(columns, schema=_ARROW)


class LogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self):
        return LOG

    def streamReader(self, schema) -> LogStreamReader:
        return LogStreamReader({k.lower(): v for k, v in self.options.items()})


def stream_table(spark: SparkSession, path: str, max_queue: dict[str, int], checkpoint: str, rule: str = "topic", starting: str = "earliest") -> DataFrame:
    """The topics of ``max_queue`` (topic: limit) of the log table at ``path`` as a stream that holds, batch for batch, what
    the rule allows. ``checkpoint`` is the location that the query will be started with."""
    register_source(spark, LogSource)
    options = {"maxQueue": json.dumps(max_queue), "rule": rule, "starting": starting, "checkpoint": checkpoint}
    return spark.readStream.format(NAME).options(**options).load(path)


def drain(query) -> None:
    """Run a started stream until no message is left that its rule would read, and stop it."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()
