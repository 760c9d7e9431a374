"""The partitioned log table: build one from any table, write, read, append.

Files hold runs of offsets of one topic partition, sorted by offset. A chain of small records names the files that count,
with their bounds: a range read opens exactly the files that overlap its ranges and skips row groups by the ``offset``
statistics, the bounds of a log need neither files nor footers, its end survives retention, and many writers may add to it
at once.
"""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Callable, Iterable
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loglake.operators.numbering import number_within
from loglake.operators.sizing import broadcast_if_small, file_tasks
from loglake.schema import LOG, LOG_COLUMNS, PARTITION_KEY
from loglake.session import delete_path, path_exists
from loglake.sources.chain import Chain
from loglake.sources.log_state import LogState, Overtaken

logger = logging.getLogger(__name__)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_log(
    df: DataFrame,
    topic: str | Column,
    partition: str | Column,
    order_by: list[str],
    key: str | Column | None = None,
    value: str | Column | None = None,
    timestamp: str | Column | None = None,
    base: str | None = None,
) -> DataFrame:
    """Turn rows of ``df`` into log messages.

    Offsets are dense per (topic, partition), in ``order_by`` order, starting at
    0 or at column ``base`` (for appends). Keys and values are stored as bytes;
    string columns are UTF-8 encoded. A null topic or partition is an error."""

    def given(c: str | Column, kind: str, name: str) -> Column:
        return F.coalesce(_col(c).cast(kind), F.raise_error(F.lit(f"a message has no {name}")).cast(kind)).alias(name)

    order_cols = [f"_o{i}" for i in range(len(order_by))]
    staged = df.select(
        given(topic, "string", "topic"),
        given(partition, "int", "partition"),
        (_col(timestamp).cast("timestamp") if timestamp is not None else F.lit(None).cast("timestamp")).alias(
            "timestamp"
        ),
        (_col(key).cast("binary") if key is not None else F.lit(None).cast("binary")).alias("key"),
        (_col(value).cast("binary") if value is not None else F.lit(None).cast("binary")).alias("value"),
        *([F.col(base).alias("_base")] if base else []),
        *[F.col(c).alias(a) for c, a in zip(order_by, order_cols)],
    )
    numbered = number_within(staged, PARTITION_KEY, order_cols, out="offset", base="_base" if base else None)
    log = numbered.select(*LOG_COLUMNS)
    log.scratch = numbered.scratch
    return log


def write_log(log: DataFrame, path: str, mode: str = "overwrite", files_per_partition: int | None = None) -> None:
    """Write messages that have their offsets (``to_log``) as a log table: in place of what is there, or, with
    ``mode="append"``, behind it. ``files_per_partition`` asks for that many range tasks; without it they follow from the
    size of the input. Scratch copies that ``to_log`` made of these rows are deleted."""
    spark = log.sparkSession
    if mode == "overwrite":
        delete_path(spark, path)
    LogTable(spark, path).append(log, files_per_partition)
    for copy in getattr(log, "scratch", []):
        delete_path(spark, copy)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All messages of a log at ``path`` (LOG schema)."""
    return LogTable(spark, path).read()


LEASE_SEC = 3600.0  # a write that takes longer than its reservation is refused
CUT_TERMS = 1000  # retained offsets that a read states as literals


class LogTable:
    """A log at ``path``: Parquet files below ``write=<id>/topic=<t>/partition=<p>``, and a chain of records that says which
    files count (``log_state.LogState``).

    Any number of writers may add to it at once. A write reserves its offsets, writes its files into its own folder, takes
    their bounds from the files, and shows them all by one record; a writer that dies leaves a gap in the offsets and
    files that nobody reads. Until a reservation is done or has lapsed (``lease_sec``), ``bounds`` end before it.

    Nothing here lists folders: reads open the files that the records name. A folder of Parquet files of another writer
    (``topic=<t>/partition=<p>``, no records) can be read; the first append makes records of its files."""

    def __init__(self, spark: SparkSession, path: str, lease_sec: float = LEASE_SEC):
        self.spark = spark
        self.path = path.rstrip("/")
        self.lease_sec = lease_sec
        self.chain = Chain(spark, f"{self.path}/_records", LogState)

    def exists(self) -> bool:
        return self.chain.exists()

    # -- reads --------------------------------------------------------------------
    def _parquet(self, paths: list[str]) -> DataFrame:
        """The messages of files or folders, whose paths are given below the table's root."""
        parts = []
        for own in (True, False):  # the folder of a write is a partition column of the layout that adopted files lack
            some = [f"{self.path}/{p}" for p in paths if p.startswith("write=") == own]
            if some:
                parts.append(self.spark.read.schema(LOG).option("basePath", self.path).parquet(*some).select(*LOG_COLUMNS))
        return reduce(DataFrame.unionByName, parts) if parts else empty_log(self.spark)

    def _foreign(self) -> bool:
        return not self.chain.exists() and path_exists(self.spark, self.path)

    def _retained(self, df: DataFrame) -> DataFrame:
        """Without the messages that retention removed from files that still hold others."""
        cut = self.chain.ask(LogState.cut)
        if not cut:
            return df
        if len(cut) <= CUT_TERMS:
            return df.filter(reduce(lambda a, b: a & b, [~((F.col("topic") == t) & (F.col("partition") == p) & (F.col("offset") < o)) for t, p, o in cut]))
        side = broadcast_if_small(self.spark.createDataFrame(cut, "topic string, partition int, _cut bigint"))
        return df.join(side, PARTITION_KEY, "left").filter("_cut is null or offset >= _cut").select(*LOG_COLUMNS)

    def read(self) -> DataFrame:
        """All messages that are shown and that retention has not removed."""
        if self._foreign():
            return self._parquet([""])
        gone, files = self.chain.ask(lambda s: (set(s.emptied()), [f.path for files in s.files.values() for f in files]))
        # a write of which all files are left is named by its folder, which Spark lists in parallel
        cut = {f.split("/", 1)[0] for f in gone}
        whole = {d for f in files if (d := f.split("/", 1)[0]).startswith("write=")} - cut
        return self._retained(self._parquet([*sorted(whole), *(f for f in files if f not in gone and f.split("/", 1)[0] not in whole)]))

    def read_ranges(self, ranges: Iterable[tuple[str, int, int, int]]) -> DataFrame:
        """The messages of the files that overlap the (topic, partition, start, stop) ranges: exactly those files."""
        ranges = list(ranges)
        if self._foreign():
            return self._foreign_partitions({r[:2] for r in ranges})
        return self._retained(self._parquet(self.chain.ask(lambda s: s.overlapping(ranges))))

    def _foreign_partitions(self, keys: set[tuple[str, int]]) -> DataFrame:
        dirs = [f"topic={_escaped(self.spark, t)}/partition={int(p)}" for t, p in sorted(keys)]
        return self._parquet([d for d in dirs if path_exists(self.spark, f"{self.path}/{d}")])

    # -- bounds -------------------------------------------------------------------
    def ends(self, topics: list[str] | None = None) -> dict[tuple[str, int], tuple[int, int]]:
        """(earliest, latest) of each topic partition. Reservations that have lapsed are ended."""
        if self._foreign():
            rows = self._foreign_bounds().collect()
            return {(r["topic"], r["partition"]): (r["earliest"], r["latest"]) for r in rows if topics is None or r["topic"] in topics}
        now = time.time()
        for write in self.chain.ask(lambda s: s.lapsed(now)):
            logger.warning("the write %s of %s has lapsed", write, self.path)
            self.chain.append(lambda s, w=write: {"kind": "abort", "id": w} if w in s.open else None)
        bounds = self.chain.ask(LogState.bounds)
        return {k: v for k, v in sorted(bounds.items()) if topics is None or k[0] in topics}

    def bounds(self, topics: list[str] | None = None) -> DataFrame:
        """WATER of the table (optionally of some topics): one row per topic partition, of no files and no footers."""
        return _local(self.spark, [(*k, a, z) for k, (a, z) in self.ends(topics).items()], "topic string, partition int, earliest bigint, latest bigint")

    def next_offsets(self) -> DataFrame:
        """The first free offset of each partition, after every write that was begun."""
        rows = [(*k, z) for k, (_, z) in self.ends().items()] if self._foreign() else self.chain.ask(lambda s: [(*k, s.next_offset(k)) for k in sorted({*s.given, *s.latest})])
        return _local(self.spark, rows, "topic string, partition int, latest bigint")

    def _foreign_bounds(self) -> DataFrame:
        """Bounds of files that another writer made: MIN/MAX from Parquet
        footers through the V2 source, in a session of its own (the settings
        that choose this path are not the caller's)."""
        logger.warning("%s has no records; its bounds come from the footers of all files", self.path)
        own = self.spark.newSession()
        sources = own.conf.get("spark.sql.sources.useV1SourceList")
        own.conf.set("spark.sql.sources.useV1SourceList", ",".join(x for x in sources.split(",") if x.strip() != "parquet"))
        own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        df = own.read.schema(LOG).option("basePath", self.path).parquet(self.path)
        rows = df.groupBy(*PARTITION_KEY).agg(F.min("offset").alias("earliest"), (F.max("offset") + 1).alias("latest")).collect()
        return _local(self.spark, [tuple(r) for r in rows], "topic string, partition int, earliest bigint, latest bigint")

    def offsets_at_time(self, time_us: int, topics: list[str] | None = None) -> DataFrame:
        """topic, partition, offset: the first message of that time (in microseconds) or later, ``latest`` where there is
        none. The times of files tell which one to open: one per partition, however long the log."""
        if self._foreign():
            raise ValueError(f"{self.path} has no records of its files' times")
        ends = self.ends(topics)
        files = {k: f for k, f in self.chain.ask(lambda s: s.from_time(time_us)).items() if k in ends}
        water = _local(self.spark, [(*k, a, z) for k, (a, z) in ends.items()], "topic string, partition int, earliest bigint, latest bigint")
        later = self._parquet([f.path for some in files.values() for f in some]).filter(F.col("timestamp") >= F.timestamp_micros(F.lit(time_us)))
        bounded = later.join(broadcast_if_small(water), PARTITION_KEY).filter("offset >= earliest and offset < latest")
        first = bounded.groupBy(*PARTITION_KEY).agg(F.min("offset").alias("offset"))
        return water.join(first, PARTITION_KEY, "left").select(*PARTITION_KEY, F.coalesce("offset", "latest").alias("offset"))

    # -- writes -------------------------------------------------------------------
    def _write_files(self, log: DataFrame, write: str, tasks: int | None) -> list[list]:
        """Write messages into a folder of their own; the records of its files, read from the files."""
        keys = [*PARTITION_KEY, "offset"]
        src = log.select(*LOG_COLUMNS)
        ranged = src.repartitionByRange(tasks or file_tasks(src), *keys)
        folder = f"{self.path}/write={write}"
        # ranges of the sorted offsets: every file covers one run of one topic partition
        ranged.sortWithinPartitions(*keys).write.mode("overwrite").partitionBy(*PARTITION_KEY).parquet(folder)
        return self._described([folder], f"write={write}/")

    def _described(self, folders: list[str], prefix: str) -> list[list]:
        """One row for each file below the folders; columns other than offset and time are not read."""
        made = self.spark.read.schema(LOG).option("basePath", self.path).parquet(*folders)
        micros = F.unix_micros("timestamp")
        rows = made.groupBy(*PARTITION_KEY, F.col("_metadata.file_name").alias("file")).agg(
            F.min("offset").alias("low"), (F.max("offset") + 1).alias("latest"), F.count(F.lit(1)).alias("rows"), F.min(micros).alias("first"), F.max(micros).alias("last")
        )
        escaped: dict[str, str] = {}
        out = []
        for r in rows.collect():
            t = escaped.setdefault(r["topic"], _escaped(self.spark, r["topic"]))
            out.append([r["topic"], r["partition"], r["low"], r["latest"], r["rows"], r["first"], r["last"], f"{prefix}topic={t}/partition={r['partition']}/{r['file']}"])
        return sorted(out)

    def _adopt(self) -> None:
        """Make records of the files of another writer, so that what was there stays there."""
        if self._foreign():
            files = self._described([self.path], "")
            if files:
                self.chain.append(lambda s: None if s.given else {"kind": "begin", "id": "adopted", "until": 0, "ranges": _ranges(files), "files": files})

    def _begin(self, write: str, wanted: Callable[[LogState], list[list]], files: list[list] | None = None) -> list[list]:
        """Reserve the ranges that ``wanted`` finds free, and show the files if they are there; those ranges."""

        def wish(s: LogState) -> dict:
            ranges = wanted(s)
            for t, p, a, _ in ranges:
                if a < s.next_offset((t, p)):
                    raise Overtaken(f"offsets from {a} of {t}[{p}] are given out up to {s.next_offset((t, p))}")
            record = {"kind": "begin", "id": write, "until": time.time() + self.lease_sec, "ranges": ranges}
            return record if files is None else {**record, "files": files}

        return self.chain.append(wish)["ranges"]

    def _finish(self, write: str, files: list[list]) -> None:
        def wish(s: LogState) -> dict:
            if write not in s.open:
                raise Overtaken(f"the reservation of the write {write} to {self.path} has lapsed")
            return {"kind": "done", "id": write, "files": files}

        self.chain.append(wish)

    def append(self, log: DataFrame, tasks: int | None = None) -> None:
        """Add messages that have their offsets (``to_log``, ``append_records``). ``Overtaken`` if another write was given
        some of them; its files are then removed."""
        self._adopt()
        write = uuid.uuid4().hex
        files = self._write_files(log, write, tasks)
        try:
            self._begin(write, lambda s: _ranges(files), files)
        except Overtaken:
            delete_path(self.spark, f"{self.path}/write={write}")
            raise

    def publish(self, records: DataFrame, order_by: list[str]) -> str:
        """Add ``records`` (topic, partition, timestamp, key, value and ``order_by``) after the end of their partitions,
        also while others do so. Returns the id of the write. The records are evaluated once."""
        self._adopt()
        write = uuid.uuid4().hex
        numbered = to_log(records, "topic", "partition", order_by, key="key", value="value", timestamp="timestamp")
        sizes = [(r["topic"], r["partition"], int(r["n"])) for r in numbered.groupBy(*PARTITION_KEY).agg(F.count(F.lit(1)).alias("n")).collect()]
        ranges = self._begin(write, lambda s: [[t, p, s.next_offset((t, p)), s.next_offset((t, p)) + n] for t, p, n in sorted(sizes)])
        starts = broadcast_if_small(_local(self.spark, [(t, p, a) for t, p, a, _ in ranges], "topic string, partition int, _start bigint"))
        placed = numbered.join(starts, PARTITION_KEY).withColumn("offset", F.col("offset") + F.col("_start"))
        self._finish(write, self._write_files(placed, write, None))
        for copy in numbered.scratch:
            delete_path(self.spark, copy)
        return write

    # -- retention ----------------------------------------------------------------
    def truncate(self, earliest: dict[tuple[str, int], int]) -> None:
        """Retention removes messages below these offsets: no read returns them from here on. The end of each partition
        stays known. ``sweep`` frees the space."""
        self._adopt()
        self.chain.append(lambda s: {"kind": "retain", "ends": [[t, int(p), int(o)] for (t, p), o in sorted(earliest.items())]})

    def sweep(self) -> int:
        """Delete the files that retention emptied; returns how many. A reader that still works on them fails, it does not
        read less."""
        gone: list[str] = []

        def wish(s: LogState) -> dict | None:
            gone[:] = s.emptied()
            return {"kind": "drop", "paths": gone[:]} if gone else None

        self.chain.append(wish)
        for path in gone:
            delete_path(self.spark, f"{self.path}/{path}")
        return len(gone)


def _ranges(files: list[list]) -> list[list]:
    """[topic, partition, start, stop] of the files of a write."""
    span: dict[tuple[str, int], tuple[int, int]] = {}
    for t, p, low, latest, *_ in files:
        a, z = span.get((t, p), (low, latest))
        span[(t, p)] = min(a, low), max(z, latest)
    return [[t, p, a, z] for (t, p), (a, z) in sorted(span.items())]


def _escaped(spark: SparkSession, topic: str) -> str:
    """The topic as the name of its folder."""
    return spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(topic)


def _local(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Rows of metadata as a local relation: no tasks read them."""
    names = [c.split()[0] for c in schema.split(", ")]
    return spark.createDataFrame(pd.DataFrame(rows, columns=names), schema) if rows else spark.createDataFrame([], schema)


def empty_log(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LOG)


def append_records(target: DataFrame | LogTable, records: DataFrame, order_by: list[str]) -> DataFrame:
    """Messages of ``records`` (columns topic, partition, timestamp, key, value
    plus ``order_by``) given offsets that continue each target partition after
    its ``latest`` (0 for a partition the target does not have yet); of a
    ``LogTable`` that end survives retention. Returns only the new messages;
    ``LogTable.append`` adds them unless others were faster, ``LogTable.publish`` adds records whoever else writes."""
    from loglake.operators.accounting import watermarks

    ends = target.next_offsets() if isinstance(target, LogTable) else watermarks(target)
    water = broadcast_if_small(ends.select(*PARTITION_KEY, F.col("latest").alias("_latest")))
    based = records.join(water, PARTITION_KEY, "left").withColumn("_start", F.coalesce("_latest", F.lit(0)))
    return to_log(
        based,
        "topic",
        "partition",
        order_by,
        key="key",
        value="value",
        timestamp="timestamp",
        base="_start",
    )


# --- optional Kafka connector ------------------------------------------------


def kafka_range_options(ranges: list[tuple[str, int, int, int]]) -> dict[str, str]:
    """``startingOffsets``/``endingOffsets`` JSON for Spark's Kafka batch source
    from (topic, partition, start, stop) ranges, so a plan of this engine can
    drive ``spark.read.format("kafka")`` when the connector jar is present."""
    import json

    start: dict[str, dict[str, int]] = {}
    stop: dict[str, dict[str, int]] = {}
    for topic, partition, lo, hi in ranges:
        start.setdefault(topic, {})[str(partition)] = int(lo)
        stop.setdefault(topic, {})[str(partition)] = int(hi)
    return {
        "assign": json.dumps({t: sorted(int(p) for p in ps) for t, ps in start.items()}),
        "startingOffsets": json.dumps(start),
        "endingOffsets": json.dumps(stop),
    }


def read_kafka_ranges(spark: SparkSession, bootstrap: str, ranges: list[tuple[str, int, int, int]]) -> DataFrame:
    """Range read from a live Kafka cluster through Spark's own connector (needs
    the spark-sql-kafka jar; not available in the test environment)."""
    return (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .options(**kafka_range_options(ranges))
        .load()
        .select(*LOG_COLUMNS)
    )
