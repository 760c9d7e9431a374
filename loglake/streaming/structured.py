"""Structured Streaming forms: a log as a stream, throttled triggers,
``foreachBatch`` sinks that are idempotent per batch id, streaming dedup,
several queries in one session.

Throttling here is Spark's: a file log is throttled by files per trigger
(``maxFilesPerTrigger``), the Kafka source by offsets per trigger
(``maxOffsetsPerTrigger``, proportional to lag). Exact per-message throttles
with lag gates belong to the planned loop (``processor.Processor``).
Positions live in the query's checkpoint: a failed batch is re-run with the
same batch id and the same input after a restart.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from loglake.operators.sink import write_batch
from loglake.schema import LOG
from loglake.sources.log import LogTable


def stream_log(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The files of a log folder read as a stream, throttled by files. It reads all files that are there, also those of
    writes that a ``LogTable`` does not show yet: ``log_source.stream_table`` follows its records."""
    own = LogTable(spark, path).exists()  # its writes are a partition column of the layout
    reader = spark.readStream.schema(T.StructType([*LOG.fields, T.StructField("write", T.StringType())]) if own else LOG)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.parquet(path).select(*LOG.names)


def stream_kafka(spark: SparkSession, bootstrap: str, topics: list[str], max_offsets_per_trigger: int | None = None,
                 starting: str = "earliest", min_offsets_per_trigger: int | None = None,
                 max_trigger_delay: str | None = None) -> DataFrame:
    """Spark's Kafka source with the LOG column names (needs the connector
    jar). ``max_offsets_per_trigger`` is the throttle (split in proportion to
    partition lag); ``min_offsets_per_trigger`` with ``max_trigger_delay`` is
    the streaming form of a 'bucket full or X time elapsed' gate."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting)
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", int(max_offsets_per_trigger))
    if min_offsets_per_trigger:
        reader = reader.option("minOffsetsPerTrigger", int(min_offsets_per_trigger))
    if max_trigger_delay:
        reader = reader.option("maxTriggerDelay", max_trigger_delay)
    return reader.load().select("topic", "partition", "offset", "timestamp", "key", "value")


def batch_sink(root: str, transform: Callable[[DataFrame], DataFrame] | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function writing batch ``n`` to ``<root>/batch_id=n``
    (overwrite: a replayed batch replaces its first attempt)."""

    def fn(df: DataFrame, batch_id: int) -> None:
        write_batch(transform(df) if transform else df, root, batch_id)

    return fn


def run_available_now(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
                      name: str | None = None) -> StreamingQuery:
    """Start a bounded drain: everything available now, in throttled batches."""
    w = df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return (w.queryName(name) if name else w).start()


def run_every(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str, interval: str,
              name: str | None = None) -> StreamingQuery:
    """Start an unbounded stream with one micro-batch per ``interval`` (the
    timed gate); stop it with ``query.stop()`` -- the running batch finishes
    and its offsets are committed, the next start resumes after them."""
    w = df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint).trigger(processingTime=interval)
    if name:
        w = w.queryName(name)
    return w.start()


def await_all(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Wait until every query has ended (several queries run concurrently in
    one session); re-raise the first failure. Waits per query: the session's
    ``awaitAnyTermination`` would also report queries of other callers."""
    errors = []
    for q in queries:
        try:
            q.awaitTermination()
        except Exception as e:  # noqa: BLE001 - collected, raised below
            errors.append(e)
    if errors:
        raise errors[0]


def dedup_within(df: DataFrame, id_cols: list[str], event_time: str = "timestamp", delay: str = "60 days") -> DataFrame:
    """Streaming dedup by id: state is kept per id only until the watermark
    (max event time seen minus ``delay``) passes it, so state is bounded by
    the ids of one delay window, and a copy that comes after that is a new
    message. State holds keys and times, not messages.

    A message whose id has a null equals no other: its key is its place in the
    log. A hot id is no hot state (one row), but its messages meet in one task
    of a batch; where that matters, ``dedup_batch`` the batch first or throttle
    the batches."""
    whole = F.lit(True)
    for c in id_cols:
        whole = whole & F.col(c).isNotNull()
    place = F.struct("topic", "partition", "offset")
    keyed = df.withColumn("_key", F.when(whole, F.to_json(F.struct(*id_cols))).otherwise(F.concat(F.lit("@"), F.to_json(place))))
    return keyed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["_key"]).drop("_key")


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stateful_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session of its own for a stateful query, which keeps its state in
    RocksDB on local disk (unless the caller's session chose another provider)
    in ``state_partitions`` partitions. Both are recorded in the query's
    checkpoint at its first run; the caller's settings stay as they are."""
    own = spark.newSession()
    key = "spark.sql.streaming.stateStore.providerClass"
    current = spark.conf.get(key, None)
    if current and not current.endswith("HDFSBackedStateStoreProvider"):
        own.conf.set(key, current)
    else:
        own.conf.set(key, ROCKSDB_PROVIDER)
        # each batch uploads a change log instead of RocksDB snapshot files
        own.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    if state_partitions:
        own.conf.set("spark.sql.shuffle.partitions", str(int(state_partitions)))
    return own


def on_terminated(spark: SparkSession, hook: Callable[[str, str | None], None]):
    """Run ``hook(query_id, exception)`` when any streaming query of the
    session ends (the reference's ``stopped()``). Returns the listener, for
    ``spark.streams.removeListener``."""
    from pyspark.sql.streaming import StreamingQueryListener

    class _Stopped(StreamingQueryListener):
        def onQueryStarted(self, event):
            pass

        def onQueryProgress(self, event):
            pass

        def onQueryIdle(self, event):
            pass

        def onQueryTerminated(self, event):
            hook(str(event.id), event.exception)

    listener = _Stopped()
    spark.streams.addListener(listener)
    return listener
