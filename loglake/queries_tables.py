"""Registered queries of log tables with many writers, owned positions, exact streams, committed sinks, id histories, stored
summaries and payloads without a schema. As in ``queries``, each reads the given tables through the fixture logs.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglake.functions.decode import EVENT_VALUE, json_value, utf8
from loglake.operators import accounting as acc
from loglake.operators.fetch import fetch_group
from loglake.operators.scan import range_scan
from loglake.queries import (
    GROUP_THROTTLES,
    RECORD_COLUMNS,
    SINGLE_DIV,
    _filtered,
    _lag0,
    _loop_sink,
    _positions_zero,
    _read_sink,
    _water,
    records,
)
from loglake.schema import LOG
from loglake.session import scratch_path
from loglake.sources.fixtures import event_id_of, fixture_log, fixture_path, fixture_table
from loglake.sources.log import LogTable, write_log
from loglake.sources.offsets import FencedError, OffsetStore

# Fixed query parameters.
EVERY, SPAN = 2, 3  # range_scan_many: a range of 3 offsets at every second message
PUBLISH_TARGET, PUBLISH_FROM = "click", ("purchase", "view")
GAP = 7  # offsets that a publisher reserved and never wrote
FENCED_QUEUE_DIV = 4
LAG_BATCHES = 2
POISONED = ("click", 1, 2)
TRUNCATED_EVERY = 11  # events whose payload is cut off
QUANTILES = [0.25, 0.5, 0.9]
SUMMARY_TOPIC = "view"
UNSTABLE_TOPIC = "click"


# --- log tables -----------------------------------------------------------------


def q_range_scan_many(spark, sf_dir):
    """A plan with a range at every second message, overlapping the next: a message comes once for each range."""
    tbl = fixture_table(spark, sf_dir, "events")
    start = F.col("offset").alias("start_offset")
    plan = tbl.read().filter(F.col("offset") % EVERY == 0).select("topic", "partition", start, (F.col("offset") + SPAN).alias("stop_offset"))
    return records(range_scan(tbl, plan))


def q_offsets_at_time(spark, sf_dir):
    """The first offset of each partition at the middle of the log's time span or later."""
    tbl = fixture_table(spark, sf_dir, "events")
    first, last = tbl.chain.ask(lambda s: (min(f.first for fs in s.files.values() for f in fs), max(f.last for fs in s.files.values() for f in fs)))
    return tbl.offsets_at_time((first + last) // 2)


def q_publish_concurrent(spark, sf_dir):
    """Two publishers write to one topic at once after a third reserved offsets and died: every message once, one gap."""
    path = scratch_path(spark, "target")
    log = fixture_log(spark, sf_dir, "events")
    write_log(log.filter(F.col("topic") == PUBLISH_TARGET), path)
    dead = LogTable(spark, path, lease_sec=0.0)
    parts = sorted(p for _, p in dead.ends())
    dead._begin("dead", lambda s: [[PUBLISH_TARGET, p, s.next_offset((PUBLISH_TARGET, p)), s.next_offset((PUBLISH_TARGET, p)) + GAP] for p in parts])
    errors: list[BaseException] = []

    def publish(topic: str) -> None:
        try:
            rows = log.filter(F.col("topic") == topic).select(F.lit(PUBLISH_TARGET).alias("topic"), "partition", "timestamp", "key", "value", "offset")
            LogTable(spark, path).publish(rows, ["offset"])
        except BaseException as e:  # noqa: BLE001 - raised below
            errors.append(e)

    threads = [threading.Thread(target=publish, args=(t,)) for t in PUBLISH_FROM]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    if errors:
        raise errors[0]
    target = LogTable(spark, path)
    seen = target.read().groupBy("partition").agg(F.count(F.lit(1)).alias("messages"), F.countDistinct("offset").alias("offsets"), F.countDistinct("value").alias("events"))
    return seen.join(target.bounds().select("partition", "earliest", "latest"), "partition")


def q_retention(spark, sf_dir):
    """A log from which retention removed a third of each partition, its emptied files swept: what is left, and its bounds."""
    path = scratch_path(spark, "log")
    write_log(fixture_log(spark, sf_dir, "events"), path, files_per_partition=12)
    tbl = LogTable(spark, path)
    tbl.truncate({k: z // 3 for k, (_, z) in tbl.ends().items()})
    tbl.sweep()
    left = acc.watermarks(tbl.read()).select("topic", "partition", F.col("earliest").alias("first_left"), F.col("latest").alias("end_left"))
    return tbl.bounds().join(left, ["topic", "partition"]).join(tbl.read().groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("messages")), ["topic", "partition"])


# --- positions and ownership ---------------------------------------------------------


def q_fenced_commit(spark, sf_dir):
    """Two processors of one group on one topic: the one that came later takes the topic over while the first is in its
    batch, whose commit is then refused. Positions, and who owns them."""
    from loglake.streaming.processor import Processor, TopicController

    log, root = fixture_table(spark, sf_dir, "events"), scratch_path(spark, "offsets")
    queue = max(1, _lag0(log, "click") // FENCED_QUEUE_DIV)

    def make(name, fn):
        return Processor(log, OffsetStore(spark, root), TopicController("fc", "click", queue), fn, wal_root=scratch_path(spark, "wal"), reset="earliest", name=name)

    fast = make("fast", lambda df, b: None)
    refused = False
    try:
        make("slow", lambda df, b: fast.run(stop_when_idle=True)).run(stop_when_idle=True)
    except FencedError:
        refused = True
    store = OffsetStore(spark, root)
    rows = [(t, p, o, store.owner((g, t, p))[1].split("-")[0], refused, len(fast.batches)) for (g, t, p), (o, _) in store.current("fc").items()]
    return spark.createDataFrame(rows, "topic string, partition int, committed bigint, owner string, slow_refused boolean, fast_batches bigint")


def q_refuse_unstable(spark, sf_dir):
    """Topics whose source reports negative bounds are refused before anything is planned or stored."""
    from loglake.streaming.processor import Processor, TopicController

    log = fixture_log(spark, sf_dir, "events")
    shifted = log.withColumn("offset", F.col("offset") - F.when(F.col("topic") == UNSTABLE_TOPIC, 5).otherwise(0))
    store, rows = OffsetStore(spark, scratch_path(spark, "offsets")), []
    for r in _water(fixture_table(spark, sf_dir, "events")).select("topic").distinct().collect():
        try:
            Processor(shifted, store, TopicController("ru", r["topic"]), lambda df, b: None, reset="earliest").register()
            rows.append((r["topic"], False))
        except acc.UnstableSourceError:
            rows.append((r["topic"], True))
    stored = {t for _, t, _ in store.current("ru")}
    return spark.createDataFrame([(t, refused, t in stored) for t, refused in rows], "topic string, refused boolean, stored boolean")


def q_persist_released(spark, sf_dir):
    """Each batch of the loop is kept in memory while it is processed and let go before the next one."""
    from loglake.streaming.processor import Processor, TopicController

    log, held = fixture_table(spark, sf_dir, "events"), []

    def process(df: DataFrame, batch_id: int) -> None:
        before = [d.storageLevel.useMemory for _, d, _, _ in held]
        held.append((batch_id, df, df.storageLevel.useMemory, not any(before)))
        df.agg(F.count(F.lit(1)), F.max("offset")).collect()

    Processor(log, OffsetStore(spark, scratch_path(spark, "offsets")), TopicController("pr", "click", max(1, _lag0(log, "click") // SINGLE_DIV)), process, reset="earliest").run(stop_when_idle=True)
    rows = [(b, kept, released, not df.storageLevel.useMemory) for b, df, kept, released in held]
    return spark.createDataFrame(rows, "batch_no bigint, persisted boolean, earlier_released boolean, released boolean")


# --- exact streams and committed sinks ------------------------------------------------


def q_stream_exact_throttle(spark, sf_dir):
    """Structured Streaming over a log table, each batch as large as the topic rule says, to the message."""
    from loglake.streaming.log_source import drain, stream_table
    from loglake.streaming.structured import run_every

    log = fixture_table(spark, sf_dir, "events")
    sink, ckpt = scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    stream = stream_table(spark, fixture_path(spark, sf_dir, "events"), {"click": max(1, _lag0(log, "click") // SINGLE_DIV)}, ckpt)
    drain(run_every(stream, _loop_sink(sink), ckpt, "0 seconds"))
    return _read_sink(spark, sink).select(*RECORD_COLUMNS, "batch_no")


def q_sink_two_phase(spark, sf_dir):
    """The per-partition sink: a batch of which one task fails leaves nothing that counts, the next one all of its rows."""
    from loglake.sources.committed_sink import committed_files, read_committed, write_committed

    tbl, root = fixture_table(spark, sf_dir, "events"), scratch_path(spark, "sink")
    batch = fetch_group(tbl, _positions_zero(tbl, "pg", GROUP_THROTTLES)).data
    t, p, o = POISONED
    poisoned = (F.col("topic") == t) & (F.col("partition") == p) & (F.col("offset") == o)
    try:
        write_committed(batch.withColumn("value", F.when(poisoned, F.raise_error(F.lit("poisoned message"))).otherwise(F.col("value"))), root)
        after = -1
    except Exception as e:  # noqa: BLE001 - the injected failure, or it is raised again
        if "poisoned message" not in str(e):
            raise
        after = committed_files(spark, root).count()
    write_committed(batch, root)
    summary = read_committed(spark, root, LOG).groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("records"), F.min("offset").alias("min_offset"), F.max("offset").alias("max_offset"), F.sum(F.length("value")).cast("bigint").alias("value_bytes")
    )
    return summary.withColumn("files_after_failure", F.lit(after).cast("bigint"))


def q_stream_committed_sink(spark, sf_dir):
    """Exact stream into the committed sink: every message once."""
    from loglake.sources.committed_sink import read_committed, start_committed
    from loglake.streaming.log_source import drain, stream_table

    log = fixture_table(spark, sf_dir, "events")
    root, ckpt = scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    stream = stream_table(spark, fixture_path(spark, sf_dir, "events"), {t: max(1, _lag0(log, t) // SINGLE_DIV) for t in ("click", "view")}, ckpt, rule="group")
    drain(start_committed(stream, root, ckpt))
    return records(read_committed(spark, root, LOG))


def q_stream_lag(spark, sf_dir):
    """Lag of a streaming query that stopped after two batches, from the positions that its progress events left."""
    from loglake.streaming.log_source import drain, stream_table
    from loglake.streaming.progress import flushed, follow_positions
    from loglake.streaming.structured import run_every

    log = fixture_table(spark, sf_dir, "events")
    ckpt, store = scratch_path(spark, "ckpt"), OffsetStore(spark, scratch_path(spark, "offsets"))
    name = f"stream_lag_{ckpt[-12:]}"
    listener = follow_positions(spark, store, {name: "sl"})

    def stop_early(df, batch_id):
        if batch_id == LAG_BATCHES:
            raise RuntimeError("stopped by the query")

    try:
        stream = stream_table(spark, fixture_path(spark, sf_dir, "events"), {"click": max(1, _lag0(log, "click") // SINGLE_DIV)}, ckpt)
        try:
            drain(run_every(stream, stop_early, ckpt, "0 seconds", name=name))
        except Exception as e:  # noqa: BLE001
            if "stopped by the query" not in str(e):
                raise
        flushed(spark)
    finally:
        spark.streams.removeListener(listener)
    water = log.bounds(["click"])
    return acc.lag_partition(acc.resolve_start(water, acc.registrations(spark, [("sl", "click")]), store.read()))


# --- duplicates, summaries, payloads ---------------------------------------------------


def q_dedup_history(spark, sf_dir):
    """Duplicates of a log read in three parts, each against the ids of all before it, none of which is read again."""
    from loglake.operators.history import IdHistory

    log = fixture_log(spark, sf_dir, "dup").withColumn("event_id", event_id_of())
    ends = fixture_table(spark, sf_dir, "dup").bounds().select("topic", "partition", F.col("latest").alias("_end"))
    part = F.when(F.col("offset") < F.expr("_end div 2"), 0).when(F.col("offset") < F.expr("(3 * _end) div 4"), 1).otherwise(2)
    parts = log.join(F.broadcast(ends), ["topic", "partition"]).withColumn("part", part.cast("int")).drop("_end")
    history, out = IdHistory(spark, scratch_path(spark, "history"), space=1 << 20), None
    sink = scratch_path(spark, "sink")
    for i in range(3):
        new = history.new(parts.filter(F.col("part") == i), "event_id")
        new.write.parquet(f"{sink}/batch_id={i}")
        kept = spark.read.parquet(f"{sink}/batch_id={i}")
        history.remember(kept, "event_id", i)
        out = kept if out is None else out.unionByName(kept)
    return out.select("part", "topic", "partition", "offset", "event_id")


def q_dedup_expiry(spark, sf_dir):
    """One message per user, until the user expires: a stream over the log's first half by time, then over the second. Ids
    last a quarter of the log's span after their first message; the watermark stays an eighth of it behind."""
    from loglake.streaming.expiry import dedup_until_expiry
    from loglake.streaming.log_source import stream_table
    from loglake.streaming.structured import batch_sink, run_available_now, stateful_session

    tbl = fixture_table(spark, sf_dir, "events")
    first, last = tbl.chain.ask(lambda s: (min(f.first for fs in s.files.values() for f in fs), max(f.last for fs in s.files.values() for f in fs)))
    span_ms, middle = (last - first) // 1000, F.timestamp_micros(F.lit((first + last) // 2))
    path, sink, ckpt = scratch_path(spark, "log"), scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    own, grown = stateful_session(spark, spark.sparkContext.defaultParallelism), LogTable(spark, path)
    for half in (F.col("timestamp") < middle, F.col("timestamp") >= middle):
        grown.append(tbl.read().filter(half))
        stream = stream_table(own, path, {t: 10**9 for t, _ in tbl.ends()}, ckpt).withColumn("user", utf8("key"))
        kept = dedup_until_expiry(stream, ["user"], span_ms // 4, f"{span_ms // 8} milliseconds")
        run_available_now(kept, batch_sink(sink), ckpt).awaitTermination()  # ends with a batch without rows: timers go off
    return _read_sink(spark, sink).select("topic", "partition", "offset", "user")


def q_running_summary(spark, sf_dir):
    """Running figures over the batches of a loop, merged from stored sketches: exact counts, and whether the estimates of
    distinct users and of quantiles lie within their bounds."""
    from loglake.operators.summaries import store_summary, totals
    from loglake.streaming.processor import Processor, TopicController

    log, root = fixture_table(spark, sf_dir, "events"), scratch_path(spark, "summary")

    def process(df: DataFrame, batch_id: int) -> None:
        v = df.withColumn("user", utf8("key")).withColumn("k", json_value("value", EVENT_VALUE)["props"]["k"])
        for _ in range(2):  # run again, as after a failure: the second attempt replaces the first
            store_summary(v, root, batch_id, ["topic"], "user", "k")

    Processor(log, OffsetStore(spark, scratch_path(spark, "offsets")), TopicController("rs", SUMMARY_TOPIC, max(1, _lag0(log, SUMMARY_TOPIC) // SINGLE_DIV)), process, reset="earliest").run(stop_when_idle=True)
    got = totals(spark, root, ["topic"], QUANTILES)
    whole = log.read().filter(F.col("topic") == SUMMARY_TOPIC).select("topic", utf8("key").alias("user"), json_value("value", EVENT_VALUE)["props"]["k"].alias("k"))
    exact = whole.groupBy("topic").agg(F.countDistinct("user").alias("users"), F.count("k").alias("_n"))
    ranks = [F.col("quantiles")[i] for i in range(len(QUANTILES))]
    place = whole.join(got.select("topic", "quantiles"), "topic").groupBy("topic").agg(
        *[F.avg((F.col("k") < r).cast("double")).alias(f"_lo{i}") for i, r in enumerate(ranks)], *[F.avg((F.col("k") <= r).cast("double")).alias(f"_hi{i}") for i, r in enumerate(ranks)]
    )
    inside = F.lit(True)
    for i, q in enumerate(QUANTILES):
        inside = inside & (F.col(f"_lo{i}") <= q + 0.04) & (F.col(f"_hi{i}") >= q - 0.04)
    near = F.abs(F.col("distinct_ids") - F.col("users")) <= F.greatest(F.lit(2), F.col("users") * 0.06)
    joined = got.join(exact, "topic").join(place, "topic")
    return joined.select("topic", "batches", "n", "total", "most", near.alias("users_near"), inside.alias("quantiles_near"))


def _payloads(spark, sf_dir) -> DataFrame:
    """The events log with every eleventh event's payload cut off."""
    from loglake.functions.variant import decode_variant

    log = fixture_log(spark, sf_dir, "events").withColumn("event_id", event_id_of())
    cut = F.col("event_id") % TRUNCATED_EVERY == 0
    return decode_variant(log.withColumn("value", F.when(cut, F.substring("value", 1, 12)).otherwise(F.col("value"))).drop("event_id"))


def q_decode_variant(spark, sf_dir):
    """Payloads decoded without a schema."""
    from loglake.functions.variant import readable, shaped

    out = shaped(readable(_payloads(spark, sf_dir)), {"event_id": ("$.event_id", "bigint"), "k": ("$.props.k", "bigint"), "absent": ("$.props.none", "string")})
    return out.select("topic", "partition", "offset", "event_id", "k", "absent")


def q_dead_letter(spark, sf_dir):
    """The payloads that could not be read, with their place."""
    from loglake.functions.variant import dead_letter

    return dead_letter(_payloads(spark, sf_dir)).select("topic", "partition", "offset", utf8("value").alias("value"), "reason")


def q_payload_schema(spark, sf_dir):
    """The schema that the payloads of each topic turn out to have."""
    from loglake.functions.variant import discovered

    return discovered(_payloads(spark, sf_dir), ["topic"])


def q_filtered_time_range(spark, sf_dir):
    """A processor started at a time: the filtered messages from the middle of the log's time span on."""
    tbl = fixture_table(spark, sf_dir, "events")
    start = {(r["topic"], r["partition"]): r["offset"] for r in q_offsets_at_time(spark, sf_dir).collect()}
    picked = range_scan(tbl, [(t, p, start[(t, p)], z) for (t, p), (_, z) in tbl.ends().items() if t == "purchase"])
    return _filtered(spark, sf_dir).join(picked.select("partition", "offset"), ["partition", "offset"], "left_semi").select("partition", "offset", "event_id", "k")


QUERIES = {
    "range_scan_many": q_range_scan_many,
    "offsets_at_time": q_offsets_at_time,
    "start_at_time": q_filtered_time_range,
    "publish_concurrent": q_publish_concurrent,
    "retention": q_retention,
    "fenced_commit": q_fenced_commit,
    "refuse_unstable": q_refuse_unstable,
    "persist_released": q_persist_released,
    "stream_exact_throttle": q_stream_exact_throttle,
    "sink_two_phase": q_sink_two_phase,
    "stream_committed_sink": q_stream_committed_sink,
    "stream_lag": q_stream_lag,
    "dedup_history": q_dedup_history,
    "dedup_expiry": q_dedup_expiry,
    "running_summary": q_running_summary,
    "decode_variant": q_decode_variant,
    "dead_letter": q_dead_letter,
    "payload_schema": q_payload_schema,
}
