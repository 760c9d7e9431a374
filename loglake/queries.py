"""The registered query catalog: one function ``(spark, sf_dir) -> DataFrame``
per operator of the inventory, each reading the given tables (through the
fixture logs Spark derives from them). Output columns are strings and
integers only, named exactly as in the oracle SQL (``loglake.oracle``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglake.functions.decode import EVENT_VALUE, decode_records, json_value, utf8
from loglake.functions.ids import message_id
from loglake.operators import accounting as acc
from loglake.operators.dedup import dedup_batch
from loglake.operators.fetch import fetch_each, fetch_group, fetch_partition, fetch_topic
from loglake.operators.scan import range_scan
from loglake.plans.drain import drain_group, drain_topic
from loglake.plans.throttle import plan_group, plan_partition, plan_proportional, plan_topic
from loglake.session import scratch_path
from loglake.sources.fixtures import event_id_of, fixture_log, fixture_table, offsets_g0, offsets_g1, offsets_history
from loglake.sources.log import LogTable, write_log
from loglake.sources.offsets import OffsetStore

RANGE_TOPIC = "click"
RANGES = {0: (0, 30), 1: (10, 25), 3: (5, 5)}
PLAN_PARTITION_CAP = 30
TOPIC_MAX_QUEUE = 200
TOPIC_TAIL = 45
TAIL_TOPICS = ("click", "view")
GROUP_THROTTLES = {"click": 100, "view": 40, "error": 2}
FETCH_PARTITION = ("click", 2)
FILTER_TOPIC = "purchase"
FILTER_MIN_K = 50
REPUBLISH_TARGET = "click"
SKEW_MAX_QUEUE = 1000
COMMIT_MAX_QUEUE = 200
UNION_GROUPS = {"ua": 100, "ub": 300}
SEEK_TOPIC = "click"

RECORD_COLUMNS = ["topic", "partition", "offset", "key", "value"]


def records(df: DataFrame) -> DataFrame:
    return decode_records(df).select(*RECORD_COLUMNS)


def _water(src: LogTable | DataFrame) -> DataFrame:
    """Bounds: from the records of a log table, else a min/max aggregate."""
    return src.bounds() if isinstance(src, LogTable) else acc.watermarks(src)


def _spark(src: LogTable | DataFrame) -> SparkSession:
    return src.spark if isinstance(src, LogTable) else src.sparkSession


def _positions_zero(src: LogTable | DataFrame, group: str, throttles: dict[str, int] | int) -> DataFrame:
    water = _water(src)
    if isinstance(throttles, dict):
        regs = acc.registrations(_spark(src), [(group, t, q) for t, q in throttles.items()])
    else:
        regs = acc.register_topics(water, group, throttles)
    return acc.positions_at(water, regs, F.lit(0))


def _positions_tail(src: LogTable | DataFrame, group: str) -> DataFrame:
    """plan_topic / fetch_topic positions: latest - 45 for click and view, 0 else."""
    water = _water(src)
    regs = acc.register_topics(water, group, TOPIC_MAX_QUEUE)
    pos = F.when(F.col("topic").isin(*TAIL_TOPICS), F.greatest(F.lit(0), F.col("latest") - TOPIC_TAIL)).otherwise(0)
    return acc.positions_at(water, regs, pos)


def _retained_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    water = _water(fixture_table(spark, sf_dir, "retained"))
    offsets = offsets_g0(water).unionByName(offsets_g1(water)).unionByName(offsets_history(water))
    regs = acc.register_topics(water, "g0").unionByName(acc.register_topics(water, "g1")).unionByName(
        acc.register_topics(water, "gh")
    )
    return acc.resolve_start(water, regs, offsets)


# --- 1. minimum slice + scans and decode --------------------------------------


def q_fetch_topic(spark, sf_dir):
    tbl = fixture_table(spark, sf_dir, "events")
    log = tbl.read()
    return records(fetch_topic(log, _positions_tail(tbl, "ft")).data)


def q_range_scan(spark, sf_dir):
    tbl = fixture_table(spark, sf_dir, "events")
    log = tbl.read()
    return records(range_scan(log, RANGES, topic=RANGE_TOPIC))


def q_range_scan_gaps(spark, sf_dir):
    log = fixture_log(spark, sf_dir, "gaps")
    return records(range_scan(log, RANGES, topic=RANGE_TOPIC))


def q_decode_string(spark, sf_dir):
    return records(fixture_log(spark, sf_dir, "events"))


def q_decode_json(spark, sf_dir):
    tbl = fixture_table(spark, sf_dir, "events")
    log = tbl.read()
    v = json_value("value", EVENT_VALUE)
    return log.select(
        "topic",
        "partition",
        "offset",
        utf8("key").cast("bigint").alias("user_id"),
        v["event_id"].alias("event_id"),
        v["props"]["k"].alias("k"),
    )


def q_message_id(spark, sf_dir):
    tbl = fixture_table(spark, sf_dir, "events")
    log = tbl.read()
    return log.select("topic", "partition", "offset", message_id().alias("message_id"))


def q_topic_partitions(spark, sf_dir):
    water = fixture_table(spark, sf_dir, "events").bounds().unionByName(fixture_table(spark, sf_dir, "orders").bounds())
    return acc.topic_partitions(water)


# --- 3. accounting -----------------------------------------------------------


def q_watermarks(spark, sf_dir):
    """Bounds from the table's records, no scan of messages."""
    return fixture_table(spark, sf_dir, "retained").bounds().unionByName(
        fixture_table(spark, sf_dir, "orders").bounds()
    )


def q_committed_offsets(spark, sf_dir):
    water = _water(fixture_table(spark, sf_dir, "retained"))
    offsets = offsets_g0(water).unionByName(offsets_g1(water)).unionByName(offsets_history(water))
    return acc.committed_offsets(offsets)


def q_resolve_start(spark, sf_dir):
    return _retained_positions(spark, sf_dir).select(
        "group_id", "topic", "partition", "earliest", "latest", "position", "status"
    )


def q_lag_partition(spark, sf_dir):
    return acc.lag_partition(_retained_positions(spark, sf_dir))


def q_lag_topic(spark, sf_dir):
    return acc.lag_topic(_retained_positions(spark, sf_dir))


def q_lag_total(spark, sf_dir):
    return acc.lag_total(_retained_positions(spark, sf_dir))


# --- 4. planning ---------------------------------------------------------------


def q_plan_partition(spark, sf_dir):
    tbl = fixture_table(spark, sf_dir, "events")
    return plan_partition(_positions_zero(tbl, "pp", PLAN_PARTITION_CAP))


def q_plan_topic(spark, sf_dir):
    tbl = fixture_table(spark, sf_dir, "events")
    return plan_topic(_positions_tail(tbl, "ft"))


def q_plan_group(spark, sf_dir):
    tbl = fixture_table(spark, sf_dir, "events")
    return plan_group(_positions_zero(tbl, "pg", GROUP_THROTTLES))


def q_drain_topic(spark, sf_dir):
    tbl = fixture_table(spark, sf_dir, "events")
    log = tbl.read()
    d = drain_topic(log, _positions_zero(tbl, "dt", TOPIC_MAX_QUEUE))
    return d.select("topic", "partition", "offset", "batch_no")


def q_drain_group(spark, sf_dir):
    tbl = fixture_table(spark, sf_dir, "events")
    log = tbl.read()
    d = drain_group(log, _positions_zero(tbl, "dg", GROUP_THROTTLES))
    return d.select("topic", "partition", "offset", "batch_no")


def q_plan_skew(spark, sf_dir):
    """The two multi-partition rules side by side on a skewed topic."""
    tbl = fixture_table(spark, sf_dir, "skew")
    pos = _positions_zero(tbl, "sk", SKEW_MAX_QUEUE)
    by_topic = plan_topic(pos).select("topic", "partition", "start_offset", F.col("stop_offset").alias("stop_topic"))
    by_group = plan_group(pos).select("topic", "partition", F.col("stop_offset").alias("stop_group"))
    return by_topic.join(by_group, ["topic", "partition"])


def q_drain_skew(spark, sf_dir):
    """Rounds needed per partition of the skewed topic under both rules."""
    tbl = fixture_table(spark, sf_dir, "skew")
    log = tbl.read()
    pos = _positions_zero(tbl, "sk", SKEW_MAX_QUEUE)
    both = drain_topic(log, pos).withColumn("rule", F.lit("topic")).unionByName(
        drain_group(log, pos).withColumn("rule", F.lit("group"))
    )
    return both.groupBy("rule", "partition").agg(
        F.count(F.lit(1)).alias("records"), F.max("batch_no").alias("last_batch")
    )


# --- 5. fetch, commit ----------------------------------------------------------


def q_fetch_partition(spark, sf_dir):
    tbl = fixture_table(spark, sf_dir, "events")
    log = tbl.read()
    t, p = FETCH_PARTITION
    return records(fetch_partition(log, _positions_zero(tbl, "fp", PLAN_PARTITION_CAP), t, p).data)


def q_fetch_group(spark, sf_dir):
    tbl = fixture_table(spark, sf_dir, "events")
    log = tbl.read()
    return records(fetch_group(log, _positions_zero(tbl, "pg", GROUP_THROTTLES)).data)


def q_fetch_each(spark, sf_dir):
    tbl = fixture_table(spark, sf_dir, "events")
    log = tbl.read()
    parts = fetch_each(log, _positions_zero(tbl, "pg", GROUP_THROTTLES))
    out = None
    for name, f in parts.items():
        df = records(f.data).withColumn("dataset", F.lit(name))
        out = df if out is None else out.unionByName(df)
    return out


def q_commit_offsets(spark, sf_dir):
    """g1 on the retained log: registration commits moved positions (E1),
    then one topic-rule batch per topic is committed (E3-E5)."""
    tbl = fixture_table(spark, sf_dir, "retained")
    water = _water(tbl)
    store = OffsetStore(spark, scratch_path(spark, "offsets"))
    store.seed(offsets_g1(water))
    regs = acc.register_topics(water, "g1", COMMIT_MAX_QUEUE)
    store.commit_resolved(acc.resolve_start(water, regs, store.read()))
    plan = plan_topic(acc.resolve_start(water, regs, store.read()))
    store.commit(plan)
    hist = store.read()
    return acc.committed_offsets(hist).join(
        hist.groupBy("group_id", "topic", "partition").agg(F.count(F.lit(1)).alias("commits")),
        ["group_id", "topic", "partition"],
    ).select("group_id", "topic", "partition", "committed", "commits")


def q_seek_offsets(spark, sf_dir):
    tbl = fixture_table(spark, sf_dir, "retained")
    water = _water(tbl)
    store = OffsetStore(spark, scratch_path(spark, "offsets"))
    store.seed(offsets_g1(water))
    target = water.filter(F.col("topic") == SEEK_TOPIC).select(
        "topic", "partition", F.expr("(earliest + latest) div 2").alias("committed")
    )
    store.seek("g1", target)
    regs = acc.register_topics(water, "g1")
    return acc.resolve_start(water, regs, store.read()).select(
        "group_id", "topic", "partition", "position", "status"
    )


# --- 6. patterns -----------------------------------------------------------------


def q_dedup_batch(spark, sf_dir):
    log = fixture_log(spark, sf_dir, "dup").withColumn("event_id", event_id_of())
    return dedup_batch(log, "event_id").select("topic", "partition", "offset", "event_id")


def q_repartition_batch(spark, sf_dir):
    tbl = fixture_table(spark, sf_dir, "events")
    log = tbl.read()
    batch = fetch_topic(log, _positions_tail(tbl, "ft")).data
    from loglake.operators.sink import rebalance

    return records(rebalance(batch, "key"))


def q_aggregate_batch(spark, sf_dir):
    """Gated batches of the loop, each aggregated by key in the batch function."""
    from loglake.operators.sink import write_batch
    from loglake.streaming.processor import Processor, TopicController, lag_at_least

    log = fixture_table(spark, sf_dir, "events")
    lag0, sink = _lag0(log, "click"), scratch_path(spark, "sink")

    def by_key(df: DataFrame, batch_id: int) -> None:
        counts = df.groupBy("topic", utf8("key").alias("key")).agg(F.count(F.lit(1)).alias("n"), F.max("offset").alias("max_offset"))
        write_batch(counts.withColumn("batch_no", F.lit(batch_id).cast("bigint")), sink, batch_id)

    Processor(
        log, OffsetStore(spark, scratch_path(spark, "offsets")), TopicController("gd", "click", max(1, lag0 // GATE_DIV)), by_key,
        gate=lag_at_least(lag0 // GATE_THRESHOLD_DIV), wal_root=scratch_path(spark, "wal"), reset="earliest",
    ).run(stop_when_idle=True)
    return _read_sink(spark, sink).select("topic", "batch_no", "key", "n", "max_offset")


def _filtered(spark, sf_dir) -> DataFrame:
    tbl = fixture_table(spark, sf_dir, "events")
    log = tbl.read()
    batch = fetch_topic(log, _positions_zero(tbl, "fl", 5000), topic=FILTER_TOPIC).data
    v = json_value("value", EVENT_VALUE)
    return batch.withColumn("k", v["props"]["k"]).withColumn("event_id", v["event_id"]).filter(
        F.col("k") >= FILTER_MIN_K
    )


def q_filter_processor(spark, sf_dir):
    return _filtered(spark, sf_dir).select("partition", "offset", "event_id", "k")


def q_republish(spark, sf_dir):
    """The filtered messages published to the end of another topic's log, and read back from there."""
    path = scratch_path(spark, "target")
    write_log(fixture_log(spark, sf_dir, "events").filter(F.col("topic") == REPUBLISH_TARGET), path)
    target = LogTable(spark, path)
    ends = [(r["topic"], r["partition"], r["latest"]) for r in target.bounds().collect()]
    picked = _filtered(spark, sf_dir).select(
        F.lit(REPUBLISH_TARGET).alias("topic"), "partition", "timestamp", "key", "value", "offset"
    )
    target.publish(picked, ["offset"])
    now = {(r["topic"], r["partition"]): r["latest"] for r in target.bounds().collect()}
    return records(range_scan(target, [(t, p, old, now[(t, p)]) for t, p, old in ends]))


def q_foreach_partition_sink(spark, sf_dir):
    """Each Spark partition of a fetched batch handed to user code: what that code saw of each topic partition."""
    from loglake.operators.sink import Tally, for_each_partition

    tbl = fixture_table(spark, sf_dir, "events")
    batch = fetch_group(tbl, _positions_zero(tbl, "pg", GROUP_THROTTLES)).data
    seen = spark.sparkContext.accumulator({}, Tally())

    def sink(rows):
        own: dict[tuple, tuple[int, int]] = {}
        for r in rows:
            n, total = own.get((r["topic"], r["partition"]), (0, 0))
            own[(r["topic"], r["partition"])] = (n + 1, total + r["offset"])
        seen.add(own)

    for_each_partition(batch, sink)
    rows = [(t, p, n, total) for (t, p), (n, total) in sorted(seen.value.items())]
    return spark.createDataFrame(rows, "topic string, partition int, records bigint, offset_sum bigint")


def q_fetch_two_groups_union(spark, sf_dir):
    """Two groups on one topic in one set: a message in both plans comes twice."""
    tbl = fixture_table(spark, sf_dir, "events")
    water = _water(tbl)
    regs = acc.registrations(spark, [(g, "click", q) for g, q in UNION_GROUPS.items()])
    return records(fetch_group(tbl, acc.positions_at(water, regs, F.lit(0))).data)


def q_default_throttle(spark, sf_dir):
    """Topics registered without a limit take 5000."""
    water = _water(fixture_table(spark, sf_dir, "events"))
    regs = acc.registrations(spark, [("dd", t) for t in TAIL_TOPICS])
    return plan_topic(acc.positions_at(water, regs, F.lit(0)))


def q_duplicate_registration(spark, sf_dir):
    """Registering a topic twice for one group is refused, for two groups it is not."""
    rows = []
    for r in _water(fixture_table(spark, sf_dir, "events")).select("topic").distinct().collect():
        for second in ("g", "h"):
            try:
                acc.registrations(spark, [("g", r["topic"]), (second, r["topic"])])
                rows.append((r["topic"], second, False))
            except ValueError:
                rows.append((r["topic"], second, True))
    return spark.createDataFrame(rows, "topic string, second_group string, refused boolean")


def q_decode_custom(spark, sf_dir):
    """Decoders given by the user as Column functions."""
    log = fixture_log(spark, sf_dir, "events")
    decoded = decode_records(log, key=lambda c: F.concat(F.lit("user-"), utf8(c)), value=lambda c: F.md5(c))
    return decoded.select(*RECORD_COLUMNS)


def q_dedup_batch_null_ids(spark, sf_dir):
    """Messages without an id (here every fifth event's) equal no other."""
    log = fixture_log(spark, sf_dir, "dup").withColumn("event_id", event_id_of())
    log = log.withColumn("event_id", F.when(F.col("event_id") % 5 != 0, F.col("event_id")))
    return dedup_batch(log, "event_id").select("topic", "partition", "offset", "event_id")


def q_sink_partitions(spark, sf_dir):
    from loglake.operators.sink import partition_summary, write_partitioned

    tbl = fixture_table(spark, sf_dir, "events")
    log = tbl.read()
    batch = fetch_group(log, _positions_zero(tbl, "pg", GROUP_THROTTLES)).data
    path = scratch_path(spark, "sink")
    write_partitioned(batch, path)
    return partition_summary(spark, path)


def q_plan_proportional(spark, sf_dir):
    """Spark's maxOffsetsPerTrigger-style split (by lag) next to the uniform rule."""
    tbl = fixture_table(spark, sf_dir, "events")
    return plan_proportional(_positions_tail(tbl, "ft"))


def q_project_key_value(spark, sf_dir):
    """The reference's record shape: (key, value) only, provenance dropped."""
    return decode_records(fixture_log(spark, sf_dir, "events"), provenance=False)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "fetch_topic": q_fetch_topic,
    "range_scan": q_range_scan,
    "range_scan_gaps": q_range_scan_gaps,
    "decode_string": q_decode_string,
    "decode_json": q_decode_json,
    "message_id": q_message_id,
    "topic_partitions": q_topic_partitions,
    "watermarks": q_watermarks,
    "committed_offsets": q_committed_offsets,
    "resolve_start": q_resolve_start,
    "lag_partition": q_lag_partition,
    "lag_topic": q_lag_topic,
    "lag_total": q_lag_total,
    "plan_partition": q_plan_partition,
    "plan_topic": q_plan_topic,
    "plan_group": q_plan_group,
    "drain_topic": q_drain_topic,
    "drain_group": q_drain_group,
    "plan_skew": q_plan_skew,
    "drain_skew": q_drain_skew,
    "fetch_partition": q_fetch_partition,
    "fetch_group": q_fetch_group,
    "fetch_each": q_fetch_each,
    "commit_offsets": q_commit_offsets,
    "seek_offsets": q_seek_offsets,
    "dedup_batch": q_dedup_batch,
    "repartition_batch": q_repartition_batch,
    "aggregate_batch": q_aggregate_batch,
    "filter_processor": q_filter_processor,
    "republish": q_republish,
    "foreach_partition_sink": q_foreach_partition_sink,
    "fetch_two_groups_union": q_fetch_two_groups_union,
    "default_throttle": q_default_throttle,
    "duplicate_registration": q_duplicate_registration,
    "decode_custom": q_decode_custom,
    "dedup_batch_null_ids": q_dedup_batch_null_ids,
    "sink_partitions": q_sink_partitions,
    "plan_proportional": q_plan_proportional,
    "project_key_value": q_project_key_value,
}


# --- 7. loops and streams ------------------------------------------------------------
# Planned loops read the Parquet fixture log; throttles are fractions of the
# starting lag so the number of rounds stays small at every scale.

SINGLE_DIV = 4
MULTI_DIV = 4
PROC_DIVS = {"click": 3, "view": 5}
GATE_DIV = 5
GATE_THRESHOLD_DIV = 2
REPLAY_DIV = 4
REPLAY_FAIL_BATCH = 1
TWO_GROUPS = {"ga": 40, "gb": 120}
TWO_GROUPS_BATCHES = 2
STREAM_FILES = 16
STREAM_MAX_FILES = 4
MULTI_QUERY_FILES = {"click": 3, "view": 5}
DEDUP_DELAY = "60 days"
NEW_PARTITION = 3


def _lag0(log: LogTable | DataFrame, topic: str) -> int:
    w = log.bounds([topic]) if isinstance(log, LogTable) else acc.watermarks(log.filter(F.col("topic") == topic))
    return int(w.agg(F.sum(F.col("latest") - F.col("earliest"))).collect()[0][0] or 0)


def _loop_sink(root: str):
    from loglake.operators.sink import write_batch

    def process(df: DataFrame, batch_id: int) -> None:
        write_batch(records(df).withColumn("batch_no", F.lit(batch_id).cast("bigint")), root, batch_id)

    return process


def _read_sink(spark: SparkSession, root: str) -> DataFrame:
    from loglake.operators.sink import read_batches

    return read_batches(spark, root).drop("batch_id")


def _processor(spark, log, controller, sink, **kw):
    from loglake.streaming.processor import Processor

    store = kw.pop("store", None) or OffsetStore(spark, scratch_path(spark, "offsets"))
    return Processor(log, store, controller, _loop_sink(sink), wal_root=kw.pop("wal_root", None)
                     or scratch_path(spark, "wal"), reset="earliest", **kw)


def q_stream_single(spark, sf_dir):
    from loglake.streaming.processor import TopicController

    log = fixture_table(spark, sf_dir, "events")
    mq = max(1, _lag0(log, "click") // SINGLE_DIV)
    sink = scratch_path(spark, "sink")
    _processor(spark, log, TopicController("ss", "click", mq), sink).run(stop_when_idle=True)
    return _read_sink(spark, sink).select(*RECORD_COLUMNS, "batch_no")


def q_stream_multi(spark, sf_dir):
    from loglake.streaming.processor import TopicSetController

    log = fixture_table(spark, sf_dir, "events")
    entries = [("sm", t, max(1, _lag0(log, t) // MULTI_DIV)) for t in ("click", "view")]
    sink = scratch_path(spark, "sink")
    _processor(spark, log, TopicSetController(entries), sink).run(stop_when_idle=True)
    return _read_sink(spark, sink).select(*RECORD_COLUMNS, "batch_no")


def q_stream_multi_proc(spark, sf_dir):
    from loglake.streaming.processor import Runner, TopicController

    log = fixture_table(spark, sf_dir, "events")
    runner, sinks = Runner(), {}
    for i, (topic, div) in enumerate(PROC_DIVS.items(), start=1):
        name = f"proc{i}"
        sinks[name] = scratch_path(spark, "sink")
        ctl = TopicController(name, topic, max(1, _lag0(log, topic) // div))
        runner.add(_processor(spark, log, ctl, sinks[name], name=name))
    runner.start(stop_when_idle=True)
    out = None
    for name, root in sinks.items():
        df = _read_sink(spark, root).select(F.lit(name).alias("processor"), "topic", "partition", "offset", "batch_no")
        out = df if out is None else out.unionByName(df)
    return out


def q_gated_drain(spark, sf_dir):
    from loglake.streaming.processor import TopicController, lag_at_least

    log = fixture_table(spark, sf_dir, "events")
    lag0 = _lag0(log, "click")
    sink = scratch_path(spark, "sink")
    ctl = TopicController("gd", "click", max(1, lag0 // GATE_DIV))
    _processor(spark, log, ctl, sink, gate=lag_at_least(lag0 // GATE_THRESHOLD_DIV)).run(stop_when_idle=True)
    return _read_sink(spark, sink).select("topic", "partition", "offset", "batch_no")


def q_replay_uncommitted(spark, sf_dir):
    """The batch function fails once after writing batch 1; the loop is
    started again on the same store and write-ahead plans and replays batch 1
    with the same ranges. Each record ends up once, with its batch."""
    from loglake.streaming.processor import TopicController

    log = fixture_table(spark, sf_dir, "events")
    mq = max(1, _lag0(log, "click") // REPLAY_DIV)
    store = OffsetStore(spark, scratch_path(spark, "offsets"))
    wal, sink = scratch_path(spark, "wal"), scratch_path(spark, "sink")
    write = _loop_sink(sink)
    failed = {}

    def flaky(df, batch_id):
        write(df, batch_id)
        if batch_id == REPLAY_FAIL_BATCH and not failed:
            failed["at"] = batch_id
            raise RuntimeError("injected failure before commit")

    from loglake.streaming.processor import Processor

    first = Processor(log, store, TopicController("ru", "click", mq), flaky, wal_root=wal, reset="earliest")
    try:
        first.run(stop_when_idle=True)
    except RuntimeError:
        pass
    Processor(log, store, TopicController("ru", "click", mq), flaky, wal_root=wal, reset="earliest").run(
        stop_when_idle=True
    )
    return _read_sink(spark, sink).select("topic", "partition", "offset", "batch_no")


def q_two_groups(spark, sf_dir):
    from loglake.streaming.processor import Runner, TopicController

    log = fixture_table(spark, sf_dir, "events")
    store = OffsetStore(spark, scratch_path(spark, "offsets"))
    runner = Runner()
    for g, mq in TWO_GROUPS.items():
        runner.add(_processor(spark, log, TopicController(g, "click", mq), scratch_path(spark, "sink"), store=store,
                              name=g))
    runner.start(stop_when_idle=True, max_batches=TWO_GROUPS_BATCHES)
    water = log.bounds(["click"])
    regs = acc.registrations(spark, [(g, "click", q) for g, q in TWO_GROUPS.items()])
    return acc.resolve_start(water, regs, store.read()).select("group_id", "topic", "partition", "position")


def q_stream_shared_group(spark, sf_dir):
    """One group, one store, two topics, a processor for each: the positions stored after both have drained."""
    from loglake.streaming.processor import Runner, TopicController

    log, store = fixture_table(spark, sf_dir, "events"), OffsetStore(spark, scratch_path(spark, "offsets"))
    runner = Runner()
    for topic, div in PROC_DIVS.items():
        ctl = TopicController("sg", topic, max(1, _lag0(log, topic) // div))
        runner.add(_processor(spark, log, ctl, scratch_path(spark, "sink"), store=store, name=topic))
    runner.start(stop_when_idle=True)
    return store.committed().select("group_id", "topic", "partition", "committed")


def q_loop_new_partition(spark, sf_dir):
    """A partition that appears after registration is read from its start, also where others start at their end."""
    from loglake.streaming.processor import Processor, TopicController

    whole = fixture_log(spark, sf_dir, "events")
    shown = {"log": whole.filter(F.col("partition") != NEW_PARTITION)}
    sink = scratch_path(spark, "sink")
    p = Processor(
        lambda: shown["log"], OffsetStore(spark, scratch_path(spark, "offsets")), TopicController("np", "click", 10**9),
        _loop_sink(sink), wal_root=scratch_path(spark, "wal"), reset="latest",
    )
    p.run(stop_when_idle=True)
    shown["log"] = whole
    p.run(stop_when_idle=True)
    return _read_sink(spark, sink).select("topic", "partition", "offset")


def q_stop_after_batch(spark, sf_dir):
    """A stop asked for during a batch ends the loop after its commit: the positions then stored."""
    from loglake.streaming.processor import Processor, TopicController

    log, store = fixture_table(spark, sf_dir, "events"), OffsetStore(spark, scratch_path(spark, "offsets"))
    p = Processor(
        log, store, TopicController("sb", "click", max(1, _lag0(log, "click") // SINGLE_DIV)),
        lambda df, batch_id: p.stop(), wal_root=scratch_path(spark, "wal"), reset="earliest",
    )
    p.run()
    return store.committed().select("group_id", "topic", "partition", "committed")


def _file_log(spark, sf_dir, name: str) -> str:
    """The fixture log in many files (a file stream throttles by files),
    written once per application: streams only read it."""
    from loglake.sources.fixtures import _LOCK, fixture_path

    path = fixture_path(spark, sf_dir, f"{name}-files{STREAM_FILES}")
    with _LOCK:
        if not LogTable(spark, path).exists():
            write_log(fixture_log(spark, sf_dir, name), path, files_per_partition=STREAM_FILES)
    return path


def q_stream_throttled(spark, sf_dir):
    from loglake.streaming.structured import batch_sink, run_available_now, stream_log

    src, sink = _file_log(spark, sf_dir, "events"), scratch_path(spark, "sink")
    q = run_available_now(stream_log(spark, src, STREAM_MAX_FILES), batch_sink(sink, records),
                          scratch_path(spark, "ckpt"))
    q.awaitTermination()
    return _read_sink(spark, sink).select(*RECORD_COLUMNS)


def q_idempotent_sink(spark, sf_dir):
    from loglake.streaming.structured import batch_sink, run_available_now, stream_log

    src, sink, ckpt = _file_log(spark, sf_dir, "events"), scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    write, failed = batch_sink(sink, records), []

    def flaky(df, batch_id):
        write(df, batch_id)
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("injected failure after the write")

    for _ in range(2):  # first run fails after writing batch 1; the restart replays it
        q = run_available_now(stream_log(spark, src, STREAM_MAX_FILES), flaky, ckpt)
        try:
            q.awaitTermination()
            break
        except Exception:  # StreamingQueryException from the injected failure
            continue
    return _read_sink(spark, sink).select(*RECORD_COLUMNS)


def q_dedup_stream(spark, sf_dir):
    from loglake.streaming.structured import (
        batch_sink,
        dedup_within,
        run_available_now,
        stateful_session,
        stream_log,
    )

    src, sink = _file_log(spark, sf_dir, "dup"), scratch_path(spark, "sink")
    # one state partition per core of the cluster: state grows with distinct ids, not with batches
    own = stateful_session(spark, spark.sparkContext.defaultParallelism)
    stream = dedup_within(stream_log(own, src, STREAM_MAX_FILES).withColumn("event_id", event_id_of()),
                          ["event_id"], "timestamp", DEDUP_DELAY)

    def shape(df):
        return records(df).drop("offset").withColumn("event_id", event_id_of())

    q = run_available_now(stream, batch_sink(sink, shape), scratch_path(spark, "ckpt"))
    q.awaitTermination()
    return _read_sink(spark, sink).select("topic", "partition", "key", "value", "event_id")


def q_stream_multi_query(spark, sf_dir):
    from loglake.streaming.structured import await_all, batch_sink, run_available_now, stream_log

    src = _file_log(spark, sf_dir, "events")
    started, sinks = [], {}
    for topic, files in MULTI_QUERY_FILES.items():
        sinks[topic] = scratch_path(spark, "sink")
        stream = stream_log(spark, src, files).filter(F.col("topic") == topic)
        started.append(run_available_now(stream, batch_sink(sinks[topic], records), scratch_path(spark, "ckpt")))
    await_all(spark, started)
    out = None
    for topic, root in sinks.items():
        df = _read_sink(spark, root).select(F.lit(f"q_{topic}").alias("processor"), *RECORD_COLUMNS)
        out = df if out is None else out.unionByName(df)
    return out


QUERIES.update(
    {
        "stream_single": q_stream_single,
        "stream_multi": q_stream_multi,
        "stream_multi_proc": q_stream_multi_proc,
        "gated_drain": q_gated_drain,
        "replay_uncommitted": q_replay_uncommitted,
        "two_groups": q_two_groups,
        "stream_throttled": q_stream_throttled,
        "idempotent_sink": q_idempotent_sink,
        "dedup_stream": q_dedup_stream,
        "stream_multi_query": q_stream_multi_query,
        "stream_shared_group": q_stream_shared_group,
        "loop_new_partition": q_loop_new_partition,
        "stop_after_batch": q_stop_after_batch,
    }
)
