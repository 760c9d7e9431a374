"""The exact stream of a log table: the batches of the planned loop, restarts, new partitions, data loss."""

import random

import pytest
from pyspark.sql import functions as F

from loglake.operators import accounting as acc
from loglake.operators.sink import read_batches
from loglake.plans.throttle import RULES, stops
from loglake.schema import LOG
from loglake.session import scratch_path
from loglake.sources.fixtures import fixture_path, fixture_table
from loglake.sources.log import LogTable, write_log
from loglake.sources.offsets import OffsetStore
from loglake.streaming.log_source import drain, stream_table
from loglake.streaming.processor import Processor, TopicController, TopicSetController
from loglake.streaming.structured import batch_sink, run_every


def test_rule_on_values_equals_the_dataframe_rules(spark):
    rng = random.Random(4)
    names = "group_id string, topic string, partition int, max_queue int, earliest long, latest long, stored long, position long, status string"
    for _ in range(4):
        rows, queues = [], {t: rng.choice([1, 7, 40]) for t in "abc"}
        for t in "abc":
            for p in range(rng.randint(1, 5)):
                earliest = rng.randint(0, 20)
                latest = earliest + rng.choice([0, 3, 60])
                rows.append(("g", t, p, queues[t], earliest, latest, None, rng.randint(earliest, latest), "set"))
        df = spark.createDataFrame(rows, names)
        positions, bounds = {(r[1], r[2]): r[7] for r in rows}, {(r[1], r[2]): (r[4], r[5]) for r in rows}
        for rule in ("partition", "topic", "group"):
            want = positions | {(r["topic"], r["partition"]): r["stop_offset"] for r in RULES[rule](df).collect()}
            assert stops(positions, bounds, queues, rule) == want, rule


def run(spark, path, queues, rule, sink, ckpt, fn=None):
    drain(run_every(stream_table(spark, path, queues, ckpt, rule), fn or batch_sink(sink), ckpt, "0 seconds"))


def batches(spark, sink):
    return {(r["topic"], r["partition"], r["offset"]): r["batch_id"] for r in read_batches(spark, sink).collect()}


@pytest.mark.parametrize("rule", ["topic", "group"])
def test_batches_equal_those_of_the_loop(spark, small, rule):
    log, path = fixture_table(spark, small, "events"), fixture_path(spark, small, "events")
    queues = {"click": 30} if rule == "topic" else {"click": 30, "view": 9}
    sink = scratch_path(spark, "sink")
    run(spark, path, queues, rule, sink, scratch_path(spark, "ckpt"))
    seen = {}
    ctl = TopicController("g", "click", 30) if rule == "topic" else TopicSetController([("g", t, q) for t, q in queues.items()])
    Processor(log, OffsetStore(spark, scratch_path(spark, "offsets")), ctl, lambda df, b: seen.update({(r["topic"], r["partition"], r["offset"]): b for r in df.collect()}), reset="earliest").run(stop_when_idle=True)
    assert batches(spark, sink) == seen and max(seen.values()) > 2
    got = read_batches(spark, sink).drop("batch_id")
    want = log.read().filter(F.col("topic").isin(*queues))
    assert got.select(*LOG.names).exceptAll(want).count() == 0 == want.exceptAll(got.select(*LOG.names)).count()


def test_restart_runs_the_failed_batch_again_and_goes_on(spark, small):
    path, sink, ckpt = fixture_path(spark, small, "events"), scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    fixture_table(spark, small, "events")
    write, failed = batch_sink(sink), []

    def flaky(df, batch_id):
        write(df, batch_id)
        if batch_id == 1 and not failed:
            failed.append(1)
            raise RuntimeError("boom")

    with pytest.raises(Exception, match="boom"):
        run(spark, path, {"click": 40}, "topic", sink, ckpt, flaky)
    run(spark, path, {"click": 40}, "topic", sink, ckpt, flaky)
    whole = scratch_path(spark, "sink")
    run(spark, path, {"click": 40}, "topic", whole, scratch_path(spark, "ckpt"))
    assert batches(spark, sink) == batches(spark, whole)


def test_new_messages_partitions_and_lost_ones(spark):
    path, sink, ckpt = scratch_path(spark, "log"), scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    rows = lambda p, a, z: spark.createDataFrame([("t", p, o, None, None, b"x") for o in range(a, z)], LOG)
    write_log(rows(0, 0, 5), path)
    table = LogTable(spark, path)
    go = lambda: run(spark, path, {"t": 100}, "topic", sink, ckpt)
    go()
    table.append(rows(0, 5, 8))
    table.append(rows(3, 0, 2))
    go()
    assert batches(spark, sink) == {**{("t", 0, o): 0 for o in range(5)}, **{("t", 0, o): 1 for o in range(5, 8)}, ("t", 3, 0): 1, ("t", 3, 1): 1}
    table.append(rows(0, 8, 12))
    table.truncate({("t", 0): 10})
    with pytest.raises(Exception, match="is to be read"):
        go()
    assert acc.watermarks(table.read()).count() == 2


def test_starting_at_the_end(spark, small):
    path, sink, ckpt = scratch_path(spark, "log"), scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    rows = lambda a, z: spark.createDataFrame([("t", 0, o, None, None, b"x") for o in range(a, z)], LOG)
    write_log(rows(0, 5), path)
    q = run_every(stream_table(spark, path, {"t": 2}, ckpt, starting="latest"), batch_sink(sink), ckpt, "0 seconds")
    try:
        q.processAllAvailable()
        LogTable(spark, path).append(rows(5, 9))
        q.processAllAvailable()
    finally:
        q.stop()
    assert sorted(k[2] for k in batches(spark, sink)) == [5, 6, 7, 8]


def test_topics_with_odd_names(spark, tmp_path):
    path, sink, ckpt = f"file://{tmp_path}/log", scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    names = ["a b", "50%", "x=y/z"]
    write_log(spark.createDataFrame([(n, 0, o, None, None, b"x") for n in names for o in range(3)], LOG), path)
    run(spark, path, dict.fromkeys(names, 2), "partition", sink, ckpt)
    assert batches(spark, sink) == {(n, 0, o): o // 2 for n in names for o in range(3)}
