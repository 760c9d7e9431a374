"""Nothing is lost, doubled or merged outside the parameters that the queries use."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loglake.operators.dedup import dedup_batch
from loglake.operators.fetch import fetch_plan
from loglake.operators.accounting import UnstableSourceError
from loglake.operators.scan import range_scan
from loglake.plans.throttle import plan_topic
from loglake.schema import LOG
from loglake.session import checkpoint_root, scratch_path
from loglake.sources.fixtures import fixture_table
from loglake.sources.log import LogTable, to_log, write_log
from loglake.sources.offsets import OffsetStore
from loglake.streaming.processor import DataLossError, Processor, Runner, TopicController, TopicSetController


def log_of(spark, ends):
    """Messages 0 .. end - 1 of each (topic, partition)."""
    rows = [(t, p, o, None, None, str(o).encode()) for (t, p), (a, b) in ends.items() for o in range(a, b)]
    return spark.createDataFrame(rows, LOG)


class Seen:
    def __init__(self, fail_at=None):
        self.keys, self.fail_at, self.batches = [], fail_at, []

    def __call__(self, df, batch_id):
        self.batches.append(batch_id)
        if batch_id == self.fail_at:
            self.fail_at = None
            raise RuntimeError("boom")
        self.keys += [(r["topic"], r["partition"], r["offset"]) for r in df.collect()]


def processor(spark, log, ctl, fn, store=None, wal=None, **kw):
    return Processor(log, store or OffsetStore(spark, scratch_path(spark, "offsets")), ctl, fn, wal_root=wal or scratch_path(spark, "wal"), **{"reset": "earliest", **kw})


def test_two_processors_of_one_group_share_a_store(spark, small):
    log, store = fixture_table(spark, small, "events"), OffsetStore(spark, scratch_path(spark, "offsets"))
    fns = {t: Seen() for t in ("click", "view")}
    Runner([processor(spark, log, TopicController("g", t, 60), fns[t], store, name=t) for t in fns]).start(stop_when_idle=True)
    ends = {(r["topic"], r["partition"]): r["latest"] for r in log.bounds(["click", "view"]).collect()}
    assert {k[1:]: v for k, (v, _) in store.current("g").items()} == {k: v for k, v in ends.items() if v}
    again = Seen()
    processor(spark, log, TopicSetController([("g", "click"), ("g", "view")]), again, store, reset="latest").run(stop_when_idle=True)
    assert again.keys == []


def test_anothers_commit_does_not_hide_a_failed_batch(spark, small):
    log, store = fixture_table(spark, small, "events"), OffsetStore(spark, scratch_path(spark, "offsets"))
    wal, fn = scratch_path(spark, "wal"), Seen(fail_at=0)
    with pytest.raises(RuntimeError):
        processor(spark, log, TopicController("g", "click", 60), fn, store, wal).run(stop_when_idle=True)
    processor(spark, log, TopicController("g", "view", 60), Seen(), store).run(stop_when_idle=True)
    processor(spark, log, TopicController("g", "click", 60), fn, store, wal).run(stop_when_idle=True)
    assert fn.batches[:3] == [0, 0, 1]
    assert len(fn.keys) == len(set(fn.keys)) == log.read().filter("topic = 'click'").count()


def test_position_above_the_end_is_an_error_or_moves_once(spark):
    ends = {"now": 10}
    source = lambda: log_of(spark, {("t", 0): (0, ends["now"])})
    for strict in (True, False):
        ends["now"], fn = 10, Seen()
        p = processor(spark, source, TopicController("g", "t", 100), fn, fail_on_data_loss=strict)
        p.run(stop_when_idle=True)
        ends["now"] = 5
        if strict:
            with pytest.raises(DataLossError):
                p.step()
            continue
        assert not p.step()
        for end in (8, 12):
            ends["now"] = end
            p.run(stop_when_idle=True)
        assert [o for _, _, o in fn.keys] == [*range(10), *range(5, 12)]
        assert p.store.current("g")[("g", "t", 0)][0] == 12


@pytest.mark.parametrize("restart", [False, True])
def test_new_partition_starts_at_its_earliest(spark, restart):
    ends = {("t", 0): (0, 4)}
    store, wal, fn = OffsetStore(spark, scratch_path(spark, "offsets")), scratch_path(spark, "wal"), Seen()
    make = lambda: processor(spark, lambda: log_of(spark, ends), TopicController("g", "t", 100), fn, store, wal, reset="latest")
    p = make()
    p.step()
    ends[("t", 0)] = (0, 6)
    p.run(stop_when_idle=True)
    ends[("t", 1)] = (3, 7)
    (make() if restart else p).run(stop_when_idle=True)
    assert sorted(fn.keys) == [("t", 0, 4), ("t", 0, 5), *(("t", 1, o) for o in range(3, 7))]


def test_partition_that_left_the_bounds_is_an_error(spark):
    ends = {("t", 0): (0, 4), ("t", 1): (0, 4)}
    p = processor(spark, lambda: log_of(spark, ends), TopicController("g", "t", 100), Seen())
    p.run(stop_when_idle=True)
    del ends[("t", 1)]
    with pytest.raises(DataLossError):
        p.step()


def test_ranges_have_union_all_meaning_at_every_size(spark):
    ends = {("t", p): (0, 40) for p in range(100)}
    log = log_of(spark, ends).cache()
    path = scratch_path(spark, "log")
    write_log(log, path)
    rng = random.Random(7)
    for n in (2, 60, 70, 200, 1100):
        ranges = [("t", rng.randrange(100), *sorted((rng.randrange(41), rng.randrange(41)))) for _ in range(n)]
        want = Counter((p, o) for _, p, a, b in ranges for o in range(a, b))
        for source in (log, LogTable(spark, path)):
            got = Counter((r["partition"], r["offset"]) for r in range_scan(source, ranges).collect())
            assert got == want, n
    ranges = [("t", p, p % 7, 20 + p % 7) for p in range(100)] * 2
    plan = range_scan(LogTable(spark, path), ranges)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("PushedFilters") >= 4


def test_two_groups_on_one_topic_get_each_message_twice(spark):
    fn = Seen()
    ctl = TopicSetController([("a", "t", 100), ("b", "t", 100)])
    processor(spark, log_of(spark, {("t", 0): (0, 5)}), ctl, fn).run(stop_when_idle=True)
    assert Counter(fn.keys) == {("t", 0, o): 2 for o in range(5)}


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_files_of_a_partition_do_not_overlap(spark, medium, coalesce):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, coalesce)
    try:
        path = scratch_path(spark, "layout")
        write_log(fixture_table(spark, medium, "skew").read(), path, files_per_partition=7)
        files = LogTable(spark, path).read().groupBy("topic", "partition", F.input_file_name().alias("f")).agg(F.min("offset").alias("a"), F.max("offset").alias("b")).collect()
    finally:
        spark.conf.set(key, before)
    by_key = {}
    for r in files:
        by_key.setdefault((r["topic"], r["partition"]), []).append((r["a"], r["b"]))
    assert max(map(len, by_key.values())) > 1
    for runs in by_key.values():
        runs.sort()
        assert all(b < c for (_, b), (c, _) in zip(runs, runs[1:]))


def test_scratch_copies_go_and_null_keys_are_refused(spark):
    from loglake.session import path_exists

    rows = spark.createDataFrame([("a", 1, 5), ("a", 1, 3), ("b", 0, 1)], "t string, p int, o int")
    log = to_log(rows, "t", "p", ["o"])
    path = scratch_path(spark, "log")
    write_log(log, path)
    assert LogTable(spark, path).read().count() == 3 and not any(path_exists(spark, c) for c in log.scratch)
    with pytest.raises(Exception, match="a message has no topic"):
        to_log(rows.unionByName(spark.createDataFrame([(None, 1, 2)], rows.schema)), "t", "p", ["o"]).count()


def test_the_end_survives_retention_and_offsets_go_on(spark):
    path = scratch_path(spark, "log")
    write_log(log_of(spark, {("t", 0): (0, 6), ("t", 1): (0, 3)}), path)
    table = LogTable(spark, path)
    table.truncate({("t", 0): 6, ("t", 1): 1})
    bounds = lambda: {r["partition"]: (r["earliest"], r["latest"]) for r in table.bounds().collect()}
    assert bounds() == {0: (6, 6), 1: (1, 3)}
    new = spark.createDataFrame([("t", 0, None, None, b"x", 1), ("t", 2, None, None, b"y", 1)], "topic string, partition int, timestamp timestamp, key binary, value binary, o int")
    table.publish(new, ["o"])
    assert bounds() == {0: (6, 7), 1: (1, 3), 2: (0, 1)}
    assert [r["value"] for r in range_scan(table, [("t", 0, 6, 7)]).collect()] == [b"x"]
    # a crash after the reservation leaves a gap, no second use
    dead = LogTable(spark, path, lease_sec=0.0)
    dead._begin("dead", lambda s: [["t", 0, 7, 9]])
    table.publish(new, ["o"])
    assert bounds()[0] == (6, 10)


def test_messages_without_id_are_not_merged(spark):
    rows = [(1, "t", 0, 0), (1, "t", 0, 1), (None, "t", 0, 2), (None, "t", 0, 3), (None, "t", 1, 0)]
    out = dedup_batch(spark.createDataFrame(rows, "id int, topic string, partition int, offset long"), "id").collect()
    assert sorted(map(tuple, out), key=str) == sorted([rows[0], *rows[2:]], key=str)


def test_fetch_refuses_negative_bounds(spark):
    names = "group_id string, topic string, partition int, max_queue int, earliest long, latest long, stored long, position long, status string"
    positions = spark.createDataFrame([("g", "t", 0, 10, -2, -1, None, -2, "set")], names)
    with pytest.raises(UnstableSourceError):
        fetch_plan(log_of(spark, {("t", 0): (0, 1)}), plan_topic(positions))


def test_no_silent_local_folder_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())
