"""Planned loop: exactly-once drain, stop, failure without commit, replay of
the same plan, gate, several processors, registration errors."""

import threading

import pytest
from pyspark.sql import functions as F

from loglake.operators import accounting as acc
from loglake.operators.fetch import fetch_group
from loglake.session import scratch_path
from loglake.sources.fixtures import fixture_log
from loglake.sources.offsets import OffsetStore
from loglake.streaming.processor import (
    PartitionController,
    Processor,
    Runner,
    TopicController,
    TopicSetController,
    every,
    lag_at_least,
)


class Collect:
    """Batch function remembering (batch_id, keys) of each batch."""

    def __init__(self, fail_at=None):
        self.seen = []
        self.fail_at = fail_at
        self.lock = threading.Lock()

    def __call__(self, df, batch_id):
        keys = [(r["topic"], r["partition"], r["offset"]) for r in df.select("topic", "partition", "offset").collect()]
        with self.lock:
            self.seen.append((batch_id, sorted(keys)))
        if self.fail_at is not None and batch_id == self.fail_at:
            self.fail_at = None
            raise RuntimeError("boom")

    def keys(self):
        return [k for _, ks in self.seen for k in ks]


def _proc(spark, log, ctl, fn, **kw):
    store = kw.pop("store", None) or OffsetStore(spark, scratch_path(spark, "offsets"))
    return Processor(log, store, ctl, fn, wal_root=kw.pop("wal", None) or scratch_path(spark, "wal"),
                     reset="earliest", **kw)


def test_drain_delivers_each_record_once(spark, small):
    log = fixture_log(spark, small, "events")
    fn = Collect()
    p = _proc(spark, log, TopicController("g", "click", 60), fn)
    n = p.run(stop_when_idle=True)
    keys = fn.keys()
    assert n == len(fn.seen) > 1
    assert len(keys) == len(set(keys)) == log.filter(F.col("topic") == "click").count()
    assert p.lag() == 0
    for _, ks in fn.seen:  # batch bound of the topic rule: <= max(max_queue, P) when partial
        assert len(ks) <= 200


def test_partition_controller_reads_one_partition(spark, small):
    log = fixture_log(spark, small, "events")
    fn = Collect()
    _proc(spark, log, PartitionController("g", "view", 3, 10), fn).run(stop_when_idle=True)
    assert {p for _, p, _ in fn.keys()} == {3}
    assert all(len(ks) <= 10 for _, ks in fn.seen)


def test_failure_no_commit_then_same_plan_replayed(spark, small):
    log = fixture_log(spark, small, "events")
    store, wal = OffsetStore(spark, scratch_path(spark, "offsets")), scratch_path(spark, "wal")
    stopped = []
    fn = Collect(fail_at=1)
    p1 = _proc(spark, log, TopicController("g", "click", 60), fn, store=store, wal=wal,
               on_stopped=lambda: stopped.append(1))
    with pytest.raises(RuntimeError):
        p1.run(stop_when_idle=True)
    assert stopped == [1]  # hook ran although the batch failed
    first_attempt = fn.seen[-1]
    assert first_attempt[0] == 1
    p2 = _proc(spark, log, TopicController("g", "click", 60), fn, store=store, wal=wal)
    p2.run(stop_when_idle=True)
    replay = fn.seen[len(fn.seen) - len(p2.batches)]
    assert replay == first_attempt  # same batch id, same records
    delivered = [k for b, ks in fn.seen if not (b == 1 and ks is first_attempt[1]) for k in ks]
    assert len(set(delivered)) == log.filter(F.col("topic") == "click").count()


def test_stop_between_batches(spark, small):
    log = fixture_log(spark, small, "events")
    p = None

    def fn(df, batch_id):
        p.stop()

    p = _proc(spark, log, TopicController("g", "click", 20), fn)
    assert p.run() == 1  # stop honoured after the current batch


def test_gate(spark, small):
    log = fixture_log(spark, small, "events")
    fn = Collect()
    p = _proc(spark, log, TopicController("g", "click", 40), fn, gate=lag_at_least(10**9))
    assert p.run(stop_when_idle=True) == 0 and fn.seen == []
    q = _proc(spark, log, TopicController("g2", "click", 40), Collect(), gate=every(0.0))
    assert q.run(stop_when_idle=True, max_batches=2) == 2


def test_runner_two_processors(spark, small):
    log = fixture_log(spark, small, "events")
    a, b = Collect(), Collect()
    store = OffsetStore(spark, scratch_path(spark, "offsets"))
    r = Runner().add(_proc(spark, log, TopicController("p1", "click", 100), a, store=store, name="p1"))
    r.add(_proc(spark, log, TopicController("p2", "click", 50), b, store=store, name="p2"))
    done = r.start(stop_when_idle=True)
    assert set(done) == {"p1", "p2"}
    assert sorted(a.keys()) == sorted(b.keys())  # independent groups each read everything


def test_topic_set_skips_idle_topics_and_empty_fetch(spark, small):
    log = fixture_log(spark, small, "events")
    water = acc.watermarks(log)
    regs = acc.registrations(spark, [("g", "click", 10), ("g", "view", 10)])
    pos = acc.positions_at(water, regs, F.col("latest"))  # no lag anywhere
    f = fetch_group(log, pos)
    assert f.plan == [] and f.data.count() == 0 and f.data.columns == log.columns


def test_registration_errors(spark, small):
    log = fixture_log(spark, small, "events")
    with pytest.raises(ValueError):
        TopicSetController([("g", "click"), ("g", "click")])
    p = _proc(spark, log, TopicController("g", "nope", 10), Collect())
    with pytest.raises(ValueError):
        p.run(stop_when_idle=True)


def test_data_loss_detected_or_clipped(spark, small):
    """The log is truncated under a running loop (retention passes the
    position): raise by default, clip to earliest when asked. At registration
    a position below the range is moved to earliest instead (E1)."""
    from loglake.streaming.processor import DataLossError

    events, retained = fixture_log(spark, small, "events"), fixture_log(spark, small, "retained")
    for strict in (True, False):
        current = [events]
        fn = Collect()
        p = _proc(spark, lambda: current[0], TopicController("g", "click", 8), fn, fail_on_data_loss=strict)
        assert p.run(stop_when_idle=True, max_batches=1) == 1  # positions now at 2 per partition
        current[0] = retained
        if strict:
            with pytest.raises(DataLossError):
                p.run(stop_when_idle=True)
        else:
            p.run(stop_when_idle=True)
            later = [k for b, ks in fn.seen if b > 0 for k in ks]
            assert min(o for _, _, o in later) == 10
            assert len(later) == retained.filter(F.col("topic") == "click").count()


def test_loop_matches_closed_form(spark, small):
    """Iterating plan -> fetch -> commit gives every record the batch number
    of the closed form, for both multi-partition rules and several throttles."""
    from loglake.plans.drain import drain

    log = fixture_log(spark, small, "events")
    for rule, mq in (("topic", 7), ("topic", 64), ("group", 9), ("group", 400)):
        fn = Collect()
        ctl = TopicController("g", "view", mq) if rule == "topic" else TopicSetController([("g", "view", mq), ("g", "signup", mq)])
        _proc(spark, log, ctl, fn).run(stop_when_idle=True)
        got = {k: b for b, ks in fn.seen for k in ks}
        water = acc.watermarks(log)
        regs = acc.registrations(spark, ctl.entries)
        closed = drain(log, acc.positions_at(water, regs, F.lit(0)), rule=rule)
        want = {(r["topic"], r["partition"], r["offset"]): r["batch_no"] for r in closed.collect()}
        assert got == want, (rule, mq)


def test_ranges_contiguous_and_bounded(spark, small):
    """Each batch starts where the previous one stopped (per partition), and
    a partial batch of the topic rule holds at most max(max_queue, P)
    offsets, of the group rule at most per_each per partition."""
    log = fixture_log(spark, small, "events")
    for ctl, mq in ((TopicController("g", "error", 30), 30), (TopicSetController([("g", "error", 30)]), 30)):
        p = _proc(spark, log, ctl, lambda df, b: None)
        wal, write = [], p._write_wal
        p._write_wal = lambda b, rows, commit: (wal.append(rows), write(b, rows, commit))
        p.run(stop_when_idle=True)
        last_stop = {}
        for rows in wal:
            for r in rows:
                key = (r["topic"], r["partition"])
                assert r["start_offset"] == last_stop.get(key, 0)
                last_stop[key] = r["stop_offset"]
            offsets = sum(r["stop_offset"] - r["start_offset"] for r in rows)
            each = max(r["stop_offset"] - r["start_offset"] for r in rows)
            if ctl.rule == "group":
                assert each <= max(1, mq // 4)
            elif rows is not wal[-1]:
                assert offsets <= max(mq, 4)
        water = {(r["topic"], r["partition"]): r["latest"] for r in acc.watermarks(log).collect()}
        assert all(last_stop[k] == water[k] for k in last_stop)


def test_negative_bounds_refused_in_loop(spark, small):
    log = fixture_log(spark, small, "events")
    shifted = log.withColumn("offset", F.col("offset") - 5)  # a broken source reporting negative offsets
    with pytest.raises(acc.UnstableSourceError):
        _proc(spark, shifted, TopicController("g", "click", 10), Collect()).run(stop_when_idle=True)
