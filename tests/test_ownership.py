"""Replay, compaction, seek, truncation and ownership around the loop's commits."""

import pytest

from loglake.schema import LOG
from loglake.session import scratch_path
from loglake.sources.log import LogTable, write_log
from loglake.sources.offsets import FencedError, OffsetStore, StaleCommitError
from loglake.streaming.processor import DataLossError, Processor, Runner, TopicController


def log_table(spark, ends):
    path = scratch_path(spark, "log")
    write_log(spark.createDataFrame([(t, p, o, None, None, b"") for (t, p), z in ends.items() for o in range(z)], LOG), path)
    return LogTable(spark, path)


class Seen:
    def __init__(self, fail_at=None):
        self.keys, self.fail_at, self.batches = [], fail_at, []

    def __call__(self, df, batch_id):
        self.batches.append(batch_id)
        self.keys += [(r["partition"], r["offset"]) for r in df.collect()]
        if batch_id == self.fail_at:
            self.fail_at = None
            raise RuntimeError("boom")


def processor(log, store, wal, fn, queue=10, **kw):
    return Processor(log, store, TopicController("g", "t", queue), fn, wal_root=wal, reset="earliest", **kw)


def test_compact_twice_seek_restart(spark):
    """A committed batch is not run again, and a seek stays, however often the store was compacted."""
    log, root, wal = log_table(spark, {("t", 0): 20}), scratch_path(spark, "offsets"), scratch_path(spark, "wal")
    first = Seen()
    processor(log, OffsetStore(spark, root), wal, first, 100).run(stop_when_idle=True)
    store = OffsetStore(spark, root)
    store.compact()
    store.compact()
    store.seek("g", [("t", 0, 3)])
    second = Seen()
    processor(log, OffsetStore(spark, root), wal, second, 100).run(stop_when_idle=True)
    assert first.batches == [0] and second.batches == [1]
    assert sorted(second.keys) == [(0, o) for o in range(3, 20)]
    assert store.current("g")[("g", "t", 0)][0] == 20


def test_seek_after_a_failed_batch_voids_its_plan(spark):
    """One position set by hand: the batch id is planned anew, so its sink folder holds the new ranges only."""
    log, root, wal = log_table(spark, {("t", 0): 20, ("t", 1): 20}), scratch_path(spark, "offsets"), scratch_path(spark, "wal")
    with pytest.raises(RuntimeError):
        processor(log, OffsetStore(spark, root), wal, Seen(fail_at=1), 10).run(stop_when_idle=True)
    OffsetStore(spark, root).seek("g", [("t", 1, 15)])
    again = Seen()
    processor(log, OffsetStore(spark, root), wal, again, 10).run(stop_when_idle=True)
    assert again.batches[0] == 1
    assert sorted(again.keys) == [*((0, o) for o in range(5, 20)), *((1, o) for o in range(15, 20))]


@pytest.mark.parametrize("strict", [True, False])
def test_truncated_planned_range(spark, strict):
    log, root, wal = log_table(spark, {("t", 0): 20, ("t", 1): 20}), scratch_path(spark, "offsets"), scratch_path(spark, "wal")
    with pytest.raises(RuntimeError, match="boom"):
        processor(log, OffsetStore(spark, root), wal, Seen(fail_at=0), 100).run(stop_when_idle=True)
    log.truncate({("t", 1): 20})
    log.sweep()
    again, store = Seen(), OffsetStore(spark, root)
    p = processor(log, store, wal, again, 100, fail_on_data_loss=strict)
    if strict:
        with pytest.raises(DataLossError, match="planned 0..20"):
            p.run(stop_when_idle=True)
        assert again.keys == [] and store.current("g") == {}
    else:
        p.run(stop_when_idle=True)
        assert sorted(again.keys) == [(0, o) for o in range(20)]


def test_the_slower_of_two_processors_is_refused(spark):
    log, root = log_table(spark, {("t", 0): 12}), scratch_path(spark, "offsets")
    fast_seen, done = Seen(), []
    fast = processor(log, OffsetStore(spark, root), scratch_path(spark, "wal"), fast_seen, 5, name="fast")

    def overtaken(df, batch_id):
        if not done:
            done.append(fast.run(stop_when_idle=True))

    slow = processor(log, OffsetStore(spark, root), scratch_path(spark, "wal"), overtaken, 5, name="slow")
    with pytest.raises(FencedError, match="belongs to fast"):
        slow.run(stop_when_idle=True)
    store = OffsetStore(spark, root)
    assert store.current("g") == {("g", "t", 0): (12, 3)} and slow.batches == []
    assert sorted(fast_seen.keys) == [(0, o) for o in range(12)] and store.owner(("g", "t", 0))[0] == 2


def test_a_seek_while_running_is_not_overwritten(spark):
    log, store = log_table(spark, {("t", 0): 12}), OffsetStore(spark, scratch_path(spark, "offsets"))

    def moved(df, batch_id):
        store.seek("g", [("t", 0, 2)])

    with pytest.raises(StaleCommitError, match="moved meanwhile"):
        processor(log, store, scratch_path(spark, "wal"), moved, 5).run(stop_when_idle=True)
    assert store.current("g")[("g", "t", 0)][0] == 2


def test_processors_that_fight_for_one_topic_lose_nothing(spark):
    """Two in one runner: whoever loses a key ends with an error; restarted alone, the group reads on, each message stored once past."""
    log, root = log_table(spark, {("t", 0): 30, ("t", 1): 30}), scratch_path(spark, "offsets")
    seen, wals = [Seen(), Seen()], [scratch_path(spark, "wal") for _ in range(2)]
    make = lambda i: processor(log, OffsetStore(spark, root), wals[i], seen[i], 8, name=f"p{i}")
    try:
        Runner([make(0), make(1)]).start(stop_when_idle=True)
    except StaleCommitError:
        pass
    make(0).run(stop_when_idle=True)
    assert {k[2]: v for k, (v, _) in OffsetStore(spark, root).current("g").items()} == {0: 30, 1: 30}
    assert set(seen[0].keys) | set(seen[1].keys) == {(p, o) for p in (0, 1) for o in range(30)}
