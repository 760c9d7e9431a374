"""The log table's records: files, bounds, concurrent writers, retention, time index, zone map."""

import datetime as dt
import threading
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loglake.operators import accounting as acc
from loglake.operators.scan import range_scan
from loglake.operators.sizing import LEAST_BYTES, file_tasks, input_bytes
from loglake.schema import LOG
from loglake.session import path_exists, scratch_path
from loglake.sources.fixtures import build_events_log, fixture_table, table
from loglake.sources.log import LogTable, Overtaken, append_records, write_log

RECORDS = "topic string, partition int, timestamp timestamp, key binary, value binary, o long"


def log_of(spark, ends, start=0):
    at = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    rows = [(t, p, o, at + dt.timedelta(seconds=o), None, str(o).encode()) for (t, p), end in ends.items() for o in range(start, end)]
    return spark.createDataFrame(rows, LOG)


def records(spark, n, partitions=2, tag="x"):
    return spark.createDataFrame([("t", i % partitions, None, None, f"{tag}{i}".encode(), i) for i in range(n)], RECORDS)


def ends(t):
    return {k[1]: v for k, v in t.ends().items()}


def messages(t):
    return [(r["topic"], r["partition"], r["offset"]) for r in t.read().collect()]


# --- files ---------------------------------------------------------------------


def test_task_count_follows_bytes_not_joins(spark, medium):
    events = table(spark, medium, "events")
    joined = events.join(table(spark, medium, "customer"), F.col("user_id") == F.col("c_custkey"), "left").join(events.select(F.col("event_id").alias("e")), F.col("event_id") == F.col("e"))
    assert input_bytes(joined) <= 3 * sum(input_bytes(table(spark, medium, n)) for n in ("events", "customer"))
    assert file_tasks(joined) == 1
    assert file_tasks(spark.createDataFrame([(1,)], "a int")) >= 1  # a leaf of unknown size is no error


def test_files_are_bounded_by_bytes(spark, medium):
    path = scratch_path(spark, "log")
    write_log(build_events_log(table(spark, medium, "events")), path)
    t = LogTable(spark, path)
    files = t.chain.ask(lambda s: [f for files in s.files.values() for f in files])
    size = input_bytes(t.read())
    partitions = len(t.ends())
    assert len(files) <= max(1, -(-size // LEAST_BYTES)) + partitions and len(files) <= 4 * partitions
    assert sum(f.rows for f in files) == t.read().count() == 10_000


# --- writers --------------------------------------------------------------------


def test_append_to_a_log_of_another_writer_keeps_its_messages(spark):
    path = scratch_path(spark, "foreign")
    log_of(spark, {("t", 0): 50, ("a b/c", 1): 3}).write.partitionBy("topic", "partition").parquet(path)
    t = LogTable(spark, path)
    assert t.ends() == {("t", 0): (0, 50), ("a b/c", 1): (0, 3)}
    t.append(append_records(t, records(spark, 4, 1), ["o"]))
    assert t.ends() == {("t", 0): (0, 54), ("a b/c", 1): (0, 3)}
    assert sorted(messages(t)) == sorted([*(("t", 0, o) for o in range(54)), *(("a b/c", 1, o) for o in range(3))])
    assert range_scan(t, [("t", 0, 48, 52), ("a b/c", 1, 1, 9)]).count() == 6


def test_a_killed_publisher_leaves_a_gap_and_nothing_twice(spark, monkeypatch):
    path = scratch_path(spark, "log")
    write_log(log_of(spark, {("t", 0): 5, ("t", 1): 5}), path)
    dead, alive = LogTable(spark, path, lease_sec=2.0), LogTable(spark, path)

    def killed(write, files):
        raise KeyboardInterrupt

    monkeypatch.setattr(dead, "_finish", killed)
    with pytest.raises(KeyboardInterrupt):  # between its files and their record
        dead.publish(records(spark, 8), ["o"])
    monkeypatch.undo()
    alive.publish(records(spark, 2), ["o"])
    if alive.chain.ask(lambda s: s.open):  # under way as far as anyone knows: nobody reads past it
        assert {z for _, z in ends(alive).values()} <= {5, 10}
    import time

    time.sleep(2.1)
    assert ends(alive) == {0: (0, 10), 1: (0, 10)}  # 5..8 lapsed, 9 came behind them
    got = Counter(messages(alive))
    assert max(got.values()) == 1 and sorted(got) == [("t", p, o) for p in (0, 1) for o in (0, 1, 2, 3, 4, 9)]
    with pytest.raises(Overtaken):  # it was not dead after all: too late
        write = "late"
        dead._begin(write, lambda s: [["t", 0, s.next_offset(("t", 0)), s.next_offset(("t", 0)) + 1]])
        dead.chain.append(lambda s: {"kind": "abort", "id": write})
        dead._finish(write, [])


def test_readers_wait_for_a_write_that_is_under_way(spark):
    path = scratch_path(spark, "log")
    write_log(log_of(spark, {("t", 0): 5}), path)
    slow, fast = LogTable(spark, path), LogTable(spark, path)
    slow._begin("slow", lambda s: [["t", 0, 5, 8]])
    fast.publish(records(spark, 2, 1), ["o"])  # offsets 8, 9
    assert ends(fast) == {0: (0, 5)}
    slow._finish("slow", slow._write_files(log_of(spark, {("t", 0): 8}, 5), "slow", 1))
    assert ends(fast) == {0: (0, 10)} and len(messages(fast)) == 10


def test_concurrent_publishers(spark):
    path, n = scratch_path(spark, "log"), 4
    write_log(log_of(spark, {("t", 0): 3}), path)
    errors = []

    def work(i):
        try:
            LogTable(spark, path).publish(records(spark, 10 + i, 2, f"w{i}-"), ["o"])
        except BaseException as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=work, args=(i,)) for i in range(n)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    t = LogTable(spark, path)
    assert not errors
    rows = t.read().collect()
    by_partition = {p: sorted(r["offset"] for r in rows if r["partition"] == p) for p in (0, 1)}
    assert all(o == list(range(len(o))) for o in by_partition.values())
    assert Counter(bytes(r["value"]) for r in rows if bytes(r["value"]).startswith(b"w")) == Counter(f"w{i}-{j}".encode() for i in range(n) for j in range(10 + i))
    for i in range(n):  # each writer's order is kept
        for p in (0, 1):
            own = [bytes(r["value"]).decode() for r in sorted(rows, key=lambda r: r["offset"]) if r["partition"] == p and bytes(r["value"]).startswith(f"w{i}-".encode())]
            assert own == sorted(own, key=lambda v: int(v.split("-")[1]))


def test_offsets_given_out_are_refused(spark):
    path = scratch_path(spark, "log")
    write_log(log_of(spark, {("t", 0): 5}), path)
    t = LogTable(spark, path)
    stale = append_records(t, records(spark, 3, 1), ["o"])
    t.publish(records(spark, 1, 1), ["o"])
    with pytest.raises(Overtaken, match="given out up to 6"):
        t.append(stale)
    assert ends(t) == {0: (0, 6)} and len(messages(t)) == 6
    fs_writes = t.chain.ask(lambda s: s.writes)
    assert all(path_exists(spark, f"{path}/write={w}") for w in fs_writes)


def test_input_is_not_evaluated_again_for_bounds(spark):
    """Bounds come from the files: a source that gives other rows each time still has bounds that equal its files."""
    path = scratch_path(spark, "log")
    rows = spark.range(2000).select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.lit(None).cast("timestamp").alias("timestamp"), F.lit(None).cast("binary").alias("key"), F.lit(None).cast("binary").alias("value"), F.col("id").alias("o")).where("rand() < 0.5")
    t = LogTable(spark, path)
    t.publish(rows, ["o"])
    assert sorted(acc.watermarks(t.read()).collect()) == sorted(t.bounds().collect())


# --- retention and time -----------------------------------------------------------


def test_retention_removes_messages(spark):
    path = scratch_path(spark, "log")
    write_log(log_of(spark, {("t", 0): 40, ("t", 1): 10, ("u", 0): 4}), path, files_per_partition=6)
    t = LogTable(spark, path)
    t.truncate({("t", 0): 17, ("t", 1): 10})
    left = [*(("t", 0, o) for o in range(17, 40)), *(("u", 0, o) for o in range(4))]
    assert t.ends() == {("t", 0): (17, 40), ("t", 1): (10, 10), ("u", 0): (0, 4)}
    for _ in range(2):
        assert sorted(messages(t)) == left
        assert sorted(map(tuple, acc.watermarks(t.read()).collect())) == [("t", 0, 17, 40), ("u", 0, 0, 4)]
        assert range_scan(t, [("t", 0, 0, 20)]).count() == 3
        gone = t.sweep()
    assert gone == 0 and t.ends()[("t", 1)] == (10, 10)
    assert t.publish(records(spark, 2), ["o"]) and t.ends()[("t", 1)] == (10, 11)


def test_offsets_at_time(spark, small):
    t = fixture_table(spark, small, "events")
    rows = [(r["topic"], r["partition"], r["offset"], r["us"]) for r in t.read().select("topic", "partition", "offset", F.unix_micros("timestamp").alias("us")).collect()]
    times = sorted(r[3] for r in rows)
    for at in (0, times[len(times) // 3], times[len(times) // 2] + 1, times[-1], times[-1] + 1):
        got = {(r["topic"], r["partition"]): r["offset"] for r in t.offsets_at_time(at).collect()}
        assert got == {k: min((o for *tp, o, us in rows if tuple(tp) == k and us >= at), default=z) for k, (_, z) in t.ends().items()}


def test_time_index_with_unordered_times_and_retention(spark):
    path = scratch_path(spark, "log")
    at = [5, 1, 9, 2, 8, 3, 7, 4]
    rows = [("t", 0, o, dt.datetime.fromtimestamp(s, dt.timezone.utc), None, None) for o, s in enumerate(at)]
    write_log(spark.createDataFrame(rows, LOG), path, files_per_partition=3)
    t = LogTable(spark, path)
    for cut in (0, 1, 3, 5):
        t.truncate({("t", 0): cut})
        for s in range(11):
            want = min((o for o, x in enumerate(at) if x >= s and o >= cut), default=8)
            assert [r["offset"] for r in t.offsets_at_time(s * 1_000_000).collect()] == [want], (cut, s)


# --- zone map -------------------------------------------------------------------


def test_plan_of_5000_ranges_opens_only_its_files(spark):
    path = scratch_path(spark, "log")
    log = spark.range(50_000).select(F.lit("t").alias("topic"), (F.col("id") % 5).cast("int").alias("partition"), F.floor(F.col("id") / 5).alias("offset"), F.lit(None).cast("timestamp").alias("timestamp"), F.lit(None).cast("binary").alias("key"), F.lit(None).cast("binary").alias("value"))
    write_log(log, path, files_per_partition=60)
    t = LogTable(spark, path)
    files = t.chain.ask(lambda s: {f.path: (k[1], f.low, f.latest) for k, some in s.files.items() for f in some})
    assert len(files) >= 60
    ranges = [("t", i % 2, 1000 + i // 2, 1003 + i // 2) for i in range(5000)]
    want = Counter((p, o) for _, p, a, b in ranges for o in range(a, b))
    got = range_scan(t, ranges)
    opened = {f.split(path.removeprefix("file:") + "/")[1] for f in got.inputFiles()}
    assert opened == {f for f, (p, a, z) in files.items() if p < 2 and a < 3502 and z > 1000} and len(opened) < len(files) / 4
    assert Counter((r["partition"], r["offset"]) for r in got.collect()) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(offset,1000)" in plan and "LessThan(offset,3502)" in plan
    piled = [("t", 0, 0, 10 + i) for i in range(200)]  # on top of each other: one scan, not 200
    scan = range_scan(t, piled)
    assert scan._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert scan.count() == sum(10 + i for i in range(200))


def test_missing_files_are_an_error(spark):
    from loglake.session import delete_path

    path = scratch_path(spark, "log")
    write_log(log_of(spark, {("t", 0): 5, ("t", 1): 5}), path)
    t = LogTable(spark, path)
    for f in t.chain.ask(lambda s: s.overlapping([("t", 0, 0, 5)])):
        delete_path(spark, f"{path}/{f}")
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        range_scan(t, [("t", 0, 0, 5)]).count()
    assert range_scan(t, [("t", 1, 0, 5)]).count() == 5


def test_topics_with_odd_names(spark):
    path = scratch_path(spark, "log")
    names = ["a b", "x=y", "50%", "é/漢", "q?*{r}", "[s]"]
    write_log(log_of(spark, {(n, 0): 4 for n in names}), path)
    t = LogTable(spark, path)
    assert sorted(messages(t)) == sorted((n, 0, o) for n in names for o in range(4))
    assert sorted((r["topic"], r["offset"]) for r in range_scan(t, [(n, 0, 1, 3) for n in names]).collect()) == sorted((n, o) for n in names for o in (1, 2))
