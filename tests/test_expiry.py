"""Streaming duplicates with event-time timers, against a brute-force walk through the batches."""

import datetime as dt
import random

from pyspark.sql import functions as F

from loglake.operators.sink import read_batches
from loglake.schema import LOG
from loglake.session import scratch_path
from loglake.sources.committed_sink import read_committed, write_committed
from loglake.sources.log import write_log
from loglake.streaming.expiry import dedup_until_expiry
from loglake.streaming.log_source import drain, stream_table
from loglake.streaming.structured import batch_sink, run_available_now, run_every, stateful_session

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def brute(batches, keep, delay):
    """(partition, offset) of the survivors; times in minutes. A batch runs under the watermark of the batches before it, and
    timers behind that watermark go off after its rows."""
    seen, out, watermark = {}, [], None
    for rows in batches:
        alive = [r for r in rows if watermark is None or r[1] >= watermark]
        for key in {r[2] if r[2] is not None else ("@", r[0]) for r in alive}:
            copies = sorted(r for r in alive if (r[2] if r[2] is not None else ("@", r[0])) == key)
            if key not in seen:
                out.append(copies[0][0])
                seen[key] = max(copies[0][1] + keep, (watermark or 0) + 1e-9)
        if watermark is not None:
            seen = {k: until for k, until in seen.items() if until > watermark}
        high = max([r[1] for r in rows], default=0) - delay
        watermark = high if watermark is None else max(watermark, high)
        # the next run begins with a batch without rows under the new watermark
        seen = {k: until for k, until in seen.items() if until > watermark}
    return sorted(out)


def run(spark, batches, keep, delay):
    src, sink, ckpt = scratch_path(spark, "src"), scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    own = stateful_session(spark, 4)
    for rows in batches:
        made = [("t", o[0], o[1], START + dt.timedelta(minutes=m), None, None if i is None else str(i).encode()) for o, m, i in rows]
        spark.createDataFrame(made, LOG).repartition(3).write.mode("append").parquet(src)
        stream = own.readStream.schema(LOG).parquet(src).withColumn("id", F.col("value").cast("string"))
        run_available_now(dedup_until_expiry(stream, ["id"], keep * 60_000, f"{delay} minutes"), batch_sink(sink), ckpt).awaitTermination()
    return sorted((r["partition"], r["offset"]) for r in read_batches(spark, sink).collect())


def test_copies_before_and_after_the_expiry(spark):
    batches = [
        [((0, 0), 0, "a"), ((0, 1), 1, None), ((0, 2), 1, None), ((1, 0), 0, "a")],
        [((0, 3), 3, "a"), ((0, 4), 30, "b")],
        [((0, 5), 31, "c")],
        [((0, 6), 32, "a"), ((0, 7), 33, "b")],
    ]
    got = run(spark, batches, keep=10, delay=5)
    # 3 is an early copy of a; a has expired when 6 comes; 7 is an early copy of b
    assert got == [(0, 0), (0, 1), (0, 2), (0, 4), (0, 5), (0, 6)] == brute(batches, 10, 5)


def test_random_batches_with_a_hot_id(spark):
    rng, batches, offset = random.Random(6), [], 0
    for b in range(4):
        rows = []
        for _ in range(120):
            rows.append(((rng.randrange(3), offset), b * 10 + rng.randrange(10), 0 if rng.random() < 0.4 else rng.choice([None, *range(1, 60)])))
            offset += 1
        batches.append(rows)
    assert run(spark, batches, keep=12, delay=8) == brute(batches, 12, 8)


def test_own_session_beside_one_that_knows_the_sources(spark):
    log = scratch_path(spark, "log")
    write_log(spark.createDataFrame([("t", 0, i, START, None, b"x") for i in range(5)], LOG), log)
    for session in (spark, stateful_session(spark, 2), spark):
        sink, ckpt, root = (scratch_path(spark, name) for name in ("sink", "ckpt", "root"))
        drain(run_every(stream_table(session, log, {"t": 3}, ckpt), batch_sink(sink), ckpt, "0 seconds"))
        assert sorted(r["offset"] for r in read_batches(spark, sink).collect()) == list(range(5))
        write_committed(session.range(3), root)
        assert read_committed(spark, root, session.range(3).schema).count() == 3
