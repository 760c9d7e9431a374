"""Structured Streaming forms over a file log."""

from pyspark.sql import functions as F

from loglake.operators.sink import read_batches
from loglake.session import scratch_path
from loglake.sources.fixtures import event_id_of, fixture_log
from loglake.sources.log import write_log
from loglake.streaming.structured import batch_sink, dedup_within, run_available_now, stream_log


def _file_log(spark, small, name, files=12):
    path = scratch_path(spark, "filelog")
    write_log(fixture_log(spark, small, name), path, files_per_partition=files)
    return path


def test_throttled_by_files(spark, small):
    src, sink = _file_log(spark, small, "events"), scratch_path(spark, "sink")
    q = run_available_now(stream_log(spark, src, 3), batch_sink(sink), scratch_path(spark, "ckpt"))
    q.awaitTermination()
    out = read_batches(spark, sink)
    assert out.select("batch_id").distinct().count() > 1
    assert out.count() == fixture_log(spark, small, "events").count()


def test_replayed_batch_overwrites(spark, small):
    src, sink, ckpt = _file_log(spark, small, "events"), scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    write, failed, failures = batch_sink(sink), [], 0

    def flaky(df, batch_id):
        write(df, batch_id)
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("boom")

    for _ in range(2):
        q = run_available_now(stream_log(spark, src, 3), flaky, ckpt)
        try:
            q.awaitTermination()
            break
        except Exception:
            failures += 1
    assert failures == 1
    out = read_batches(spark, sink)
    assert out.count() == out.select("topic", "partition", "offset").distinct().count()
    assert out.count() == fixture_log(spark, small, "events").count()


def test_dedup_within_watermark(spark, small):
    src, sink = _file_log(spark, small, "dup"), scratch_path(spark, "sink")
    s = dedup_within(stream_log(spark, src, 4).withColumn("event_id", event_id_of()), ["event_id"])
    q = run_available_now(s, batch_sink(sink), scratch_path(spark, "ckpt"))
    q.awaitTermination()
    out = read_batches(spark, sink)
    events = spark.read.parquet(f"{small}/events.parquet")
    assert out.count() == events.count() == out.select("event_id").distinct().count()
    assert fixture_log(spark, small, "dup").count() > events.count()


def test_terminated_hook(spark, small):
    import time

    from loglake.streaming.structured import on_terminated

    ended = []
    listener = on_terminated(spark, lambda qid, exc: ended.append((qid, exc)))
    try:
        src, sink = _file_log(spark, small, "events"), scratch_path(spark, "sink")
        q = run_available_now(stream_log(spark, src, 20), batch_sink(sink), scratch_path(spark, "ckpt"))
        q.awaitTermination()
        for _ in range(50):  # listener events are delivered asynchronously
            if ended:
                break
            time.sleep(0.1)
        assert ended and ended[0][0] == str(q.id) and ended[0][1] is None
    finally:
        spark.streams.removeListener(listener)


def test_timed_trigger_and_stop(spark, small):
    import time

    from loglake.streaming.structured import run_every

    src, sink = _file_log(spark, small, "events"), scratch_path(spark, "sink")
    ckpt = scratch_path(spark, "ckpt")
    q = run_every(stream_log(spark, src, 50), batch_sink(sink), ckpt, "200 milliseconds")
    q.processAllAvailable()
    q.stop()
    first = read_batches(spark, sink).count()
    assert first == fixture_log(spark, small, "events").count()
    # restart on the same checkpoint: nothing new, nothing replayed twice
    q2 = run_every(stream_log(spark, src, 50), batch_sink(sink), ckpt, "200 milliseconds")
    q2.processAllAvailable()
    time.sleep(0.5)
    q2.stop()
    assert read_batches(spark, sink).count() == first


def test_stream_dedup_null_ids_and_expiry(spark):
    """Messages without an id all stay; a copy after the watermark passed its id is a new message, one before is not."""
    import datetime as dt

    from loglake.schema import LOG

    def message(offset, minute, value):
        at = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(minutes=minute)
        return ("t", 0, offset, at, None, value)

    src, sink, ckpt = scratch_path(spark, "src"), scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    batches = [[(0, b"a"), (1, None), (1, None)], [(3, b"a"), (30, b"b")], [(31, b"c")], [(32, b"a"), (33, b"b")]]
    offset = 0
    for rows in batches:  # one file and one run each, so that the watermark moves in between
        made = [message(offset + i, m, v) for i, (m, v) in enumerate(rows)]
        offset += len(rows)
        spark.createDataFrame(made, LOG).coalesce(1).write.mode("append").partitionBy("topic", "partition").parquet(src)
        stream = dedup_within(stream_log(spark, src).withColumn("id", F.col("value").cast("string")), ["id"], delay="10 minutes")
        run_available_now(stream, batch_sink(sink), ckpt).awaitTermination()
    kept = sorted(r["offset"] for r in read_batches(spark, sink).collect())
    assert kept == [0, 1, 2, 4, 5, 6]  # 3 is an early copy, 6 a copy after the expiry, 7 a copy of 4
