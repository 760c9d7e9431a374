"""Bounds, start resolution matrix, registration checks."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglake.operators import accounting as acc

WATER = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("earliest", T.LongType()),
        T.StructField("latest", T.LongType()),
    ]
)


def offsets(spark, rows):
    from loglake.schema import OFFSETS

    return spark.createDataFrame([(g, t, p, c, s, None) for g, t, p, c, s in rows], OFFSETS)


@pytest.fixture()
def water(spark):
    return spark.createDataFrame([("t", p, 10, 100) for p in range(6)], WATER)


def _resolve(spark, water, **kw):
    offs = offsets(
        spark,
        [
            # p0 missing; p1 stored 0; p2 below; p3 above; p4 valid; p5 history (last below second)
            ("g", "t", 1, 0, 1),
            ("g", "t", 2, 5, 1),
            ("g", "t", 3, 150, 1),
            ("g", "t", 4, 40, 1),
            ("g", "t", 5, 30, 1),
            ("g", "t", 5, 60, 2),
            ("g", "t", 5, 20, 3),
        ],
    )
    regs = acc.registrations(spark, [("g", "t", 50)])
    rows = acc.resolve_start(water, regs, offs, **kw).orderBy("partition").collect()
    return [(r["position"], r["status"]) for r in rows]


def test_reference_rule(spark, water):
    assert _resolve(spark, water) == [
        (100, "missing"),
        (100, "missing"),
        (10, "below"),
        (100, "above"),
        (40, "valid"),
        (20, "valid"),
    ]


def test_strict_zero_and_earliest_reset(spark, water):
    got = _resolve(spark, water, zero_is_missing=False, reset="earliest")
    assert got[0] == (10, "missing")
    assert got[1] == (10, "below")  # a real 0 is below the retained range


def test_negative_bounds_refused(spark):
    bad = spark.createDataFrame([("t", 0, -1, 5)], WATER)
    with pytest.raises(acc.UnstableSourceError):
        acc.check_bounds(bad)


def test_duplicate_registration_refused(spark):
    with pytest.raises(ValueError):
        acc.registrations(spark, [("g", "t", 10), ("g", "t", 20)])


def test_unknown_topic_refused(spark, water):
    with pytest.raises(ValueError):
        acc.require_topics(water, acc.registrations(spark, [("g", "nope")]))


def test_default_max_queue(spark):
    assert acc.registrations(spark, [("g", "t")]).collect()[0]["max_queue"] == 5000


def test_lag_levels(spark, water):
    regs = acc.registrations(spark, [("g", "t", 50)])
    pos = acc.positions_at(water, regs, F.lit(40))
    assert acc.lag_topic(pos).collect()[0]["lag"] == 6 * 60
    tot = acc.lag_total(pos).collect()[0]
    assert (tot["lag"], tot["topics"], tot["partitions"]) == (360, 1, 6)


def test_watermarks_exclusive_latest(spark, small):
    from loglake.sources.fixtures import fixture_log

    log = fixture_log(spark, small, "retained")
    w = acc.watermarks(log).collect()
    assert all(r["earliest"] == 10 for r in w)
    n = log.count()
    assert sum(r["latest"] - r["earliest"] for r in w) == n  # dense offsets


def test_custom_decoders(spark, small):
    import pandas as pd

    from loglake.functions.decode import decode_with, pandas_decoder
    from loglake.sources.fixtures import fixture_log

    log = fixture_log(spark, small, "events")

    def user_bucket(s: pd.Series) -> pd.Series:
        return s.map(lambda b: int(bytes(b).decode()) // 10)

    dec = pandas_decoder(user_bucket, "long")
    out = decode_with(log, "key", dec, out="bucket").select("key", "bucket").limit(50).collect()
    assert all(r["bucket"] == int(bytes(r["key"]).decode()) // 10 for r in out)
    up = decode_with(log, "value", lambda c: F.upper(c.cast("string")), out="upper").limit(5).collect()
    assert all(r["upper"].startswith('{"EVENT_ID"') for r in up)


def test_recorded_bounds_equal_scan_bounds(spark, small):
    from loglake.sources.fixtures import fixture_table

    for name in ("events", "retained", "gaps", "dup"):
        t = fixture_table(spark, small, name)
        assert sorted(acc.watermarks(t.read()).collect()) == sorted(t.bounds().collect()), name
        assert not t.bounds(["click"]).inputFiles()  # neither messages nor their footers


def test_footer_bounds_leave_the_session_alone(spark, small, tmp_path):
    import threading

    from loglake.sources.fixtures import fixture_log
    from loglake.sources.log import LogTable

    log = fixture_log(spark, small, "retained")
    path = str(tmp_path / "foreign")
    log.write.partitionBy("topic", "partition").parquet(path)  # another writer: no records
    keys = ("spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown")
    before, found = [spark.conf.get(k) for k in keys], []
    threads = [threading.Thread(target=lambda: found.append(sorted(LogTable(spark, path).bounds().collect()))) for _ in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert found == [sorted(acc.watermarks(log).collect())] * 4
    assert [spark.conf.get(k) for k in keys] == before
    plan = LogTable(spark, path).read().filter("offset < 5")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "BatchScan" not in plan
