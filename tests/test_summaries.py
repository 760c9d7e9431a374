"""Committed sink, id history, running summaries, payloads without a schema, positions of streams."""

import random

import pytest
from pyspark.sql import functions as F

from loglake.functions.variant import dead_letter, decode_variant, discovered, readable, shaped
from loglake.operators.history import IdHistory
from loglake.operators.summaries import store_summary, totals
from loglake.schema import LOG
from loglake.session import path_exists, scratch_path
from loglake.sources.committed_sink import committed_files, read_committed, start_committed, sweep, write_committed
from loglake.sources.log import write_log
from loglake.streaming.log_source import drain, stream_table
from loglake.streaming.progress import positions_of


def log_rows(spark, n, partitions=3):
    return spark.createDataFrame([("t" if i % 5 else "u", i % partitions, i, None, None, str(i).encode()) for i in range(n)], LOG)


def test_a_failed_task_leaves_nothing_that_counts(spark):
    root, df = scratch_path(spark, "sink"), log_rows(spark, 200).repartition(4)
    poison = F.when(F.col("offset") == 77, F.raise_error(F.lit("poison"))).otherwise(F.col("value"))
    with pytest.raises(Exception, match="poison"):
        write_committed(df.withColumn("value", poison), root)
    assert committed_files(spark, root).count() == 0 and read_committed(spark, root, LOG).count() == 0
    write_committed(df, root)
    write_committed(df.limit(0), root)
    got = read_committed(spark, root, LOG)
    assert got.exceptAll(df).count() == 0 and got.count() == 200
    about = committed_files(spark, root).groupBy("topic", "partition").agg(F.sum("rows").alias("n"), F.min("min_offset").alias("a"), F.max("max_offset").alias("z"))
    want = df.groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("n"), F.min("offset").alias("a"), F.max("offset").alias("z"))
    assert about.exceptAll(want).count() == 0 == want.exceptAll(about).count()
    before = committed_files(spark, root).count()
    sweep(spark, root, age_sec=-1)  # what the failed write left
    assert read_committed(spark, root, LOG).count() == 200 and committed_files(spark, root).count() == before


def test_rows_without_topics_and_nulls(spark):
    root = scratch_path(spark, "sink")
    df = spark.createDataFrame([(1, None), (2, "b"), (None, "c")], "a int, b string")
    write_committed(df, root)
    assert sorted(map(tuple, read_committed(spark, root, df.schema).collect()), key=str) == sorted([(1, None), (2, "b"), (None, "c")], key=str)
    keyed = spark.createDataFrame([(None, 1, 5), ("t", None, 6), ("t", 1, None)], "topic string, partition int, offset long")
    other = scratch_path(spark, "sink")
    write_committed(keyed, other)
    assert read_committed(spark, other, keyed.schema).count() == 3


def test_many_partitions_in_one_task(spark, monkeypatch):
    root = scratch_path(spark, "sink")
    df = spark.range(2000).select(F.lit("t").alias("topic"), (F.col("id") % 150).cast("int").alias("partition"), F.col("id").alias("offset")).coalesce(1)
    write_committed(df, root)
    got = read_committed(spark, root, df.schema)
    assert got.exceptAll(df).count() == 0 == df.exceptAll(got).count()


def test_replayed_stream_batch_counts_once(spark):
    path, root = scratch_path(spark, "log"), scratch_path(spark, "sink")
    write_log(log_rows(spark, 60).filter("topic = 't'").withColumn("offset", F.expr("offset div 1")), path)
    for _ in range(2):  # the second query runs the same batches again, from a new checkpoint under the same name
        ckpt = scratch_path(spark, "ckpt")
        drain(start_committed(stream_table(spark, path, {"t": 15}, ckpt), root, ckpt, name="one"))
    rows = read_committed(spark, root, LOG)
    assert rows.count() == rows.select("partition", "offset").distinct().count() == 48
    assert path_exists(spark, f"{root}/_committed/one-0.json")


def test_history_is_exact_whatever_the_hash_does(spark):
    """A space of one bucket: most bits are set, nearly every new id must be looked up, and the result is the same."""
    rng = random.Random(2)
    batches = [[(i, rng.choice([None, *range(6000)]), "t", 0) for i in range(b * 5000, b * 5000 + 3000)] for b in range(3)]
    for space in (32_768, 1 << 30):
        history, seen = IdHistory(spark, scratch_path(spark, "history"), space), set()
        for b, rows in enumerate(batches):
            df = spark.createDataFrame([(t, p, o, i) for o, i, t, p in rows], "topic string, partition int, offset long, id long")
            got = sorted(r["offset"] for r in history.new(df, "id").collect())
            want, now = [], set()
            for o, i, _, _ in rows:
                if i is None or i not in seen | now:
                    want.append(o)
                    now.add(i)
            assert got == want, (space, b)
            for _ in range(2):  # a batch that is run again changes nothing
                history.remember(df, "id", b)
            seen |= now - {None}
            history.compact(b)
    with pytest.raises(ValueError):
        IdHistory(spark, "x", 100)


def test_totals_of_batches(spark):
    root = scratch_path(spark, "summary")
    rows = [("a" if i % 3 else "b", f"user{i % 500}", i % 1000) for i in range(6000)]
    df = spark.createDataFrame(rows, "topic string, user string, k long")
    for b in range(4):
        part = df.filter(F.col("k") % 4 == b)
        for _ in range(2):
            store_summary(part, root, b, ["topic"], "user", "k")
    for r in totals(spark, root, ["topic"], [0.5]).collect():
        own = [x for x in rows if x[0] == r["topic"]]
        assert (r["batches"], r["n"], r["total"], r["most"]) == (4, len(own), sum(k for *_, k in own), max(k for *_, k in own))
        assert abs(r["distinct_ids"] - len({u for _, u, _ in own})) <= 30 and abs(r["quantiles"][0] - 500) < 40
    assert totals(spark, root, ["topic"], [0.5], upto=1).agg(F.sum("n")).first()[0] == sum(k % 4 < 2 for *_, k in rows)


def test_payloads_without_a_schema(spark):
    values = [b'{"a": 1, "b": {"c": "x"}}', b'{"a": 2.5}', b"[1, 2]", b"null", None, b"", b"{broken", b"\xff\xfe", b'"text"']
    log = spark.createDataFrame([("t", 0, i, None, None, v) for i, v in enumerate(values)], LOG)
    decoded = decode_variant(log)
    assert sorted(r["offset"] for r in readable(decoded).collect()) == [0, 1, 2, 3, 4, 8]
    assert {r["offset"]: (bytes(r["value"]), r["reason"]) for r in dead_letter(decoded).collect()} == {5: (b"", "not JSON"), 6: (b"{broken", "not JSON"), 7: (b"\xff\xfe", "not UTF-8")}
    rows = {r["offset"]: r for r in shaped(readable(decoded), {"a": ("$.a", "double"), "c": ("$.b.c", "string"), "n": ("$.b.c", "int")}).collect()}
    assert [rows[i]["a"] for i in (0, 1, 2)] == [1.0, 2.5, None] and rows[0]["c"] == "x" and rows[0]["n"] is None
    objects = decode_variant(log.filter("offset < 2"))
    assert "a: D" in discovered(objects).first()[0] and "c: STRING" in discovered(objects).first()[0]
    assert discovered(decode_variant(log.limit(0))).first()[0] in (None, "VOID")


def test_positions_of_progress():
    assert positions_of('{"t": {"0": 5, "2": 0}}') == [("t", 0, 5), ("t", 2, 0)]
    assert positions_of(None) == [] == positions_of('{"logOffset": 3}') == positions_of("7")
