"""Distributed offset numbering equals row_number() per group."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from loglake.operators.numbering import number_within


def _expected(df, group, order):
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("expected", F.row_number().over(w) - 1)


def test_matches_row_number(spark, medium):
    ev = spark.read.parquet(f"{medium}/events.parquet").withColumn("p", F.col("user_id") % 4)
    got = number_within(ev, ["event_type", "p"], ["ts", "event_id"], out="n")
    both = got.join(_expected(ev, ["event_type", "p"], ["ts", "event_id"]).select("event_id", "expected"), "event_id")
    assert both.count() == ev.count()
    assert both.filter(F.col("n") != F.col("expected")).count() == 0


def test_hot_group_is_split_across_tasks(spark, medium):
    """One group holding every row is still numbered densely, by many tasks."""
    ev = spark.read.parquet(f"{medium}/events.parquet").withColumn("g", F.lit("hot"))
    got = number_within(ev, ["g"], ["ts", "event_id"], out="n", num_partitions=7)
    exp = _expected(ev, ["g"], ["ts", "event_id"]).select("event_id", "expected")
    assert got.join(exp, "event_id").filter(F.col("n") != F.col("expected")).count() == 0
    tasks = spark.read.parquet(f"{medium}/events.parquet").repartitionByRange(7, "ts", "event_id")
    assert tasks.rdd.getNumPartitions() == 7


def test_base_and_shuffled_input(spark, medium):
    """Input produced by a shuffle (non-deterministic row order) plus a base."""
    ev = spark.read.parquet(f"{medium}/events.parquet")
    agg = ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("c"), F.max("ts").alias("ts"))
    agg = agg.withColumn("g", F.col("user_id") % 3).withColumn("b", F.lit(100))
    got = number_within(agg, ["g"], ["ts", "user_id"], out="n", base="b")
    exp = _expected(agg, ["g"], ["ts", "user_id"]).select("user_id", "expected")
    bad = got.join(exp, "user_id").filter(F.col("n") != F.col("expected") + 100)
    assert bad.count() == 0
    assert got.count() == agg.count()


def test_empty_and_tiny_inputs(spark, small):
    ev = spark.read.parquet(f"{small}/events.parquet")
    empty = number_within(ev.filter(F.lit(False)), ["event_type"], ["event_id"], out="n")
    assert empty.count() == 0 and "n" in empty.columns
    one = number_within(ev.filter(F.col("event_id") == 5), ["event_type"], ["event_id"], out="n", num_partitions=16)
    assert [r["n"] for r in one.collect()] == [0]
    few = number_within(ev.filter(F.col("event_id") < 10), ["event_type"], ["event_id"], out="n", num_partitions=32)
    exp = _expected(ev.filter(F.col("event_id") < 10), ["event_type"], ["event_id"]).select("event_id", "expected")
    assert few.join(exp, "event_id").filter(F.col("n") != F.col("expected")).count() == 0
