"""Test logs and offset histories derived by Spark from the given tables
(``events``, ``orders``). Definitions follow FIXTURES.md; each fixture log is
written once per session to the shared scratch folder and read back, so the
queries run against a real partitioned Parquet log (directory pruning and
pushed offset filters), as they would in production.
"""

from __future__ import annotations

import hashlib
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglake.operators.accounting import watermarks
from loglake.operators.sizing import broadcast_if_small
from loglake.schema import LOG_COLUMNS, OFFSETS_COLUMNS, PARTITION_KEY
from loglake.session import scratch_path
from loglake.sources.log import LogTable, append_records, to_log, write_log

# Fixed values of the fixture definitions.
EVENT_PARTITIONS = 4
ORDER_PARTITIONS = 3
RETAINED_FROM = 10
DUP_EVERY = 7
GAP_EVERY = 5
SKEW_TOPIC = "hot"
SKEW_SINGLE_IDS = (1, 2, 3)  # event ids placed alone in partitions 1, 2, 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def event_value():
    return F.concat(
        F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(', "props": '), F.col("props"), F.lit("}")
    )


def build_events_log(events: DataFrame) -> DataFrame:
    return to_log(
        events,
        topic="event_type",
        partition=(F.col("user_id") % EVENT_PARTITIONS),
        order_by=["ts", "event_id"],
        key=F.col("user_id").cast("string"),
        value=event_value(),
        timestamp="ts",
    )


def build_orders_log(orders: DataFrame) -> DataFrame:
    return to_log(
        orders,
        topic=F.lit("orders"),
        partition=(F.col("o_custkey") % ORDER_PARTITIONS),
        order_by=["o_orderdate", "o_orderkey"],
        key=F.col("o_custkey").cast("string"),
        value=F.col("o_orderkey").cast("string"),
        timestamp="o_orderdate",
    )


def build_skew_log(events: DataFrame) -> DataFrame:
    part = F.when(F.col("event_id").isin(*SKEW_SINGLE_IDS), F.col("event_id")).otherwise(F.lit(0))
    return to_log(
        events,
        topic=F.lit(SKEW_TOPIC),
        partition=part,
        order_by=["ts", "event_id"],
        key=F.col("user_id").cast("string"),
        value=event_value(),
        timestamp="ts",
    )


def retained(log: DataFrame, earliest: int = RETAINED_FROM) -> DataFrame:
    return log.filter(F.col("offset") >= earliest)


def gaps(log: DataFrame) -> DataFrame:
    """Drop offsets divisible by 5, except the last offset of each partition."""
    last = broadcast_if_small(watermarks(log).select(*PARTITION_KEY, "latest"))
    return (
        log.join(last, PARTITION_KEY)
        .filter((F.col("offset") % GAP_EVERY != 0) | (F.col("offset") == F.col("latest") - 1))
        .select(*LOG_COLUMNS)
    )


def event_id_of(value_col: str = "value"):
    return F.get_json_object(F.col(value_col).cast("string"), "$.event_id").cast("bigint")


def duplicated(log: DataFrame) -> DataFrame:
    """The log plus a copy of every message whose event id is divisible by 7,
    appended after the end of its partition in original offset order."""
    copies = log.filter(event_id_of() % DUP_EVERY == 0)
    appended = append_records(log, copies, order_by=["offset"])
    return log.unionByName(appended)


# --- materialisation ----------------------------------------------------------

_BUILDERS = {
    "events": lambda s, d: build_events_log(table(s, d, "events")),
    "orders": lambda s, d: build_orders_log(table(s, d, "orders")),
    "skew": lambda s, d: build_skew_log(table(s, d, "events")),
    "retained": lambda s, d: retained(fixture_log(s, d, "events")),
    "gaps": lambda s, d: gaps(fixture_log(s, d, "events")),
    "dup": lambda s, d: duplicated(fixture_log(s, d, "events")),
}
_LOCK = threading.RLock()


def fixture_path(spark: SparkSession, sf_dir: str, name: str) -> str:
    tag = hashlib.sha1(sf_dir.rstrip("/").encode()).hexdigest()[:10]
    return scratch_path(spark, "fixtures", spark.sparkContext.applicationId, tag, name, fresh=False)


def fixture_table(spark: SparkSession, sf_dir: str, name: str) -> LogTable:
    """Fixture log ``name`` (events, orders, skew, retained, gaps, dup) as a
    Parquet log table, written on first use in this application."""
    path = fixture_path(spark, sf_dir, name)
    with _LOCK:
        if not LogTable(spark, path).exists():
            write_log(_BUILDERS[name](spark, sf_dir), path)
    return LogTable(spark, path)


def fixture_log(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return fixture_table(spark, sf_dir, name).read()


# --- offset histories (OFFSETS rows derived from a log's bounds) ---------------


def _offsets(water: DataFrame, group: str, committed, seq, keep=None) -> DataFrame:
    df = water if keep is None else water.filter(keep)
    return df.select(
        F.lit(group).alias("group_id"),
        "topic",
        "partition",
        committed.cast("bigint").alias("committed"),
        F.lit(seq).cast("bigint").alias("commit_seq"),
        F.timestamp_seconds(F.lit(1706745600 + 60 * seq)).alias("committed_at"),
    ).select(*OFFSETS_COLUMNS)


def offsets_g1(water: DataFrame, group: str = "g1") -> DataFrame:
    """Partition 0 missing; 1 at 5 (below); 2 at latest + 100 (above);
    3 at the middle of the retained range (valid)."""
    p = F.col("partition")
    committed = (
        F.when(p == 1, F.lit(5))
        .when(p == 2, F.col("latest") + 100)
        .otherwise(F.col("earliest") + F.expr("(latest - earliest) div 2"))
    )
    return _offsets(water, group, committed, 1, keep=p != 0)


def offsets_g0(water: DataFrame, group: str = "g0") -> DataFrame:
    """Every partition stored as 0 (read as 'missing' by the reference)."""
    return _offsets(water, group, F.lit(0), 1)


def offsets_history(water: DataFrame, group: str = "gh") -> DataFrame:
    """Three commits per partition; the last is below the second."""
    d = F.expr("(latest - earliest) div 4")
    e = F.col("earliest")
    return (
        _offsets(water, group, e + 2 * d, 1)
        .unionByName(_offsets(water, group, e + 3 * d, 2))
        .unionByName(_offsets(water, group, e + d, 3))
    )
