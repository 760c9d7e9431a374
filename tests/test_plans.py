"""Throttle rules and drain closed forms against a step-by-step model."""

import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglake.plans.drain import full_round
from loglake.plans.throttle import per_each, plan_group, plan_partition, plan_proportional, plan_topic

SCHEMA = T.StructType(
    [
        T.StructField("group_id", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("max_queue", T.IntegerType()),
        T.StructField("earliest", T.LongType()),
        T.StructField("latest", T.LongType()),
        T.StructField("stored", T.LongType()),
        T.StructField("position", T.LongType()),
        T.StructField("status", T.StringType()),
    ]
)


def positions(spark, cases):
    """cases: {group: (max_queue, [(position, latest), ...])} -> positions DF."""
    rows = []
    for g, (mq, parts) in cases.items():
        for p, (pos, latest) in enumerate(parts):
            rows.append((g, "t", p, mq, 0, latest, None, pos, "set"))
    return spark.createDataFrame(rows, SCHEMA)


def stops(df):
    return {(r["group_id"], r["partition"]): r["stop_offset"] for r in df.collect()}


# --- python models of one round ------------------------------------------------


def model_topic(mq, parts):
    lag = sum(l - p for p, l in parts)
    each = max(1, mq // len(parts))
    if lag > mq:
        return [min(p + each, l) for p, l in parts]
    return [l for _, l in parts]


def model_group(mq, parts):
    each = max(1, mq // len(parts))
    return [min(p + each, l) for p, l in parts]


def model_partition(mq, p, l):
    if l - p > mq:
        return min(p + max(1, mq), l)
    return l


def test_reference_example_rules_differ(spark):
    """P = 4, max_queue = 1000, lags (900, 0, 0, 0): topic rule takes all 900
    at once, group rule 250 per round."""
    df = positions(spark, {"g": (1000, [(0, 900), (0, 0), (0, 0), (0, 0)])})
    assert stops(plan_topic(df))[("g", 0)] == 900
    assert stops(plan_group(df))[("g", 0)] == 250


def test_per_each_is_at_least_one(spark):
    df = positions(spark, {"g": (2, [(0, 10), (0, 10), (0, 10), (0, 10)])})
    pe = per_each(df).select("per_each").distinct().collect()
    assert [r[0] for r in pe] == [1]
    assert set(stops(plan_topic(df)).values()) == {1}


def test_rules_match_model_random(spark):
    rng = random.Random(7)
    cases = {}
    for i in range(200):
        n = rng.randint(1, 6)
        mq = rng.choice([1, 2, 3, 5, 10, 50, 200, 1000])
        parts = []
        for _ in range(n):
            latest = rng.randint(0, 400)
            parts.append((rng.randint(0, latest), latest))
        cases[f"c{i}"] = (mq, parts)
    df = positions(spark, cases).persist()
    got_t, got_g, got_p = stops(plan_topic(df)), stops(plan_group(df)), stops(plan_partition(df))
    for g, (mq, parts) in cases.items():
        for p, s in enumerate(model_topic(mq, parts)):
            assert got_t[(g, p)] == s, (g, mq, parts)
        lagging = sum(l - q for q, l in parts) > 0
        for p, s in enumerate(model_group(mq, parts)):
            if lagging:
                assert got_g[(g, p)] == s
            else:
                assert (g, p) not in got_g
        for p, (q, l) in enumerate(parts):
            assert got_p[(g, p)] == model_partition(mq, q, l)


def test_proportional_never_exceeds_latest(spark):
    df = positions(spark, {"g": (100, [(0, 1000), (0, 10), (0, 0)])})
    s = stops(plan_proportional(df))
    assert s[("g", 0)] == 99 and s[("g", 1)] == 1 and s[("g", 2)] == 0


def test_full_round_matches_iteration(spark):
    """K from the closed form equals the round found by iterating the rule."""
    rng = random.Random(11)
    cases = {}
    for i in range(300):
        n = rng.randint(1, 6)
        mq = rng.choice([1, 3, 7, 20, 100, 500])
        parts = [(0, rng.choice([0, rng.randint(0, 50), rng.randint(0, 3000)])) for _ in range(n)]
        cases[f"c{i}"] = (mq, parts)
    got = {r["group_id"]: r["full_round"] for r in full_round(per_each(positions(spark, cases))).collect()}
    for g, (mq, parts) in cases.items():
        pos = [p for p, _ in parts]
        lat = [l for _, l in parts]
        k = 0
        while True:
            lag = sum(l - p for p, l in zip(pos, lat))
            if lag <= mq:
                break
            pos = model_topic(mq, list(zip(pos, lat)))
            k += 1
        assert got[g] == k, (g, mq, parts)


def test_negative_lag_never_plans_backwards(spark):
    df = positions(spark, {"g": (10, [(50, 40), (0, 100)])})
    for plan in (plan_topic(df), plan_group(df), plan_partition(df)):
        for r in plan.collect():
            assert r["stop_offset"] >= r["start_offset"]
