"""Driver contract: entry runs; every query has an oracle; a sample matches at sf0.001."""

import os
import sys

import duckdb

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import _rows  # noqa: E402


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["topic", "partition", "offset", "key", "value"]
    assert df.count() > 0


def test_every_query_has_oracle():
    from loglake.queries import QUERIES

    assert set(QUERIES) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_sample_matches_oracle(spark, small):
    con = duckdb.connect()
    for t in ("events", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small}/{t}.parquet')")
    for name in ("fetch_topic", "resolve_start", "drain_topic", "plan_skew", "dedup_batch", "commit_offsets"):
        df = E.queries()[name](spark, small)
        cur = con.execute(E.oracle_sql()[name])
        dcols = [d[0] for d in cur.description]
        assert sorted(df.columns) == sorted(dcols), name
        assert _rows(df.columns, df.collect()) == _rows(dcols, cur.fetchall()), name
