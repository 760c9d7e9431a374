import math
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loglake.llm import ball_tree
from loglake.llm.ball_tree import OP12_SQL, BallTree, op12_ball_tree_search, ranked_search, term_lists

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    counts = [Counter(terms(t)) for _, t in docs]
    n_docs, size = sum(1 for c in counts if c), sum(sum(c.values()) for c in counts)
    df = Counter(t for c in counts for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = {}
    for i, want in asked.items():
        scores = []
        for (doc, _), c in zip(docs, counts):
            m = 10 + 90 * sum(c.values()) * n_docs // max(size, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in want if c[t])
            if s > 0:
                scores.append((-s, doc is None, doc or 0))
        out[i] = [(r + 1, None if null else doc, -s) for r, (s, null, doc) in enumerate(sorted(scores)[:k])]
    return {i: rows for i, rows in out.items() if rows}


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["item_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    return {i: sorted(rows) for i, rows in out.items()}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=20), max_size=5))
def test_terms(texts):
    starts, got = term_lists(pa.array(texts, pa.large_string()))
    got = got.to_pylist()
    assert [got[a:z] for a, z in zip(starts, starts[1:])] == [terms(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000))
def test_tree_finds_what_a_full_scan_finds(seed):
    rng = np.random.default_rng(seed)
    n, v = int(rng.integers(1, 300)), int(rng.integers(1, 40))
    rows = [np.sort(rng.choice(v, int(rng.integers(1, v + 1)), replace=False)) for _ in range(n)]
    rows += rows[: n // 3]
    at = np.concatenate(([0], np.cumsum([len(r) for r in rows])))
    dims = np.concatenate(rows)
    values = rng.integers(1, 1_000_000, len(dims))
    values[at[n] :] = values[: at[len(rows)] - at[n]]  # copies
    weights = rng.integers(0, 9000, v)
    queries = [np.sort(rng.choice(v, int(rng.integers(1, v + 1)), replace=False)) for _ in range(5)]
    tree = BallTree(at, dims, values, weights, queries, leaf=4)
    for j, q in enumerate(queries):
        asked = np.zeros(v, np.int64)
        asked[q] = weights[q]
        scores = np.add.reduceat(asked[dims] * values, at[:-1])
        for node, (a, z) in enumerate(tree.span):
            assert tree.bounds[node, j] >= scores[tree.order[a:z]].max()
        best = []
        tree.search(j, asked, list(range(len(rows))), best)
        want = sorted(((int(s), -i) for i, s in enumerate(scores) if s > 0), reverse=True)[:10]
        assert sorted(best, reverse=True) == want


def test_bounds_prune():
    rng = np.random.default_rng(1)
    rows = [np.sort(rng.choice(np.arange(t * 20, t * 20 + 20), 8, replace=False)) for t in rng.integers(0, 50, 4000)]
    at, dims = np.concatenate(([0], np.cumsum([len(r) for r in rows]))), np.concatenate(rows)
    values, weights = rng.integers(1, 1_000_000, len(dims)), np.full(1000, 5000)
    tree = BallTree(at, dims, values, weights, [rows[0]])
    asked = np.zeros(1000, np.int64)
    asked[rows[0]] = 5000
    leaves = tree.search(0, asked, list(range(len(rows))), [])
    assert leaves * 5 < sum(c is None for c in tree.children)


def test_query_equals_brute_force_and_sql(spark, small, texts):
    got = found(op12_ball_tree_search(spark, small))
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    assert got == brute(texts, items)
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small}/{t}.parquet')")
    assert sorted(con.execute(OP12_SQL).fetchall()) == sorted((i, *r) for i, rows in got.items() for r in rows)


@pytest.mark.parametrize("tree_docs", [3, 16_384])
def test_many_trees_and_partitions(spark, small, texts, tree_docs):
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(7)
    items = spark.read.parquet(f"{small}/benchmark.parquet")
    got = found(ranked_search(docs, items, tree_docs=tree_docs, leaf=2))
    assert got == brute(texts, [(r["item_id"], r["text"]) for r in items.collect()])


def test_items_in_turns(spark, small, texts, monkeypatch):
    monkeypatch.setattr(ball_tree, "ITEM_BYTES", 2000)
    items = spark.read.parquet(f"{small}/benchmark.parquet")
    got = found(ranked_search(spark.createDataFrame(texts, "doc_id long, text string"), items))
    assert got == brute(texts, [(r["item_id"], r["text"]) for r in items.collect()])


def test_odd_tables(spark, odd, none):
    items = [(1, "One two, THREE"), (1, "eleven"), (2, None), (3, ""), (None, "alpha words"), (4, "漢字 é́"), (5, "nowhere"), (6, "zeta " * 5000)]
    table = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, rank string")
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = found(ranked_search(odd, table))
    assert got == brute(docs, items) and set(got) == {1, None, 4, 6}
    assert ranked_search(none, table).count() == 0
    assert ranked_search(odd, table.limit(0)).count() == 0
    assert ranked_search(odd, table.where("item_id in (2, 3)")).count() == 0
