import math
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loglake.llm import whitening
from loglake.llm.whitening import bidiagonal, directions, dqds, fitted, op13_bidiagonal_whitening, triangle, vector_sums, whiten


def squares(r):
    return np.linalg.svd(r, compute_uv=False) ** 2


def padded(x):
    x = x - x.mean(axis=0)
    r, d = np.linalg.qr(x, mode="r"), x.shape[1]
    return np.concatenate((r, np.zeros((d - len(r), d)))) if len(r) < d else r


def checked(x, most=8):
    r = padded(x)
    vectors, values, explained = directions(r, len(x), most)
    want = squares(r)
    assert np.allclose(values * len(x), want[: len(values)], rtol=1e-10)
    assert np.abs(vectors @ vectors.T - np.eye(len(vectors))).max(initial=0.0) < 1e-10
    assert np.abs(vectors @ r.T @ r - (values * len(x))[:, None] * vectors).max(initial=0.0) <= 1e-11 * want[0] + 1e-300
    return vectors, values


def test_bidiagonal_keeps_the_singular_values():
    r = np.random.default_rng(0).standard_normal((30, 30))
    a, b, v = bidiagonal(r)
    made = np.diag(a) + np.diag(b, 1)
    assert np.allclose(made.T @ made, v.T @ r.T @ r @ v, atol=1e-12) and np.allclose(v.T @ v, np.eye(30))


def test_small_singular_values_are_accurate():
    a, b = 10.0 ** -np.arange(0.0, 12.0), 10.0 ** -np.arange(0.5, 11.5)
    got = dqds(a, b)
    # the product of all squares is that of the diagonal's: no small one is lost
    assert math.isclose(math.prod(got), math.prod(a**2), rel_tol=1e-12)


@pytest.mark.parametrize("name", ["plain", "copies", "rank", "tied", "graded", "close", "few", "constant"])
def test_directions(name):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((400, 24))
    basis = np.linalg.qr(x - x.mean(axis=0))[0]
    basis -= basis.mean(axis=0)
    turn = np.linalg.qr(rng.standard_normal((24, 24)))[0]
    tables = {
        "plain": x,
        "copies": np.repeat(x[:10], 7, axis=0),
        "rank": x[:, :3] @ rng.standard_normal((3, 24)),
        "tied": np.concatenate((np.eye(24), -np.eye(24))),
        "graded": x * 10.0 ** (-np.arange(24) / 4),
        "close": basis @ np.diag(np.r_[np.full(6, 5.0) * (1 + 1e-9 * np.arange(6)), np.ones(18)]) @ turn,
        "few": x[:4],
        "constant": np.where(np.arange(24) % 2 == 0, x, 7.0),
    }
    vectors, _ = checked(tables[name])
    assert len(vectors) == {"rank": 3, "few": 3}.get(name, 8)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 7).flatmap(lambda d: st.lists(st.lists(st.integers(-3, 3), min_size=d, max_size=d), min_size=1, max_size=12)))
def test_small_integer_tables(rows):
    checked(np.array(rows, float))


def brute(rows):
    """Exact deviations and numpy's eigenvectors."""
    x = np.array([[math.floor(1024 * float(c)) + 100_000 for c in v] for _, v in rows], object)
    n, s = len(x), x.sum(axis=0)
    t = n * x - s
    centred = np.array([[float(Fraction(int(c), n)) for c in r] for r in t])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return n, (t**2).sum(axis=1), centred, values[::-1], vectors[:, ::-1]


def test_query_equals_numpy(spark, small):
    rows = [(r["vec_id"], np.float32(r["embedding"])) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    n, deviation, centred, values, vectors = brute(rows)
    got = {(r["vec_id"], r["component"]): r for r in op13_bidiagonal_whitening(spark, small).collect()}
    assert len(got) == 8 * n and len({r["identity_error"] for r in got.values()}) == 1
    assert next(iter(got.values()))["identity_error"] < 1e-10
    for c in range(8):
        want = centred @ vectors[:, c] / math.sqrt(values[c])
        have = np.array([got[(i, c + 1)]["whitened"] for i, _ in rows])
        have *= np.sign(have @ want)
        assert np.abs(have - want).max() < 1e-9
        assert all(got[(i, c + 1)]["deviation"] == d and got[(i, c + 1)]["n"] == n for (i, _), d in zip(rows, deviation))
        assert all(math.isclose(got[(i, c + 1)]["explained"], values[c] / values.sum(), rel_tol=1e-10) for i, _ in rows[:20])


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<float>, n string, whitened string")


def test_odd_vectors(spark):
    rng = np.random.default_rng(1)
    good = [(i, [float(np.float32(v)) for v in rng.standard_normal(5)]) for i in range(30)]
    good += [good[0], good[0], (None, good[1][1])]
    bad = [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0]), (102, [math.nan] * 5), (103, [math.inf, 0.0, 0.0, 0.0, 0.0])]
    df = table(spark, good + bad)
    w = fitted(df)
    out = whiten(df, w).collect()
    assert len(out) == len(good) and w.n == len(good) and len(w.values) == 5
    n, deviation, _, values, _ = brute(good)
    assert sorted(r["deviation"] for r in out) == sorted(deviation) and np.allclose(w.values, values)
    assert all(r["deviation_exact"] == r["deviation"] and r["identity_error"] < 1e-9 for r in out)
    assert sum(r["vec_id"] is None for r in out) == 1


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]])
def test_tables_without_components(spark, rows):
    df = table(spark, rows)
    out = whiten(df, fitted(df)).collect()
    assert len(out) == sum(v is not None for _, v in rows)
    assert all(r["whitened"] == [] and r["identity_error"] is None and r["deviation"] == 0 for r in out)


def test_lengths_and_range(spark):
    with pytest.raises(Exception, match="different lengths"):
        fitted(table(spark, [(1, [1.0]), (2, [1.0, 2.0])]).repartition(1))
    with pytest.raises(Exception, match="beyond"):
        fitted(table(spark, [(1, [1e30])]))


def test_deviation_beyond_long():
    exact, whole = whitening._deviations(np.array([[2**40, 0], [3, 4]]))
    assert exact.to_pylist() == [None, 25] and [int(x) for x in whole.to_pylist()] == [2**80, 25]


def test_triangles_meet_in_levels(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    rng = np.random.default_rng(2)
    df = table(spark, [(i, [float(v) for v in rng.standard_normal(4)]) for i in range(300)]).repartition(9)
    n, sums = vector_sums(df, "embedding")
    r = triangle(df, "embedding", n, sums)
    x = np.array([[math.floor(1024 * v) + 100_000 for v in row["embedding"]] for row in df.collect()], float)
    c = x - x.mean(axis=0)
    assert np.allclose(r.T @ r, c.T @ c, rtol=1e-9)
