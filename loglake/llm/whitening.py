"""Whitening of vectors through the singular values of a bidiagonal matrix.

1. Exact sums: each entry c becomes the integer x = floor(1024 c) + 100000, of which Spark sums every dimension.
2. Blockwise QR: a task reduces its centred rows, block by block, to one triangle; triangles meet in a tree of tasks,
   written after each level, until a few are left. Neither rows nor a covariance matrix are multiplied out.
3. On the driver, for a triangle of dimensions x dimensions: Householder reflections make it bidiagonal, ``dqds`` (the
   differential quotient-difference algorithm with shifts) finds its singular values to high relative accuracy, and
   twisted factorisations give the right singular vectors, from the top and from the bottom to the row where they fit
   best. Vectors of values that lie close together are made orthogonal.
4. Every row is projected on the leading vectors and scaled; the covariance of the result is summed and compared with 1.

Rows whose vector is null, or holds a null, a NaN or an infinity, are left out. All other vectors must have one length,
and entries below 2**40 (a ValueError otherwise). There are as many components as asked for, or as the rank allows: equal
rows, or a single one, give no component, as does an empty table (the columns ``whitened`` and ``explained`` are then
empty lists). Repeated rows count as often as they occur; ties between eigenvalues give some orthogonal basis; a null id
stays. Extra columns stay, but for those with the names of new ones.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DecimalType, DoubleType, LongType, StructType

from loglake.llm.scratch import written
from loglake.llm.text import kept_fields

SCALE, SHIFT = 1024, 100_000
MOST = 2.0**40  # of an entry
BLOCK_ROWS = 4096
FAN_IN, FAN_BYTES = 64, 64 << 20  # triangles that one task joins
EPS = np.finfo(float).eps


def grid(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(indexes of the rows that stay, their integers x by row and dimension)."""
    lists = column.cast(pa.large_list(pa.float64()))
    size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    there = pc.is_valid(lists).to_numpy(zero_copy_only=False)
    entries = pc.fill_null(lists.flatten(), math.nan).to_numpy(zero_copy_only=False)
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(entries))))
    at = np.concatenate(([0], np.cumsum(size)))
    rows = np.flatnonzero(there & (bad[at[1:]] == bad[at[:-1]]))
    if not len(rows):
        return rows, np.zeros((0, 0), np.int64)
    dims = size[rows]
    if (dims != dims[0]).any():
        raise ValueError(f"vectors of different lengths: {sorted(set(dims.tolist()))[:5]}")
    x = entries[at[rows][:, None] + np.arange(dims[0])]
    if len(x) and dims[0] and np.abs(x).max() >= MOST:
        raise ValueError("an entry of a vector is beyond 2**40")
    return rows, np.floor(SCALE * x).astype(np.int64) + SHIFT


def vector_sums(df: DataFrame, vec_col: str) -> tuple[int, np.ndarray]:
    """(number of vectors, exact sum of x for each dimension); the driver gets one row for each dimension."""
    out = StructType().add("dims", LongType()).add("n", LongType()).add("sums", ArrayType(LongType()))

    def run(batches):
        n, total = 0, None
        for b in batches:
            _, x = grid(b.column(0))
            if len(x):
                if total is not None and len(total) != x.shape[1]:
                    raise ValueError(f"vectors of different lengths: {sorted({len(total), x.shape[1]})}")
                n, total = n + len(x), x.sum(axis=0) + (0 if total is None else total)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([len(total)], pa.int64()), pa.array([n], pa.int64()), pa.array([total.tolist()], pa.list_(pa.int64()))], names=out.fieldNames())

    parts = df.select(vec_col).mapInArrow(run, out)
    rows = parts.select("dims", "n", F.posexplode_outer("sums").alias("dim", "sum")).groupBy("dims", "dim").agg(F.sum("n").alias("n"), F.sum("sum").alias("sum")).collect()
    if len({r["dims"] for r in rows}) > 1:
        raise ValueError(f"vectors of different lengths: {sorted({r['dims'] for r in rows})[:5]}")
    if not rows or rows[0]["dims"] == 0:
        return (int(rows[0]["n"]) if rows else 0), np.zeros(0, np.int64)
    rows.sort(key=lambda r: r["dim"])
    return int(rows[0]["n"]), np.array([int(r["sum"]) for r in rows], np.int64)


def triangle(df: DataFrame, vec_col: str, n: int, sums: np.ndarray) -> np.ndarray:
    """The triangle R of the centred rows: R'R is n times their covariance."""
    d = len(sums)
    out = StructType().add("r", BinaryType())

    def joined(r: np.ndarray, rows: np.ndarray) -> np.ndarray:
        for a in range(0, len(rows), BLOCK_ROWS):
            r = np.linalg.qr(np.concatenate((r, rows[a : a + BLOCK_ROWS])), mode="r")
        return r

    def reduce_rows(batches):
        r = np.zeros((0, d))
        for b in batches:
            _, x = grid(b.column(0))
            if len(x):
                r = joined(r, (n * x - sums) / n)
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary())], names=["r"])

    def reduce_triangles(batches):
        r = np.zeros((0, d))
        for b in batches:
            for blob in b.column(0):
                r = joined(r, np.frombuffer(blob.as_buffer()).reshape(-1, d))
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary())], names=["r"])

    fan = max(2, min(FAN_IN, FAN_BYTES // (8 * d * d)))
    level = written(df.select(vec_col).mapInArrow(reduce_rows, out), "triangles")
    count = level.count()
    while count > fan:
        level = written(level.repartition(-(-count // fan)).mapInArrow(reduce_triangles, out), "triangles")
        count = level.count()
    r = np.zeros((0, d))
    for row in level.collect():  # at most ``fan`` triangles
        r = joined(r, np.frombuffer(row["r"]).reshape(-1, d))
    return np.concatenate((r, np.zeros((d - len(r), d)))) if len(r) < d else r


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V): reflections from the left and from the right make ``r`` bidiagonal, B = U' r V."""
    b, d = r.astype(float).copy(), len(r)
    v = np.eye(d)

    def mirror(x: np.ndarray) -> tuple[np.ndarray, float]:
        top = np.abs(x).max(initial=0.0)
        w = x.copy()
        if top == 0.0 or not np.abs(x[1:]).max(initial=0.0):
            return w, 0.0
        w[0] += math.copysign(top * math.sqrt(((x / top) ** 2).sum()), x[0])
        w /= np.abs(w).max()
        return w, 2.0 / float(w @ w)

    for k in range(d):
        w, beta = mirror(b[k:, k])
        if beta:
            b[k:, k:] -= beta * np.outer(w, w @ b[k:, k:])
        if k + 2 < d:
            w, beta = mirror(b[k, k + 1 :])
            if beta:
                b[k:, k + 1 :] -= beta * np.outer(b[k:, k + 1 :] @ w, w)
                v[:, k + 1 :] -= beta * np.outer(v[:, k + 1 :] @ w, w)
    return np.diag(b).copy(), np.diag(b, 1).copy(), v


def _qd_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One differential step with a shift; None if the shift is beyond the least value."""
    qq, ee, d = [], [], q[0] - shift
    for i, x in enumerate(e):
        if d < 0:
            return None
        top = d + x
        if top == 0.0:
            qq.append(0.0)
            ee.append(0.0)
            d = q[i + 1] - shift
            continue
        t = q[i + 1] / top
        qq.append(top)
        ee.append(x * t)
        d = d * t - shift
    if d < 0:
        return None
    return [*qq, d], ee


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squares of the singular values of a bidiagonal matrix, falling."""
    scale = max(np.abs(diagonal).max(initial=0.0), np.abs(above).max(initial=0.0))
    if scale == 0.0:
        return np.zeros(len(diagonal))
    found: list[float] = []
    work = [([float(x) for x in (diagonal / scale) ** 2], [float(x) for x in (above / scale) ** 2], 0.0, 0.0)]
    tol = EPS * EPS / 4
    while work:
        q, e, total, rest = work.pop()  # values of the block are total + rest beyond those of (q, e)
        if len(q) == 1:
            found.append(total + (rest + q[0]))
            continue
        cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= tol * (total + min(q[i], q[i + 1])) or e[i] < 1e-300), None)
        if cut is not None:
            work += [(q[: cut + 1], e[:cut], total, rest), (q[cut + 1 :], e[cut + 1 :], total, rest)]
            continue
        if q[0] < q[-1]:  # values grow towards the bottom: the transposed matrix, read from there, has the same ones
            q, e = q[::-1], e[::-1]
        # the least value of the last two rows bounds the least of all from above
        a, c, b2 = q[-2], q[-1] + e[-1], q[-2] * e[-1]
        half = (a + c) / 2
        shift = max(0.0, (a * c - b2) / (half + math.sqrt(max(0.0, half * half - (a * c - b2)))))
        got = None
        for part in (1.0 - 1e-12, 0.9, 0.5, 0.1):
            got = _qd_step(q, e, shift * part)
            if got is not None:
                shift *= part
                break
        if got is None:
            shift, got = 0.0, _qd_step(q, e, 0.0)
        new = total + shift  # summed with the rounding error kept
        rest += (total - new) + shift
        work.append((*got, new, rest))
    return np.sort(np.array(found))[::-1] * scale * scale


class _Twisted:
    """T - value for T = B'B of one bidiagonal block, factorised from the top and from the bottom."""

    def __init__(self, diagonal: np.ndarray, above: np.ndarray, value: float):
        n, tiny = len(diagonal), np.finfo(float).tiny / EPS
        q, e, self.off = diagonal**2, above**2, diagonal[:-1] * above
        self.down, self.up = np.empty(n), np.empty(n)
        s, p = np.empty(n), np.empty(n)

        def safe(x: float) -> float:
            return x if abs(x) > tiny else math.copysign(tiny, x)

        s[0] = -value
        for i in range(n):
            self.down[i] = safe(s[i] + q[i])
            if i + 1 < n:
                s[i + 1] = s[i] * (e[i] / self.down[i]) - value
        p[n - 1] = q[n - 1] - value
        for i in range(n - 1, 0, -1):
            self.up[i] = safe(e[i - 1] + p[i])
            p[i - 1] = p[i] * (q[i - 1] / self.up[i]) - value
        self.up[0] = safe(p[0])
        self.gamma = s + p + value
        self.gamma[~np.isfinite(self.gamma)] = math.inf

    def vector(self) -> tuple[np.ndarray, float]:
        """(unit vector, how far its value lies from the one given), twisted where the two factorisations fit best."""
        n = len(self.down)
        r = int(np.argmin(np.abs(self.gamma)))
        z = np.zeros(n)
        z[r] = 1.0
        for i in range(r - 1, -1, -1):
            z[i] = -z[i + 1] * (self.off[i] / self.down[i])
        for i in range(r, n - 1):
            z[i + 1] = -z[i] * (self.off[i] / self.up[i + 1])
        norm = math.sqrt(float(z @ z))
        return z / norm, float(self.gamma[r]) / norm**2

    def solved(self, x: np.ndarray) -> np.ndarray:
        """A unit vector along the solution y of (T - value) y = x."""
        y, n = x.copy(), len(x)
        for i in range(1, n):
            y[i] -= y[i - 1] * (self.off[i - 1] / self.down[i - 1])
        y /= self.down
        for i in range(n - 2, -1, -1):
            y[i] -= y[i + 1] * (self.off[i] / self.down[i])
        top = np.abs(y).max()
        return y / top / math.sqrt(float((y / top) @ (y / top))) if np.isfinite(top) and top else x


def right_vectors(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, unit right singular vectors as rows) of the ``most`` leading squares of singular values."""
    d = len(diagonal)
    top = max(np.abs(diagonal).max(), np.abs(above).max(initial=0.0))
    cuts = [0, *(np.flatnonzero(np.abs(above) <= EPS * top / 4) + 1).tolist(), d]
    rng, picked = np.random.default_rng(13), []
    for a, z in zip(cuts, cuts[1:]):  # blocks that nothing joins have their own values
        block = diagonal[a:z], above[a : z - 1]
        own = values if (a, z) == (0, d) else dqds(*block)
        done: list[tuple[float, np.ndarray]] = []
        for value in own[:most]:
            factors = _Twisted(*block, value)
            vector, off = factors.vector()
            near = [v for x, v in done if abs(x - value) <= 1e-3 * max(x, value)]
            for v in near * 2:
                vector = vector - (v @ vector) * v
            left = math.sqrt(float(vector @ vector))
            if left < 0.7:  # the same vector again: iterate within what is left
                vector = rng.standard_normal(z - a)
                for _ in range(6):
                    for v in near * 2:
                        vector = vector - (v @ vector) * v
                    vector = factors.solved(vector / math.sqrt(float(vector @ vector)))
                for v in near * 2:
                    vector = vector - (v @ vector) * v
                left = math.sqrt(float(vector @ vector))
            done.append((float(value), vector / left))
        for value, vector in done:
            picked.append((value, np.concatenate((np.zeros(a), vector, np.zeros(d - z)))))
    picked.sort(key=lambda x: -x[0])
    return np.array([x for x, _ in picked[:most]]), np.array([v for _, v in picked[:most]]).reshape(-1, d)


@dataclass
class Whitening:
    """What whitens the rows: their number, exact sums, unit eigenvectors of the covariance (as rows), and eigenvalues."""

    n: int
    sums: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray


def directions(r: np.ndarray, n: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(vectors, eigenvalues, explained shares) of the covariance r'r / n, of at most ``most`` components."""
    if not len(r) or not np.abs(r).max():
        return np.zeros((0, len(r))), np.zeros(0), np.zeros(0)
    diagonal, above, v = bidiagonal(r)
    squares = dqds(diagonal, above)
    rank = int((squares > (8 * len(r) * EPS) ** 2 * squares[0]).sum())
    squares_top, z = right_vectors(diagonal, above, squares, min(most, rank))
    vectors = z @ v.T
    vectors *= np.sign(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(axis=1)])[:, None]
    off = np.abs(vectors @ r.T @ r - squares_top[:, None] * vectors).max(initial=0.0)
    if off > 1e-9 * squares[0] or np.abs(vectors @ vectors.T - np.eye(len(vectors))).max(initial=0.0) > 1e-9:
        raise ArithmeticError("the singular vectors did not converge")
    return vectors, squares_top / n, squares_top / squares.sum()


def fitted(df: DataFrame, vec_col: str = "embedding", most: int = 8) -> Whitening:
    n, sums = vector_sums(df, vec_col)
    if not n or not len(sums):
        return Whitening(n, sums, np.zeros((0, len(sums))), np.zeros(0), np.zeros(0))
    return Whitening(n, sums, *directions(triangle(df, vec_col, n, sums), n, most))


def _deviations(t: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Sums of squares by row, exact: as long (null beyond its range) and as decimal."""
    top = int(np.abs(t).max(initial=0))
    if top * top * max(1, t.shape[1]) < 2**63:
        exact = pa.array((t * t).sum(axis=1), pa.int64())
        return exact, exact.cast(pa.decimal128(38, 0))
    whole = [int(x) for x in (t.astype(object) ** 2).sum(axis=1)]
    return pa.array([x if x < 2**63 else None for x in whole], pa.int64()), pa.array([Decimal(x) for x in whole], pa.decimal128(38, 0))


def whiten(df: DataFrame, w: Whitening, vec_col: str = "embedding") -> DataFrame:
    """The rows of ``df`` whose vectors stay, with ``n``, ``deviation`` (null beyond a long), ``deviation_exact``,
    ``whitened`` and ``explained`` (lists by component) and ``identity_error``, the same for all rows."""
    added = StructType().add("deviation", LongType()).add("deviation_exact", DecimalType(38, 0)).add("whitened", ArrayType(DoubleType()))
    names = {"n", "explained", "identity_error"}
    kept = [f for f in kept_fields(df, added) if f.name.lower() not in names]
    out = StructType([*kept, *added])
    k, scale = len(w.values), np.sqrt(w.values)

    def run(batches):
        for b in batches:
            rows, x = grid(b.column(vec_col))
            if not len(rows):
                continue
            t = w.n * x - w.sums
            y = np.ascontiguousarray((t / w.n) @ w.vectors.T / scale) if k else np.zeros((len(x), 0))
            at = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * k)
            lists = pa.ListArray.from_arrays(at, pa.array(y.ravel(), pa.float64()))
            taken = b.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([*(taken.column(f.name) for f in kept), *_deviations(t), lists], names=out.fieldNames())

    made = written(df.select(*{*(f.name for f in kept), vec_col}).mapInArrow(run, out), "whitened")
    made = made.withColumn("n", F.lit(w.n).cast("long")).withColumn("explained", F.lit(w.explained.tolist()).cast("array<double>") if k else F.array().cast("array<double>"))
    return made.withColumn("identity_error", F.lit(identity_error(made, k)).cast("double"))


def identity_error(made: DataFrame, k: int) -> float | None:
    """The largest entry of the covariance of ``whitened`` less the identity; None without rows or components."""
    out = StructType().add("at", LongType()).add("sum", DoubleType())

    def run(batches):
        n, first, second = 0, np.zeros(k), np.zeros((k, k))
        for b in batches:
            y = pc.list_flatten(b.column(0)).to_numpy(zero_copy_only=False).reshape(-1, k)
            n, first, second = n + len(y), first + y.sum(axis=0), second + y.T @ y
        every = np.concatenate(([n], first, second.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(every))), pa.array(every)], names=["at", "sum"])

    if not k:
        return None
    sums = np.array([r["s"] for r in made.select("whitened").mapInArrow(run, out).groupBy("at").agg(F.sum("sum").alias("s")).orderBy("at").collect()])
    if not len(sums) or not sums[0]:
        return None
    mean = sums[1 : k + 1] / sums[0]
    return float(np.abs(sums[k + 1 :].reshape(k, k) / sums[0] - np.outer(mean, mean) - np.eye(k)).max())


def op13_bidiagonal_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    made = whiten(rows, fitted(rows, "embedding", 8), "embedding")
    each = made.select("vec_id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c"))
    return each.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", "c.whitened", "c.explained", "identity_error")
