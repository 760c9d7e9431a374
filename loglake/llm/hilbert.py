"""Sharding along a Hilbert curve: rows near each other in several metadata dimensions share a shard and its files.

Each dimension is cut at its own quantiles into ``2**BITS`` cells, a row's cells give its place on the curve, rows are
ranked by that place, and the ranking is cut into runs of equal counts (law ``rows``: counts differ by one at most).
A hot cell is no hot task: the ranking goes on by the key columns inside a cell.

Null dimensions lie in cell 0, null keys come first in a cell, and rows that are equal throughout get neighbouring slots
in an arbitrary order. An empty table gives an empty result. Columns named ``shard``, ``slot`` or ``hilbert`` in the
input give way; all others stay.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, NumericType, StructField, StructType

from loglake.llm.scratch import ranked

BITS = 5
_PREFIX = 6  # bytes of a string that a double holds exactly


def curve_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of an (n, dims) array of cells from 0 to 2**bits - 1."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the rotations and reflections of each level, largest cubes first
        p = q - 1
        for i in range(dims):
            far = (x[i] & q) != 0
            x[0] = np.where(far, x[0] ^ p, x[0])
            swap = np.where(far, 0, (x[0] ^ x[i]) & p)
            x[0] ^= swap
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):  # Gray code
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip = np.where((x[-1] & q) != 0, flip ^ (q - 1), flip)
        q >>= 1
    x ^= flip
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def _bytes(dim: str) -> Column:
    return F.encode(F.col(f"`{dim}`").cast("string"), "UTF-8")


def _measures(df: DataFrame, dims: list[str]) -> list[Column]:
    """A double that orders the values of each dimension; of strings, the bytes behind what all of them begin with."""
    texts = [d for d in dims if not isinstance(df.schema[d].dataType, NumericType)]
    # what the least and the greatest value share, all values between them share
    ends = df.agg(*(f(_bytes(d)).alias(f"{n}{i}") for i, d in enumerate(texts) for n, f in (("a", F.min), ("z", F.max)))).first() if texts else None
    out = []
    for d in dims:
        if d in texts:
            a, z = (bytes(ends[f"{n}{texts.index(d)}"] or b"") for n in "az")
            behind = len(os.path.commonprefix([a, z]))
            padded = F.rpad(F.hex(F.substring(_bytes(d), behind + 1, _PREFIX)), 2 * _PREFIX, "0")
            out.append(F.conv(padded, 16, 10).cast("double"))
        else:
            out.append(F.col(f"`{d}`").cast("double"))
    return out


def hilbert_shards(df: DataFrame, dims: list[str], keys: list[str], n_shards: int, bits: int = BITS) -> DataFrame:
    """``df`` with ``hilbert``, ``shard`` (0 to n_shards - 1) and ``slot`` (gapless in a shard, in curve order)."""
    df = df.drop(*(c for c in df.columns if c.lower() in ("shard", "slot", "hilbert")))
    # columns that have the names of those that the ranking adds for a while
    held = {c: f"_held_{c}" for c in df.columns if c.lower() in ("rank", "n_total")}
    df, dims, keys = df.withColumnsRenamed(held), [held.get(d, d) for d in dims], [held.get(k, k) for k in keys]
    n_cells = 1 << bits
    points = df.select("*", *(m.alias(f"_m{i}") for i, m in enumerate(_measures(df, dims))))
    at = F.array(*(F.lit(i / n_cells) for i in range(1, n_cells)))
    # one row of dims * (2**bits - 1) numbers
    found = points.agg(*(F.percentile_approx(f"_m{i}", at, F.lit(10_000)).alias(f"q{i}") for i in range(len(dims)))).first()
    cuts = [np.array(q if q is not None else [], float) for q in found]
    kept = list(df.schema)
    out = StructType([*kept, StructField("hilbert", LongType())])

    def place(batches):
        for b in batches:
            cells = np.zeros((b.num_rows, len(dims)), np.int64)
            for i, c in enumerate(cuts):
                v = b.column(f"_m{i}").to_numpy(zero_copy_only=False).astype(float)
                cells[:, i] = np.where(np.isnan(v), 0, np.searchsorted(c, v, side="right"))
            index = pa.array(curve_index(cells, bits), pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in kept), index], names=out.fieldNames())

    order = ranked(points.mapInArrow(place, out), ["hilbert", *keys], "hilbert")
    # the first rank of a shard is the least r with r * n_shards >= shard * n_total
    first = F.expr(f"(shard * n_total + {n_shards - 1}) div {n_shards}")
    shard = F.expr(f"cast((rank * {n_shards}) div n_total as int)")
    placed = order.withColumn("shard", shard).withColumn("slot", F.col("rank") - first).drop("rank", "n_total")
    return placed.withColumnsRenamed({v: k for k, v in held.items()})


def write_shards(sharded: DataFrame, path: str) -> None:
    """Files by shard, each a run of slots, so that a file's statistics bound every dimension closely."""
    runs = sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    runs.write.partitionBy("shard").parquet(path)


def op9_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id", "lang", "source", "n_chars",
        (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
    )
    return hilbert_shards(docs, ["lang", "source", "n_chars"], ["doc_id", "text_crc32", "size"], 24).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
