"""Sequence packing by minimum bin slack.

Texts become token ids with an end id; a text longer than a window is cut into full windows and a rest. Only the
histogram of piece lengths (at most ``capacity`` lengths, however many pieces) is packed: each step seeds a window with
the longest length left, and a bitset subset-sum over the multiset of remaining lengths finds the fill closest to the
capacity; counts are traced back through the bitsets. The window found repeats as often as the counts allow, which uses
up at least one length, so there are at most ``capacity`` steps. Each piece then finds its window by a join on its
length and its number among the pieces of that length.

Null text counts as empty: the end id alone. Repeated rows are packed each for itself. Ties between pieces of one length
go by their place in a written table. An empty table gives no piece. Extra columns are left out unless named in ``carry``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from loglake.llm.scratch import written
from loglake.llm.text import slices, texts_of
from loglake.llm.tokens import word_encoder

CAPACITY = 4096
END_ID = 2
#: bytes of text encoded at a time: larger slices repeat more words
ENCODE_BYTES = 24 << 20


def token_pieces(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = END_ID) -> DataFrame:
    """Pieces of at most ``capacity`` ids: id, start, length, ids (little-endian unsigned 32-bit), doc_tokens."""
    out = StructType([
        StructField(id_col, df.schema[id_col].dataType), StructField("start", LongType()),
        StructField("length", LongType()), StructField("ids", BinaryType()), StructField("doc_tokens", LongType()),
    ])

    def run(batches):
        encoder = word_encoder(tokenizer)
        for batch in batches:
            for b in slices(batch, text_col, ENCODE_BYTES):
                starts, ids = encoder.encode(texts_of(b.column(text_col)), end)
                n = np.diff(starts)
                pieces = -(-n // capacity)
                row = np.repeat(np.arange(len(n)), pieces)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * capacity
                length = np.minimum(capacity, n[row] - start)
                cuts = np.concatenate((starts[:-1][row] + start, starts[-1:])) * 4
                raw = pa.py_buffer(ids.tobytes())
                blob = pa.Array.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(cuts.astype(np.int64).tobytes()), raw])
                yield pa.RecordBatch.from_arrays(
                    [b.column(id_col).take(pa.array(row)), pa.array(start), pa.array(length), blob.cast(pa.binary()), pa.array(n[row])],
                    names=out.fieldNames(),
                )

    return df.select(id_col, text_col).mapInArrow(run, out)


def closest_fill(lengths: list[int], counts: dict[int, int], room: int) -> dict[int, int]:
    """How many of each length (descending ``lengths``) to take so that their sum is the largest that fits ``room``."""
    mask, reach, seen = (1 << (room + 1)) - 1, 1, []
    for x in lengths:
        if x > room or not counts[x]:
            continue
        seen.append((x, reach))
        left, step = min(counts[x], room // x), 1
        while left:  # in powers of two
            m = min(step, left)
            reach |= (reach << (m * x)) & mask
            left -= m
            step *= 2
        if reach >> room:
            break
    total, taken = reach.bit_length() - 1, {}
    for x, before in reversed(seen):
        k = 0
        while not before >> (total - k * x) & 1:
            k += 1
        if k:
            taken[x] = k
            total -= k * x
    return taken


def plan_windows(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first, last, per_window, sequence, offset): pieces number first to last - 1 of that length go
    ``per_window`` to a window, in windows from ``sequence`` on, at ``offset`` and after it."""
    left, lengths = dict(histogram), sorted(histogram, reverse=True)
    used, rows, sequence = dict.fromkeys(histogram, 0), [], 0
    while lengths:
        seed = lengths[0]
        left[seed] -= 1
        window = closest_fill(lengths, left, capacity - seed)
        left[seed] += 1
        window = {seed: 1 + window.pop(seed, 0), **window}
        times, offset = min(left[x] // k for x, k in window.items()), 0
        for x, k in window.items():
            rows.append((x, used[x], used[x] + times * k, k, sequence, offset))
            used[x] += times * k
            left[x] -= times * k
            offset += x * k
        sequence += times
        lengths = [x for x in lengths if left[x]]
    return rows


def pack(pieces: DataFrame, carry: list[str], capacity: int = CAPACITY) -> DataFrame:
    """``carry`` columns of ``pieces`` and ``length``, each with its ``sequence_id`` and ``offset``.

    ``pieces`` is written once, so that the counts and the numbers hold for the same rows.
    """
    spark = pieces.sparkSession
    table = written(pieces.select(*carry, "length").withColumn("_place", F.monotonically_increasing_id()), "pieces")
    table = table.withColumn("_task", F.shiftright("_place", 33))
    per_task = table.groupBy("length", "_task").agg(F.count(F.lit(1)).alias("_n"))
    # at most ``capacity`` rows
    histogram = {r["length"]: r["n"] for r in table.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = spark.createDataFrame(
        plan_windows(histogram, capacity) or [(0, 0, 0, 1, 0, 0)],
        "_l long, _first long, _last long, _k long, _sequence long, _offset long",
    )
    earlier = Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    base = per_task.select("length", "_task", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    own = Window.partitionBy("length", "_task").orderBy("_place")
    numbered = table.withColumn("_own", F.row_number().over(own)).join(base, ["length", "_task"])
    numbered = numbered.withColumn("_number", F.col("_base") + F.col("_own") - 1)
    # the plan has at most capacity windows of at most sqrt(2 * capacity) lengths
    hit = (F.col("length") == F.col("_l")) & (F.col("_number") >= F.col("_first")) & (F.col("_number") < F.col("_last"))
    turn = F.col("_number") - F.col("_first")
    return numbered.join(F.broadcast(plan), hit).select(
        *carry, "length",
        F.expr("_sequence + (_number - _first) div _k").alias("sequence_id"),
        (F.col("_offset") + turn % F.col("_k") * F.col("length")).alias("offset"),
    )


def op7_min_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pieces = token_pieces(docs, public_tokenizers.path("word_bpe_49k.json")).withColumn("ids_crc32", F.crc32("ids"))
    return pack(pieces, ["doc_id", "start", "ids_crc32", "doc_tokens"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )
