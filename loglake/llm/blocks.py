"""Blocks of texts with a dictionary each, so that distinct words are shuffled in place of all words.

Texts are split once. A block holds some megabytes of text: its skeleton says which dictionary entry stands at each
position, and its distinct words are dealt by a hash of the word into parts, one packed row for each part. All parts of
one number meet in one task, where a fact about a word (an encoding, a count over the whole table) is found once for all
blocks; packed facts return to the blocks. Blocks are written before use, so their numbers are fixed values, and the
table is bucketed by block, so that joining facts to skeletons moves only the facts.

A word takes one entry of a block however often it occurs, so neither a hot word nor a hot text swells a part.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from loglake.llm.text import hashes, mix, slices
from loglake.session import scratch_path


LEVEL = 6


def packed(numbers: np.ndarray) -> bytes:
    """Non-negative integers below 2**32 as compressed byte planes."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    used = 4
    while used > 1 and not planes[used - 1].any():
        used -= 1
    return bytes([used]) + zstandard.ZstdCompressor(level=LEVEL).compress(planes[:used].tobytes())


def unpacked(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[1:]), np.uint8).reshape(blob[0], -1)
    out = np.zeros((raw.shape[1], 4), np.uint8)
    out[:, : blob[0]] = raw.T
    return out.view("<u4").ravel()


def packed_words(words: pa.Array) -> tuple[bytes, bytes]:
    """(lengths, bytes) of a large_string array."""
    at = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = words.buffers()[2]
    raw = memoryview(data)[at[0] : at[-1]] if data is not None else b""
    return packed(np.diff(at)), zstandard.ZstdCompressor(level=LEVEL).compress(raw)


def unpacked_words(lengths: bytes, data: bytes) -> pa.Array:
    size = unpacked(lengths).astype(np.int64)
    at = np.concatenate(([0], np.cumsum(size)))
    raw = zstandard.ZstdDecompressor().decompress(data)
    return pa.Array.from_buffers(pa.large_string(), len(size), [None, pa.py_buffer(at.tobytes()), pa.py_buffer(raw)])


def entries_of(blob: bytes) -> np.ndarray:
    return np.cumsum(unpacked(blob).astype(np.int64))


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indexes starts[i], ..., starts[i] + sizes[i] - 1 for each i in turn."""
    before = np.concatenate(([0], np.cumsum(sizes)))
    return np.repeat(starts - before[:-1], sizes) + np.arange(before[-1])


def parts_for(df: DataFrame, part_bytes: int = 16 << 20, least: int = 32, most: int = 4096) -> int:
    """How many parts suit the size of the input."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(least, min(most, size // part_bytes))


def word_blocks(df: DataFrame, id_col: str, text_col: str, split: Callable, extra: list[str] = (), block_bytes: int = 20 << 20) -> tuple[DataFrame, DataFrame]:
    """(skeletons, words) of the texts of ``df``.

    ``split`` turns a record batch into (starts, codes, words). Skeletons: block, ids and ``extra`` as lists, sizes (words
    of each text) and codes, both packed, tokens (how many words are counted). Words: block, part, entries, lengths, data, counts (packed; how often each word
    stands in the block, in rows where the first extra column is true if there is one). Entries ascend and are packed as
    differences: ``entries_of`` restores them.
    """
    n_parts = parts_for(df)
    lists = [StructField(c, ArrayType(df.schema[c].dataType)) for c in (id_col, *extra)]
    blobs = ("sizes", "codes", "entries", "lengths", "data", "counts")
    head = [StructField("block", LongType()), StructField("part", IntegerType()), StructField("tokens", LongType())]
    out = StructType([*head, *lists, *(StructField(c, BinaryType()) for c in blobs)])

    def run(batches):
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            names = [f.name for f in lists]
            kinds = dict(zip(out.fieldNames(), [pa.int64(), pa.int32(), pa.int64(), *(pa.list_(batch.schema.field(n).type) for n in names), *[pa.binary()] * len(blobs)]))
            for b in slices(batch, text_col, block_bytes):
                starts, codes, words = split(b)
                words = words.cast(pa.large_string())
                counted = codes if not extra else codes[np.repeat(b.column(extra[0]).to_numpy(zero_copy_only=False).astype(bool), np.diff(starts))]
                counts = np.bincount(counted, minlength=len(words))
                # frequent words get small numbers, which pack well
                often = np.bincount(codes, minlength=len(words))
                used = np.argsort(-often, kind="stable")[: np.count_nonzero(often)]
                number = np.zeros(len(words), np.int32)
                number[used] = np.arange(len(used))
                codes, counts, words = number[codes], counts[used], words.take(pa.array(used))
                part = (mix(hashes(words)) % np.uint64(n_parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                part = part[order]
                cuts = np.flatnonzero(np.diff(part, prepend=-1, append=n_parts)) if len(part) else np.zeros(1, np.int64)
                rows = [{"block": block, "tokens": len(counted), **{n: b.column(n).to_pylist() for n in names}, "sizes": packed(np.diff(starts)), "codes": packed(codes)}]
                for a, z in zip(cuts, cuts[1:]):
                    own = order[a:z]
                    lengths, data = packed_words(words.take(pa.array(own)))
                    rows.append({"block": block, "part": int(part[a]), "entries": packed(np.diff(own, prepend=0)), "lengths": lengths, "data": data, "counts": packed(counts[own])})
                yield pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], k) for n, k in kinds.items()], names=list(kinds))
                block += 1
                pa.default_memory_pool().release_unused()

    spark = df.sparkSession
    table, path = f"blocks_{uuid.uuid4().hex}", scratch_path(spark, "llm", "blocks")
    made = df.select(id_col, text_col, *extra).mapInArrow(run, out)
    # with fewer buckets than shuffle partitions the planner would shuffle the skeletons after all
    buckets = max(parts_for(df, most=50_000), int(spark.conf.get("spark.sql.shuffle.partitions")))
    made.write.bucketBy(buckets, "block").option("path", path).option("compression", "uncompressed").saveAsTable(table)
    both = spark.table(table)
    skeletons = both.where("part is null").select("block", "tokens", id_col, *extra, "sizes", "codes")
    return skeletons, both.where("part is not null").select("block", "part", "entries", "lengths", "data", "counts")


def by_part(words: DataFrame) -> DataFrame:
    """Rows of a part in one task."""
    return words.repartition(parts_for(words), "part")


def with_facts(skeletons: DataFrame, facts: DataFrame, columns: list[str]) -> DataFrame:
    """Skeletons with the list of their packed facts: one element for each part."""
    lists = facts.groupBy("block").agg(F.collect_list(F.struct(*columns)).alias("facts"))
    return skeletons.join(lists, "block", "left")
