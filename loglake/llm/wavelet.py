"""Token-id files as wavelet matrices.

Texts become token ids in ascending id order; runs of whole texts make shards of about ``SHARD_TOKENS`` tokens, and each
shard is one wavelet matrix: a bit-plane per bit of the ids, each plane the stable partition of the one before, with a
running count of ones every ``RANK_WORD`` bits. One compressed file thus answers access, rank (count) and select
(occurrence lookup) without the plain sequence. A shard's file is a row of a Parquet table in shared storage.

File format, little-endian: ``WMX1``, u32 bits, u64 tokens, then for each plane u64 zeros and u32 length of its zlib
stream, then the streams (bit i of a plane: byte i // 8, value 128 >> i % 8). Counts of ones are rebuilt on load.

Null text counts as empty: the end id alone. Rows are ordered by id (null first), then by a hash of the text; each
repeated row is stored. An empty table gives no shard. A text is never cut: a very long one is a shard of its own.
"""

from __future__ import annotations

import struct
import zlib
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from loglake.llm.scratch import range_tasks, written
from loglake.llm.text import slices, texts_of
from loglake.llm.tokens import word_encoder

SHARD_TOKENS = 1 << 20
RANK_WORD = 512
END_ID = 2
ENCODE_BYTES = 24 << 20


class WaveletMatrix:
    """A sequence of non-negative integers as bit-planes, most significant first."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int]):
        self.n, self.planes, self.zeros = n, planes, zeros  # planes: packed bits

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        now = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        planes, zeros, parted = [], [], np.empty_like(now)
        for b in range(bits - 1, -1, -1):
            one = (now & now.dtype.type(1 << b)) != 0
            planes.append(np.packbits(one))
            zeros.append(len(now) - int(np.count_nonzero(one)))
            np.compress(~one, now, out=parted[: zeros[-1]])
            np.compress(one, now, out=parted[zeros[-1] :])
            now, parted = parted, now
        return cls(len(ids), planes, zeros)

    def to_bytes(self) -> bytes:
        streams = [zlib.compress(p.tobytes(), 1) for p in self.planes]
        head = struct.pack("<4sIQ", b"WMX1", len(self.planes), self.n)
        return head + b"".join(struct.pack("<QI", z, len(s)) for z, s in zip(self.zeros, streams)) + b"".join(streams)

    @classmethod
    def from_bytes(cls, blob: bytes) -> WaveletMatrix:
        magic, bits, n = struct.unpack_from("<4sIQ", blob)
        if magic != b"WMX1":
            raise ValueError("not a wavelet matrix file")
        heads = [struct.unpack_from("<QI", blob, 16 + 12 * i) for i in range(bits)]
        at, planes = 16 + 12 * bits, []
        for _, size in heads:
            planes.append(np.frombuffer(zlib.decompress(blob[at : at + size]), np.uint8))
            at += size
        return cls(n, planes, [z for z, _ in heads])

    @cached_property
    def _ones(self) -> list[np.ndarray]:
        """For each plane the ones before every RANK_WORD-th bit."""
        out = []
        for p in self.planes:
            per_byte = np.bitwise_count(p).astype(np.int64)
            before = np.concatenate(([0], np.cumsum(per_byte)))
            out.append(before[:: RANK_WORD // 8])
        return out

    def _rank1(self, plane: int, i: int) -> int:
        block = i // RANK_WORD
        p, a = self.planes[plane], block * (RANK_WORD // 8)
        full = i // 8
        ones = int(self._ones[plane][block]) + int(np.bitwise_count(p[a:full]).sum())
        return ones + (int(p[full]) >> (8 - i % 8)).bit_count() if i % 8 else ones

    def access(self, i: int) -> int:
        value = 0
        for k, z in enumerate(self.zeros):
            bit = self.planes[k][i // 8] >> (7 - i % 8) & 1
            ones = self._rank1(k, i)
            i = z + ones if bit else i - ones
            value = value << 1 | int(bit)
        return value

    def _range(self, value: int, i: int) -> tuple[int, int]:
        """Where the occurrences of ``value`` among the first i tokens lie below the last plane."""
        a, b, bits = 0, i, len(self.planes)
        if value >> bits:
            return 0, 0
        for k, z in enumerate(self.zeros):
            ra, rb = self._rank1(k, a), self._rank1(k, b)
            a, b = (z + ra, z + rb) if value >> (bits - 1 - k) & 1 else (a - ra, b - rb)
        return a, b

    def count(self, value: int, i: int | None = None) -> int:
        """Occurrences of ``value`` among the first i tokens (all by default)."""
        a, b = self._range(value, self.n if i is None else i)
        return b - a

    def select(self, value: int, j: int) -> int:
        """Place of the j-th (from 0) occurrence of ``value``."""
        a, b = self._range(value, self.n)
        if not 0 <= j < b - a:
            raise IndexError(j)
        at = a + j
        for k in range(len(self.planes) - 1, -1, -1):
            one = value >> (len(self.planes) - 1 - k) & 1
            at = self._place(k, at - self.zeros[k] if one else at, one)
        return at

    def _place(self, plane: int, j: int, one: int) -> int:
        """Place of the j-th bit ``one`` of a plane, by bisection over the running counts, then in one block."""
        step = RANK_WORD // 8
        ones = self._ones[plane]
        counts = ones if one else np.arange(len(ones)) * RANK_WORD - ones
        block = int(np.searchsorted(counts, j, side="right")) - 1
        bits = np.unpackbits(self.planes[plane][block * step : (block + 1) * step])[: self.n - block * RANK_WORD]
        return block * RANK_WORD + int(np.flatnonzero(bits == one)[j - int(counts[block])])

    def sequence(self) -> np.ndarray:
        """All tokens: the planes are undone from the last one up."""
        now = np.zeros(self.n, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for k in range(len(self.planes) - 1, -1, -1):
            one = np.unpackbits(self.planes[k], count=self.n).astype(bool)
            back, z = np.empty_like(now), self.zeros[k]
            back[~one] = now[:z]
            back[one] = now[z:] | now.dtype.type(1 << (len(self.planes) - 1 - k))
            now = back
        return now.astype(np.uint32)


def write_token_shards(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """The written table of shards: run, shard (in order of the ids), doc_ids, doc_tokens, n_tokens, file."""
    kind = df.schema[id_col].dataType
    out = StructType([
        StructField("run", IntegerType()), StructField("shard", IntegerType()), StructField("doc_ids", ArrayType(kind)),
        StructField("doc_tokens", ArrayType(LongType())), StructField("n_tokens", LongType()), StructField("file", BinaryType()),
    ])
    arrow_id = pa.int64() if isinstance(kind, LongType) else None

    def run(batches):
        from pyspark import TaskContext

        part, shard, encoder = TaskContext.get().partitionId(), 0, word_encoder(tokenizer)
        ids, sizes, tokens, held = [], [], [], 0

        def done():
            matrix = WaveletMatrix.build(np.concatenate(tokens))
            columns = [[part], [shard], [ids], [sizes], [matrix.n], [matrix.to_bytes()]]
            kinds = [pa.int32(), pa.int32(), pa.list_(arrow_id) if arrow_id else None, pa.list_(pa.int64()), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=out.fieldNames())

        for batch in batches:
            for b in slices(batch, text_col, ENCODE_BYTES):
                starts, flat = encoder.encode(texts_of(b.column(text_col)), end)
                keys, a = b.column(id_col).to_pylist(), 0
                while a < len(keys):
                    # whole texts until the shard is full
                    z = int(np.searchsorted(starts, starts[a] + shard_tokens - held, side="left"))
                    z = min(max(z, a + 1), len(keys))
                    ids += keys[a:z]
                    sizes += np.diff(starts[a : z + 1]).tolist()
                    tokens.append(flat[starts[a] : starts[z]])
                    held += int(starts[z] - starts[a])
                    a = z
                    if held >= shard_tokens:
                        yield done()
                        shard, ids, sizes, tokens, held = shard + 1, [], [], [], 0
        if held:
            yield done()

    # only the texts are shuffled; each task encodes its run of ids and builds its shards in one pass
    ranged = df.select(id_col, text_col).withColumn("_tie", F.xxhash64(text_col))
    ranged = ranged.repartitionByRange(*range_tasks(ranged), id_col, "_tie").sortWithinPartitions(id_col, "_tie")
    return written(ranged.mapInArrow(run, out), "tokens", "uncompressed")


def shard_starts(shards: DataFrame) -> DataFrame:
    """run, shard and the number of tokens before each shard: sums over runs first, then inside each run."""
    per_run = shards.groupBy("run").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task
    base = per_run.select("run", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_run_start"))
    inside = Window.partitionBy("run").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    own = shards.select("run", "shard", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("_in_run"))
    return own.join(base, "run").select("run", "shard", (F.col("_run_start") + F.col("_in_run")).alias("shard_start"))


def read_documents(shards: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Every text read back from the files: id, run, shard, offset in the shard, n_tokens, ids (u32 binary)."""
    kind = shards.schema["doc_ids"].dataType.elementType
    out = StructType([
        StructField(id_col, kind), StructField("run", IntegerType()), StructField("shard", IntegerType()),
        StructField("offset", LongType()), StructField("n_tokens", LongType()), StructField("ids", BinaryType()),
    ])

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                sizes = np.array(b.column("doc_tokens")[i].as_py(), np.int64)
                flat = WaveletMatrix.from_bytes(b.column("file")[i].as_py()).sequence()
                cuts = np.concatenate(([0], np.cumsum(sizes)))
                blob = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer((cuts * 4).tobytes()), pa.py_buffer(flat.tobytes())])
                same = lambda c: pa.array(np.full(len(sizes), b.column(c)[i].as_py(), np.int32))  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_ids")[i].values, same("run"), same("shard"), pa.array(cuts[:-1]), pa.array(sizes), blob.cast(pa.binary())],
                    names=out.fieldNames(),
                )

    return shards.select("run", "shard", "doc_ids", "doc_tokens", "file").mapInArrow(run, out)


def op3_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    shards = write_token_shards(docs, public_tokenizers.path("word_bpe_49k.json"))
    texts = read_documents(shards).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return texts.join(shard_starts(shards), ["run", "shard"]).select(
        "doc_id", (F.col("shard_start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )
