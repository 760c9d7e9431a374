"""Byte-level BPE encoding and decoding through a global shuffle of distinct words.

Pre-tokens (matches of the pattern) are exploded with their positions into blocks; each distinct pre-token of the whole
table is encoded once, in the one task that its hash leads to; ids are joined back by block and entry, and texts are put
together again by position. Decoding joins the table of token bytes (one row for each rank: a fixed size) to the ids.

Null text counts as empty: no ids, no bytes. Special tokens do not exist: their strings are ordinary text. Repeated rows
are encoded as any. An empty table gives an empty result. Extra columns are left out. A very long text is a block.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from loglake.llm.blocks import by_part, entries_of, packed, ragged, unpacked, unpacked_words, with_facts, word_blocks
from loglake.llm.text import coded, texts_of

BLOCK_BYTES = 8 << 20
CHUNK = 50_000  # pre-tokens


@lru_cache(maxsize=2)
def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


@lru_cache(maxsize=2)
def _encoding(path: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks_of(path), special_tokens={})


@lru_cache(maxsize=2)
def _token_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, number of bytes) of each id, and all bytes."""
    ranks = ranks_of(path)
    tokens = [b""] * (max(ranks.values()) + 1)
    for t, i in ranks.items():
        tokens[i] = t
    size = np.array([len(t) for t in tokens], np.int64)
    return np.cumsum(size) - size, size, np.frombuffer(b"".join(tokens), np.uint8)


def pre_tokens(texts: pa.Array, pattern: regex.Pattern) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(starts, codes, words) of the matches of ``pattern`` in each text."""
    sizes, chunks, held = [], [], []
    for text in texts:
        found = pattern.findall(text.as_py())
        sizes.append(len(found))
        held += found
        if len(held) >= CHUNK:  # as Python strings for a short while only
            chunks.append(pa.array(held, pa.large_string()))
            held = []
    chunks.append(pa.array(held, pa.large_string()))
    return coded(np.concatenate(([0], np.cumsum(sizes, dtype=np.int64))), pa.concat_arrays(chunks))


def encode(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, ids (little-endian unsigned 32-bit) of each text."""

    def split(b):
        return pre_tokens(texts_of(b.column(text_col)), regex.compile(pattern))

    skeletons, words = word_blocks(df, id_col, text_col, split, block_bytes=BLOCK_BYTES)
    fact = StructType([StructField("block", LongType())] + [StructField(c, BinaryType()) for c in ("entries", "sizes", "ids")])

    def encode_words(batches):
        known: dict[str, bytes] = {}  # the distinct words of this part
        encoding = _encoding(ranks_path, pattern)
        for b in batches:
            for i in range(b.num_rows):
                ids = []
                for w in unpacked_words(b.column("lengths")[i].as_py(), b.column("data")[i].as_py()).to_pylist():
                    got = known.get(w)
                    if got is None:
                        got = known[w] = np.array(encoding.encode_ordinary(w), np.uint32).tobytes()
                    ids.append(got)
                sizes = np.fromiter((len(x) // 4 for x in ids), np.int64, len(ids))
                blob = packed(np.frombuffer(b"".join(ids), np.uint32))
                yield pa.RecordBatch.from_arrays([b.column("block").slice(i, 1), b.column("entries").slice(i, 1), pa.array([packed(sizes)]), pa.array([blob])], names=fact.fieldNames())

    facts = by_part(words).mapInArrow(encode_words, fact)
    out = StructType([StructField(id_col, df.schema[id_col].dataType), StructField("n_tokens", LongType()), StructField("ids", BinaryType())])

    def assemble(batches):
        for b in batches:
            for i in range(b.num_rows):
                facts = b.column("facts")[i].as_py() or []
                entries = [entries_of(f["entries"]) for f in facts]
                sizes = [unpacked(f["sizes"]).astype(np.int64) for f in facts]
                flat = np.concatenate([unpacked(f["ids"]) for f in facts] or [np.zeros(0, np.uint32)])
                size_of = np.zeros(max((int(e.max()) for e in entries), default=-1) + 1, np.int64)
                first_of, at = np.zeros_like(size_of), 0
                for e, s in zip(entries, sizes):
                    size_of[e], first_of[e] = s, at + np.cumsum(s) - s
                    at += int(s.sum())
                codes = unpacked(b.column("codes")[i].as_py())
                starts = np.concatenate(([0], np.cumsum(unpacked(b.column("sizes")[i].as_py()).astype(np.int64))))
                if len(codes) and (codes.max() >= len(size_of) or (size_of[codes] == 0).any()):
                    raise ValueError("a word of the block has no ids")
                before = np.concatenate(([0], np.cumsum(size_of[codes])))
                ids = flat[ragged(first_of[codes], size_of[codes])].astype("<u4")
                cuts = before[starts]
                blob = pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer((cuts * 4).tobytes()), pa.py_buffer(ids.tobytes())])
                yield pa.RecordBatch.from_arrays([b.column(id_col)[i].values, pa.array(np.diff(cuts)), blob.cast(pa.binary())], names=out.fieldNames())

    return with_facts(skeletons, facts, ["entries", "sizes", "ids"]).mapInArrow(assemble, out)


def _bytes_of(ids: np.ndarray, ranks_path: str) -> np.ndarray:
    first, size, raw = _token_bytes(ranks_path)
    return raw[ragged(first[ids], size[ids])]


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded`` with ``decoded``: the bytes of each row's ids."""
    out = StructType([*(f for f in encoded.schema if f.name != "decoded"), StructField("decoded", BinaryType())])
    names = out.fieldNames()[:-1]

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                raw = [_bytes_of(np.frombuffer(x.as_buffer(), np.uint32), ranks_path).tobytes() for x in part.column("ids")]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array(raw, pa.binary())], names=[*names, "decoded"])

    return encoded.mapInArrow(run, out)


def digests(decoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id, n_tokens and digests of the ids (decimal, joined by a space) and of the decoded bytes."""
    out = StructType([decoded.schema[id_col], decoded.schema["n_tokens"]])
    out = out.add("ids_sha256", "string").add("decoded_sha256", "string")

    def run(batches):
        for b in batches:
            ids = [hashlib.sha256(" ".join(map(str, np.frombuffer(x.as_buffer(), np.uint32).tolist())).encode()).hexdigest() for x in b.column("ids")]
            raw = [hashlib.sha256(x.as_buffer()).hexdigest() for x in b.column("decoded")]
            yield pa.RecordBatch.from_arrays([b.column(id_col), b.column("n_tokens"), pa.array(ids), pa.array(raw)], names=out.fieldNames())

    return decoded.mapInArrow(run, out)


def op6_distinct_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digests(decode(encode(docs, path, public_tokenizers.PATTERN), path))
