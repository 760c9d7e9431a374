"""Word splitting over Arrow batches, and the helper that adds columns to a DataFrame batch by batch.

Everything here works on one Arrow batch at a time; nothing depends on which rows share a batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

#: bytes of text that a helper treats at once; a longer text is treated whole, alone
SLICE_BYTES = 8 << 20


def texts_of(column) -> pa.Array:
    """A string column as large_string, null as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def utf8_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets) of a large_string array without nulls."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def list_starts(lists: pa.Array) -> np.ndarray:
    starts = lists.offsets.to_numpy().astype(np.int64)
    return starts - starts[0]


def coded(starts: np.ndarray, flat: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Dictionary codes of the strings of a list array without its empty strings: (starts, codes, words)."""
    encoded = flat.dictionary_encode()
    codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int32)
    words = encoded.dictionary
    empty = pc.index(words, pa.scalar("", words.type)).as_py()
    if empty >= 0:
        full = codes != empty
        starts = np.concatenate(([0], np.cumsum(full)))[starts]
        codes = codes[full]
    return starts, codes, words


def word_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text: text i has codes[starts[i]:starts[i+1]], indexes into words.

    ``words`` may hold an empty string that no code refers to.
    """
    lists = pc.ascii_split_whitespace(texts)
    return coded(list_starts(lists), lists.flatten())


def hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each string, the same on every machine."""
    if not len(words):
        return np.zeros(0, np.uint64)
    return pd.util.hash_array(words.to_numpy(zero_copy_only=False).astype(object), categorize=False)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads 64-bit integers evenly."""
    x = x.astype(np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(starts: np.ndarray, word_hash: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(text index, hash) of every run of ``width`` words inside one text, in order of position.

    The position of a window's first word is ``np.flatnonzero`` of the same condition.
    """
    n = len(word_hash)
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    if n < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    out = np.zeros(n - width + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(width):
            out = out * np.uint64(0x9E3779B97F4A7C15) + word_hash[i : n - width + 1 + i]
    whole = owner[: n - width + 1] == owner[width - 1 :]
    return owner[: n - width + 1][whole], mix(out[whole])


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts hold about ``limit`` bytes."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    run = np.cumsum(sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def kept_fields(df: DataFrame, added: StructType) -> list:
    taken = {f.name.lower() for f in added}
    return [f for f in df.schema if f.name.lower() not in taken]


def add_columns(df: DataFrame, text_col: str, make: Callable[[pa.RecordBatch], list], added: StructType) -> DataFrame:
    """``df`` with the columns that ``make`` gives for each batch.

    A column of ``df`` with the name of an added one gives way to it; all others stay.
    """
    kept = kept_fields(df, added)
    names = [f.name for f in kept]
    out = StructType([*kept, *added])

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_col):
                made = make(part)
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), *made], names=out.fieldNames())

    return df.mapInArrow(run, out)


