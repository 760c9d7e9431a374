"""Sets of 5-word shingles, their MinHash signatures, and exact Jaccard similarity."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from loglake.llm.text import hashes, mix, window_hashes, word_codes

WORDS = 5
_CHUNK = 1 << 16


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(starts, hashes): the sorted distinct shingles of each text; a text of 1 to 4 words is one shingle."""
    starts, codes, words = word_codes(texts)
    word_hash = hashes(words)[codes] if len(codes) else np.zeros(0, np.uint64)
    owner, value = window_hashes(starts, word_hash, WORDS)
    n = np.diff(starts)
    short = np.flatnonzero((n > 0) & (n < WORDS))
    if len(short):
        extra = np.zeros(len(short), np.uint64)
        with np.errstate(over="ignore"):
            for j, i in enumerate(short):
                for h in word_hash[starts[i] : starts[i + 1]]:
                    extra[j] = extra[j] * np.uint64(0x9E3779B97F4A7C15) + h + np.uint64(1)
        owner, value = np.concatenate((owner, short)), np.concatenate((value, mix(extra)))
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(value), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    owner, value = owner[new], value[new]
    return np.searchsorted(owner, np.arange(len(texts) + 1)), value


def signatures(starts: np.ndarray, values: np.ndarray, size: int, seed: int = 1) -> np.ndarray:
    """(texts, size) minima of ``size`` multiplicative hashes of each text's shingles; 0 for a text without any."""
    factors = mix(np.arange(1, size + 1, dtype=np.uint64) + np.uint64(seed << 32)) | np.uint64(1)
    out = np.zeros((len(starts) - 1, size), np.uint64)
    full = np.flatnonzero(np.diff(starts))
    if not len(full):
        return out
    first = starts[full]
    for k in range(size):
        # high bits of a product depend on all bits below them, so the product alone orders like a random hash
        out[full, k] = np.minimum.reduceat(values * factors[k], first)
    return out
