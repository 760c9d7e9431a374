"""Quality rules, line first: rules look at each line, failing lines go, and a text that loses too much goes whole.

A line (text between ``\\n``) with a word fails if

* navigation: at least 3 ``|`` signs stand alone or end words, and they are 20 % of its words or more,
* symbols: its characters of ``[#*$%&|<>]`` are over 10 % of the characters in its words,
* shouting: it has 3 words or more, and over half of all are upper case throughout (2 letters or more) and exclaim,
* repetition: over half of its words lie in 8-word windows that occurred before in the text, or equal the word before,
* copy: it equals an earlier line of the text,
* punctuation: it has ``LONG_LINE`` words or more and no sentence end anywhere,
* boilerplate: it is at most 30 words long and holds a phrase of ``BOILERPLATE``.

Lines without words stay. The text is rejected if the failing lines hold more than ``max_lost`` of its word characters,
or if the whole-text rules fail (under 20 words, or over 30 % of words in repeated 8-word windows).

Null text counts as empty: no words, rejected. Repeated rows and equal texts get equal results. No row is dropped here.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField, StructType

from loglake.llm.text import add_columns, hashes, list_starts, texts_of, window_hashes, word_codes

WINDOW = 8
MIN_WORDS = 20
LONG_LINE = 60
MAX_LOST = 0.5
BOILERPLATE = (
    "all rights reserved", "terms of service", "terms of use", "privacy policy", "cookie policy", "accept cookies",
    "licensed under", "spdx-license-identifier", "subscribe to our", "sign up for", "log in to", "click here",
    "enable javascript", "share this", "read more",
)

ADDED = StructType([
    StructField("n_words", LongType()), StructField("word_chars", LongType()), StructField("n_symbols", LongType()),
    StructField("n_dup_lines", LongType()), StructField("n_repeat_words", LongType()),
    StructField("base_failed", BooleanType()), StructField("n_lines", LongType()),
    StructField("n_bad_lines", LongType()), StructField("lost_share", DoubleType()),
    StructField("kept", BooleanType()), StructField("clean_text", StringType()),
])


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[starts[1:]] - total[starts[:-1]]


def _repeated(starts: np.ndarray, word_hash: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which words lie in a window that its text holds twice or more, and which in one that it held before."""
    n = len(word_hash)
    marks, again = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
    owner, windows = window_hashes(starts, word_hash, WINDOW)
    if len(windows):
        place = np.concatenate([np.arange(a, b - WINDOW + 1) for a, b in zip(starts[:-1], starts[1:]) if b - a >= WINDOW])
        order = np.lexsort((windows, owner))
        o, w = owner[order], windows[order]
        same = (o[1:] == o[:-1]) & (w[1:] == w[:-1])
        later = np.concatenate(([False], same))
        twice = later | np.concatenate((same, [False]))
        for found, covered in ((twice, marks), (later, again)):
            at = place[order[found]]
            np.add.at(covered, at, 1)
            np.add.at(covered, at + WINDOW, -1)
    return np.cumsum(marks[:n]) > 0, np.cumsum(again[:n]) > 0


def _dup_lines(doc_of_line: np.ndarray, line_hash: np.ndarray, has_word: np.ndarray) -> np.ndarray:
    """Which lines with a word equal an earlier line of their text."""
    out = np.zeros(len(line_hash), bool)
    idx = np.flatnonzero(has_word)
    if len(idx):
        order = idx[np.lexsort((idx, line_hash[idx], doc_of_line[idx]))]
        out[order[1:]] = (line_hash[order[1:]] == line_hash[order[:-1]]) & (doc_of_line[order[1:]] == doc_of_line[order[:-1]])
    return out


def judge(texts: pa.Array, max_lost: float = MAX_LOST) -> list:
    """The added columns for an array of texts."""
    by_text = pc.split_pattern(texts, "\n")
    lines = by_text.flatten()
    line_starts = list_starts(by_text)
    n_docs, n_lines = len(texts), np.diff(line_starts)
    doc_of_line = np.repeat(np.arange(n_docs), n_lines)
    starts, codes, words = word_codes(lines)
    doc_starts = starts[line_starts]

    lower, upper = pc.utf8_lower(words), pc.utf8_upper(words)
    loud = pc.and_(pc.and_(pc.equal(words, upper), pc.not_equal(words, lower)), pc.match_substring_regex(words, r"!\W*$"))
    of_word = lambda a: a.to_numpy(zero_copy_only=False).astype(np.int64)[codes]
    chars = of_word(pc.utf8_length(words))
    symbols = of_word(pc.count_substring_regex(words, r"[#*$%&|<>]"))
    pipes = of_word(pc.match_substring_regex(words, r"\|$"))
    loud = of_word(loud)
    stops = of_word(pc.match_substring_regex(words, r"[.!?…。][^\w\s]*$"))
    repeated, before = _repeated(doc_starts, hashes(words)[codes])
    echo = np.concatenate(([False], codes[1:] == codes[:-1]))[: len(codes)]
    echo[starts[:-1][np.diff(starts) > 0]] = False

    l_words, l_chars = np.diff(starts), _sums(chars, starts)
    l_symbols, l_pipes = _sums(symbols, starts), _sums(pipes, starts)
    has_word = l_words > 0
    copy = _dup_lines(doc_of_line, hashes(lines), has_word)
    phrase = pc.match_substring_regex(lines, "|".join(BOILERPLATE), ignore_case=True).to_numpy(zero_copy_only=False)
    bad = has_word & (
        ((l_pipes >= 3) & (l_pipes * 5 >= l_words))
        | (l_symbols * 10 > l_chars)
        | ((l_words >= 3) & (_sums(loud, starts) * 2 > l_words))
        | (_sums(before, starts) * 2 > l_words)
        | (_sums(echo, starts) * 2 > l_words)
        | copy
        | ((l_words >= LONG_LINE) & (_sums(stops, starts) == 0))
        | ((l_words <= 30) & phrase.astype(bool))
    )
    n_words, word_chars = np.diff(doc_starts), _sums(l_chars, line_starts)
    n_repeat = _sums(repeated, doc_starts)
    base_failed = (n_words < MIN_WORDS) | (100 * n_repeat > 30 * n_words)
    lost = _sums(np.where(bad, l_chars, 0), line_starts)
    share = lost / np.maximum(word_chars, 1)
    kept = ~base_failed & (share <= max_lost)

    good = lines.filter(pa.array(~bad))
    left = np.concatenate(([0], np.cumsum(_sums(~bad, line_starts))))
    clean = pc.binary_join(pa.ListArray.from_arrays(pa.array(left, pa.int32()), good), pa.scalar("\n", pa.large_string()))
    return [
        pa.array(n_words), pa.array(word_chars), pa.array(_sums(l_symbols, line_starts)),
        pa.array(_sums(copy, line_starts)), pa.array(n_repeat), pa.array(base_failed), pa.array(n_lines),
        pa.array(_sums(bad, line_starts)), pa.array(share), pa.array(kept), clean.cast(pa.string()),
    ]


def quality_rules(df: DataFrame, text_col: str = "text", max_lost: float = MAX_LOST) -> DataFrame:
    """``df`` with base figures, verdict ``kept`` and the text without its failing lines (``clean_text``)."""
    return add_columns(df, text_col, lambda b: judge(texts_of(b.column(text_col)), max_lost), ADDED)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return quality_rules(docs).select("doc_id", *ADDED.fieldNames()[:-1], F.sha2("clean_text", 256).alias("clean_sha256"))
