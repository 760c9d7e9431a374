"""Exact token counts of every prefix of a text, by dynamic programming over prefixes.

A byte-pair encoding is right exactly if each pair of neighbours in it is: the two tokens' bytes, encoded alone, give the
two tokens back. So of all tokens that end a prefix, one fits behind the encoding of the prefix before it, and

    count[p] = count[p - len(t)] + 1,   t the one token that ends at p and follows last[p - len(t)].

The table ``(last, count)`` is kept for the prefixes of pre-tokens and shared by all words that begin alike. Counts of a
text's prefixes are those of its pre-tokens, one after the other, except where a cut text splits otherwise than the
whole one:

* in a run of white space before a word, the whole run is one pre-token if the text ends there;
* ``'re``, ``'ve`` and ``'ll`` are one pre-token, ``'r``, ``'v`` and ``'l`` are two;
* a special token is one token, its beginnings are ordinary text.

``prefix_counts`` stores the counts of all prefixes (in code points) of each row as differences in one compressed
value; ``counted`` and ``truncated`` answer from it how many tokens a text has, whether it meets a budget, and what its
longest prefix within the budget is, without encoding anything again. Counts may fall from a prefix to the next (a word's
end can merge what stood apart), so the longest prefix within a budget is the last one whose count is within it.

Null text counts as empty: no prefixes, no tokens. Texts of any length are treated whole. Repeated rows are counted as any
other, an empty table gives an empty result, extra columns stay (but for those with the names of new ones).
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, LongType, StringType, StructType

from loglake.llm.blocks import ragged
from loglake.llm.text import add_columns, texts_of

PREFIX_COUNTS = "prefix_counts"
#: words and pairs of tokens that a worker process remembers; this only saves time
MEMORY_WORDS, MEMORY_PAIRS = 300_000, 1_000_000
#: longer pre-tokens are not remembered
SHORT_BYTES = 32

# The pre-tokens of byte-level tokenizers, and the contractions that are longer than two characters.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CONTRACTIONS = ("'re", "'ve", "'ll")
#: code points on which every edition of Unicode agrees what is a letter or a number; others are split by the library
_AGREED = re.compile("[^\0-ԯ]")


def _byte_names() -> dict[int, str]:
    """The printable character that stands for each byte in the vocabulary of a byte-level tokenizer."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(others)}


class PrefixTable:
    """The dynamic programme over the prefixes of pre-tokens, for one tokenizer file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.splitter = self.tokenizer.pre_tokenizer
        added = self.tokenizer.get_added_tokens_decoder()
        plain = all(not (t.lstrip or t.rstrip or t.single_word) for t in added.values())
        if type(self.splitter).__name__ != "ByteLevel" or self.splitter.add_prefix_space or self.tokenizer.normalizer is not None or not plain:
            raise ValueError(f"{path} is not a plain byte-level tokenizer")
        self.special = sorted((t.content for t in added.values()), key=len, reverse=True)
        self.at_special = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        names = _byte_names()
        byte_of = {c: b for b, c in names.items()}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.names = {i: t for t, i in vocabulary.items()}
        ids = {bytes(byte_of[c] for c in t): i for t, i in vocabulary.items() if t not in self.special}
        # what a token can end with: the id of the token that it is, or -1
        self.endings = {t[i:]: -1 for t in ids for i in range(len(t))} | ids
        self.pattern = regex.compile(PATTERN)
        self.blanks = frozenset(regex.findall(r"\s", "".join(map(chr, range(0xD800)))))
        self.pairs: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}

    def _stands(self, left: int, right: int) -> bool:
        """Whether the bytes of the two tokens (left -1: of the right one alone), encoded, give just these tokens."""
        want = [right] if left < 0 else [left, right]
        got = [t.id for t in self.tokenizer.model.tokenize("".join(self.names[i] for i in want))] == want
        if len(self.pairs) < MEMORY_PAIRS:
            self.pairs[(left << 32) | right] = got
        return got

    def _of_bytes(self, words: list[bytes]) -> list[list[int]]:
        """Token counts of the first 0, 1, 2, ... bytes of each pre-token. In ascending order of the words, the states
        of a beginning that a word shares with the one before it are still there."""
        ending, pair = self.endings.get, self.pairs.get
        out, before, last, count = [], b"", [-1], [0]
        for word in words:
            same, most = 0, min(len(before), len(word))
            while same < most and before[same] == word[same]:
                same += 1
            del last[same + 1 :], count[same + 1 :]
            for p in range(same + 1, len(word) + 1):
                for a in range(p - 1, -1, -1):
                    token = ending(word[a:p])
                    if token is None:
                        raise ValueError(f"no token of the vocabulary ends {word[:p]!r}")
                    if token >= 0:
                        left = last[a]
                        stands = pair((left << 32) | token)
                        if self._stands(left, token) if stands is None else stands:
                            last.append(token)
                            count.append(count[a] + 1)
                            break
                else:
                    raise ValueError(f"no token of the vocabulary ends {word[:p]!r}")
            out.append(count[:])
            before = word
        return out

    def of_words(self, words: list[str]) -> list[bytes]:
        """For each pre-token that stands at the end of a text, the token counts (32-bit) of its first 1, 2, ... code points."""
        known = self.known
        out = [known.get(w) for w in words]
        new = sorted((w.encode(), i) for i, w in enumerate(words) if out[i] is None)
        for (raw, i), counts in zip(new, self._of_bytes([raw for raw, _ in new])):
            word = words[i]
            if len(raw) != len(word):
                counts = [c for c, after in zip(counts, raw) if after & 0xC0 != 0x80] + counts[-1:]
            if word in CONTRACTIONS:
                counts[2] = counts[1] + 1  # the letter alone is a pre-token and a token
            out[i] = array("i", counts[1:]).tobytes()
            if len(known) < MEMORY_WORDS and len(raw) <= SHORT_BYTES:
                known[word] = out[i]
        return out

    def split(self, text: str) -> list[str]:
        """The pre-tokens of a text without special tokens."""
        if _AGREED.search(text) is None:
            return self.pattern.findall(text)
        return [text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text)]

    def _rows(self, rows: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(starts, counts of all prefixes) of texts without special tokens."""
        sizes, held, chunks = [], [], []
        for text in rows:
            found = self.split(text)
            sizes.append(len(found))
            held += found
            if len(held) >= 50_000:  # as Python strings for a short while only
                chunks.append(pa.array(held, pa.large_string()))
                held = []
        chunks.append(pa.array(held, pa.large_string()))
        encoded = pa.concat_arrays(chunks).dictionary_encode()
        codes, words = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), encoded.dictionary.to_pylist()
        tables = self.of_words(words)
        size = np.fromiter(map(len, tables), np.int64, len(tables)) // 4
        flat = np.frombuffer(b"".join(tables), np.int32)
        last = flat[np.cumsum(size) - 1] if len(tables) else flat
        row = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
        total = np.concatenate(([0], np.cumsum(last[codes], dtype=np.int64)))
        base = total[:-1] - np.repeat(total[row[:-1]], np.diff(row))
        chars = size[codes]
        at = np.concatenate(([0], np.cumsum(chars)))
        out = (flat[ragged((np.cumsum(size) - size)[codes], chars)] + np.repeat(base, chars)).astype(np.int32)

        # a text that ends with the first character after white space, itself white space: one run
        opens = np.fromiter((w[0] in self.blanks for w in words), bool, len(words))
        blank = opens & np.fromiter((w[-1] in self.blanks for w in words), bool, len(words))  # its characters are of one kind
        next_to = blank[codes[:-1]] & opens[codes[1:]]
        next_to[row[(row > 0) & (row < len(codes))] - 1] = False
        pairs = np.flatnonzero(next_to)
        if len(pairs):
            key, which = np.unique(codes[pairs] * len(words) + codes[pairs + 1], return_inverse=True)
            runs = self.of_words([words[k // len(words)] + words[k % len(words)][0] for k in key])
            out[at[pairs + 1]] = base[pairs] + np.array([np.frombuffer(r, np.int32)[-1] for r in runs], np.int64)[which]
        return at[row], out

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(starts, counts): the prefixes of text i, by length in code points from 1, have counts[starts[i]:starts[i+1]] tokens."""
        rows, plan = [], []  # plan: for each text its (row, code points before a special token, length of that token)
        for text in texts:
            parts, a = [], 0
            for m in self.at_special.finditer(text) if self.at_special else ():
                rows.append(text[a : m.end() - 1])  # with the beginnings of the special token
                parts.append((len(rows) - 1, m.start() - a, m.end() - m.start()))
                a = m.end()
            rows.append(text[a:])
            parts.append((len(rows) - 1, len(text) - a, 0))
            plan.append(parts)
        starts, flat = self._rows(rows)
        if len(rows) == len(texts):
            return starts, flat
        out = []
        for parts in plan:
            base, own = 0, []
            for i, before, special in parts:
                c = flat[starts[i] : starts[i + 1]] + base
                base = (int(c[before - 1]) if before else base) + (1 if special else 0)
                own += [c, np.full(1, base, np.int32)] if special else [c]
            out.append(np.concatenate(own))
        return np.concatenate(([0], np.cumsum([len(c) for c in out]))), np.concatenate([*out, np.zeros(0, np.int32)])


@lru_cache(maxsize=2)
def prefix_table(path: str) -> PrefixTable:
    """One table for each worker process and file."""
    return PrefixTable(path)


def packed_counts(counts: np.ndarray, tool=zstandard.ZstdCompressor(level=1)) -> bytes:
    """Differences from each count to the next, in one byte each if all fit, compressed."""
    steps = np.diff(counts, prepend=0)
    narrow = not len(steps) or (steps.min() >= -128 and steps.max() < 128)
    return (b"\1" if narrow else b"\4") + tool.compress(steps.astype("<i1" if narrow else "<i4").tobytes())


def unpacked_counts(blob: bytes) -> np.ndarray:
    """The token counts of the prefixes of 1, 2, ... code points."""
    steps = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[1:]), "<i1" if blob[0] == 1 else "<i4")
    return np.cumsum(steps, dtype=np.int64)


def prefix_counts(df: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``df`` with ``prefix_counts``: the packed token counts of all prefixes of the text (``unpacked_counts``)."""

    def make(batch):
        starts, flat = prefix_table(path).counts(texts_of(batch.column(text_col)).to_pylist())
        return [pa.array([packed_counts(flat[a:b]) for a, b in zip(starts, starts[1:])], pa.binary())]

    return add_columns(df, text_col, make, StructType().add(PREFIX_COUNTS, BinaryType()))


def counted(df: DataFrame, limit: int) -> DataFrame:
    """From stored prefix counts: ``n_tokens``, ``over_limit``, and ``fits_chars``, the length in code points of the longest
    prefix of at most ``limit`` tokens."""
    added = StructType().add("n_tokens", LongType()).add("over_limit", BooleanType()).add("fits_chars", LongType())

    def make(batch):
        n, fits = [], []
        for blob in batch.column(PREFIX_COUNTS):
            c = unpacked_counts(blob.as_py())
            within = np.flatnonzero(c <= limit)
            n.append(int(c[-1]) if len(c) else 0)
            fits.append(int(within[-1]) + 1 if len(within) else 0)
        n = pa.array(n, pa.int64())
        return [n, pc.greater(n, limit), pa.array(fits, pa.int64())]

    return add_columns(df, PREFIX_COUNTS, make, added)


def truncated(df: DataFrame, limit: int, text_col: str = "text") -> DataFrame:
    """``counted`` rows with ``truncated_text``, the longest prefix of at most ``limit`` tokens (null text: empty)."""
    text = F.coalesce(F.col(text_col).cast(StringType()), F.lit(""))
    return counted(df, limit).withColumn("truncated_text", F.substring(text, F.lit(1), F.col("fits_chars").cast("int")))


def within_budgets(df: DataFrame, budgets: list[int]) -> DataFrame:
    """From stored prefix counts: ``budget_chars``, the longest fitting prefix for each of ``budgets``, in their order."""
    from pyspark.sql.types import ArrayType

    def make(batch):
        rows = []
        for blob in batch.column(PREFIX_COUNTS):
            c = unpacked_counts(blob.as_py())
            least = np.minimum.accumulate(c[::-1])[::-1]  # of a prefix and all longer ones: ascending
            rows.append(np.searchsorted(least, budgets, side="right").tolist())
        return [pa.array(rows, pa.list_(pa.int64()))]

    return add_columns(df, PREFIX_COUNTS, make, StructType().add("budget_chars", ArrayType(LongType())))


def op11_prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    stored = prefix_counts(docs, public_tokenizers.path("byte_bpe_50k.json")).select("doc_id", n_bytes, PREFIX_COUNTS)
    return counted(stored, 512).select("doc_id", "n_bytes", "n_tokens", "over_limit", "fits_chars")
