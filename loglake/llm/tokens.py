"""Token ids of whole texts, encoded with the tokenizers library through each batch's distinct words.

For a tokenizer whose pre-tokens never hold white space and that drops white space (the word tokenizer here), the ids of
a text are the ids of its ASCII-white-space-separated words in a row, so each distinct word is encoded once. Words that
were encoded before come from a bounded table in the worker process; the table only saves time.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from loglake.llm.blocks import ragged
from loglake.llm.text import utf8_bytes, word_codes

#: the letter left out is the one whose lower case ends in a mark
_MARKS = ".,!?;:"
_ENDING = re.compile(rf"(.*[^\W_\u0130])([{_MARKS}]+)", re.S)
#: words whose ids a worker process remembers
MEMORY_WORDS = 400_000


#: the printable characters that stand for the bytes of Latin letters in the vocabulary of a byte-level tokenizer
_BYTES = {b: 0x100 + n for n, b in enumerate(b for b in range(256) if not (0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE))}


def _model_form(word: str) -> str:
    """A word of Latin letters as the tokenizer's model gets it: in lower case, one character for each byte."""
    low = word.lower()
    return low if low.isascii() else low.encode().decode("latin-1").translate(_BYTES)


class WordEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.memory: dict[str, bytes] = {}
        # the bytes of lower-cased Latin letters are what the model sees of such a word, if the file's answers say so
        probe = ["q", *("".join(map(chr, range(a, a + 16))) for a in (*range(0x41, 0x51, 5), *range(0x61, 0x6B, 5), 0xC0, 0xD8, 0xE0, 0xE7))]
        self.direct = all([t.id for t in self.tokenizer.model.tokenize(_model_form(w))] == self.tokenizer.encode(w, add_special_tokens=False).ids for w in probe if w.isalpha())

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(sizes, ids): the number of ids of each word (large_string, no nulls), and all ids in a row.

        Punctuation after a letter or digit is a pre-token by itself, so a word and its end are encoded apart.
        """
        raw, at = utf8_bytes(words)
        last = np.zeros(len(words), np.uint8)
        full = np.diff(at) > 0
        last[full] = raw[at[1:][full] - 1]
        marked = np.flatnonzero(np.isin(last, np.frombuffer(_MARKS.encode(), np.uint8)))
        parts = [_ENDING.fullmatch(w) for w in words.take(pa.array(marked)).to_pylist()]
        marked, parts = marked[[m is not None for m in parts]], [m for m in parts if m is not None]
        mask = np.zeros(len(words), bool)
        mask[marked] = True
        cores = pc.replace_with_mask(words, pa.array(mask), pa.array([m[1] for m in parts], pa.large_string())).dictionary_encode()
        ends = {e: i for i, e in enumerate(dict.fromkeys(m[2] for m in parts))}
        blobs = self._distinct(cores.dictionary.to_pylist())
        end_at = len(blobs)
        blobs += [*self._distinct(list(ends)), b""]
        piece_size = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4
        piece_flat = np.frombuffer(b"".join(blobs), np.uint32)
        # each word is two pieces: its core, and its end or nothing
        piece = np.full((len(words), 2), len(blobs) - 1)
        piece[:, 0] = cores.indices.to_numpy(zero_copy_only=False)
        piece[marked, 1] = [end_at + ends[m[2]] for m in parts]
        piece = piece.ravel()
        sizes = piece_size[piece]
        return sizes.reshape(-1, 2).sum(axis=1), piece_flat[ragged((np.cumsum(piece_size) - piece_size)[piece], sizes)]

    def _distinct(self, words: list[str]) -> list[bytes]:
        known = self.memory
        out = [known.get(w) for w in words]
        new = [i for i, ids in enumerate(out) if ids is None]
        rest = []
        for i in new:
            word = words[i]
            if self.direct and word.isalpha() and (word.isascii() or max(word) <= "ÿ"):  # one pre-token
                out[i] = np.array([t.id for t in self.tokenizer.model.tokenize(_model_form(word))], np.uint32).tobytes()
            else:
                rest.append(i)
        for a in range(0, len(rest), 20_000):
            part = rest[a : a + 20_000]
            for i, e in zip(part, self.tokenizer.encode_batch_fast([words[i] for i in part], add_special_tokens=False)):
                out[i] = np.array(e.ids, np.uint32).tobytes()
        for i in new[: max(0, MEMORY_WORDS - len(known))]:
            known[words[i]] = out[i]
        return out

    def encode(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(starts, ids): text i has ids[starts[i]:starts[i+1]], ``end`` after each text if given."""
        starts, codes, words = word_codes(texts)
        size, flat = self.words(words.cast(pa.large_string()))
        if end is not None:  # a word more, after each text
            codes = np.insert(codes, starts[1:], len(size))
            size, flat = np.append(size, 1), np.append(flat, np.uint32(end))
            starts = starts + np.arange(len(starts))
        per_word = size[codes]
        before = np.concatenate(([0], np.cumsum(per_word)))
        return before[starts], flat[ragged((np.cumsum(size) - size)[codes], per_word)]


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    """One encoder for each worker process and file."""
    return WordEncoder(path)
