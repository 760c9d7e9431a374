import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from loglake.llm.tokens import WordEncoder
from loglake.llm.wavelet import WaveletMatrix, op3_wavelet_tokens, read_documents, shard_starts, write_token_shards

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("n, top", [(0, 1), (1, 1), (7, 3), (5000, 40), (3000, 49_408), (2000, 1 << 20)])
def test_matrix_against_plain_sequence(n, top):
    ids = np.random.default_rng(n).integers(0, top, n).astype(np.uint32)
    m = WaveletMatrix.from_bytes(WaveletMatrix.build(ids).to_bytes())
    assert (m.sequence() == ids).all()
    for i in range(0, n, max(1, n // 50)):
        v = int(ids[i])
        at = np.flatnonzero(ids == v)
        assert m.access(i) == v
        assert m.count(v) == len(at) and m.count(v, i) == (at < i).sum()
        assert [m.select(v, j) for j in range(min(3, len(at)))] == at[:3].tolist()
    assert m.count(1 << 25) == 0
    if n:
        with pytest.raises(IndexError):
            m.select(int(ids[0]), n)


def test_words_encode_as_whole_texts(tokenizer):
    import random

    import pyarrow as pa

    r = random.Random(3)
    bits = ["a", "B", "é", "é", "́", " ", "\n", "\t", "\x0b", "\x1c", " ", "　", "'s", "'", "<|endoftext|>", "<|startoftext|>", "<|", "1", "٣", "Σ", "İ", "ß", "...", "!", "漢", "👍", "‍", "ﬁ", "Å", "'LL", "_", ",", "½", "Ⅷ", "ª"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 14))) for _ in range(20_000)]
    starts, ids = WordEncoder(PATH).encode(pa.array(texts, pa.large_string()), 2)
    want = [e.ids + [2] for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == want


def test_query_against_tokenizer(spark, small, texts, tokenizer):
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in op3_wavelet_tokens(spark, small).collect()}
    at = 0
    for doc, text in sorted(texts):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        assert got[doc] == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_odd_tables_and_small_shards(odd, none, tokenizer):
    shards = write_token_shards(odd, PATH, shard_tokens=20)
    rows = read_documents(shards).join(shard_starts(shards), ["run", "shard"]).collect()
    assert len(rows) == odd.count() and shards.count() > 3
    want = sorted(((r["doc_id"], tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [2]) for r in odd.collect()), key=str)
    assert sorted(((r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in rows), key=str) == want
    rows.sort(key=lambda r: r["shard_start"] + r["offset"])
    ids = [r["doc_id"] for r in rows]
    assert ids == [None, None, *sorted(i for i in ids if i is not None)]
    at = 0
    for r in rows:
        assert r["shard_start"] + r["offset"] == at
        at += r["n_tokens"]
    assert read_documents(write_token_shards(none, PATH)).count() == 0
