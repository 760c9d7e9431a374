import hashlib

import numpy as np
import public_tokenizers
import tiktoken

from loglake.llm.blocks import packed, unpacked
from loglake.llm.bpe import decode, encode, op6_distinct_word_bpe, ranks_of

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks_of(PATH), special_tokens={})


def test_packed_numbers_round_trip():
    for top in (1, 255, 256, 70_000, 2**32):
        x = np.random.default_rng(0).integers(0, top, 1000)
        assert (unpacked(packed(x)) == x).all()
    assert len(unpacked(packed(np.zeros(0, np.int64)))) == 0


def test_query_equals_tiktoken(spark, small, texts):
    own, got = reference(), {r["doc_id"]: tuple(r)[1:] for r in op6_distinct_word_bpe(spark, small).collect()}
    assert len(got) == len(texts)
    for doc, text in texts:
        ids = own.encode_ordinary(text or "")
        assert got[doc] == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())


def test_odd_tables(odd, none):
    own = reference()
    rows = decode(encode(odd, PATH, public_tokenizers.PATTERN), PATH).collect()
    key = lambda r: (str(r[0]), r[1])
    got = sorted(((r["doc_id"], bytes(r["decoded"]).decode(), np.frombuffer(r["ids"], "<u4").tolist()) for r in rows), key=key)
    want = sorted(((r["doc_id"], r["text"] or "", own.encode_ordinary(r["text"] or "")) for r in odd.collect()), key=key)
    assert got == want
    assert decode(encode(none, PATH, public_tokenizers.PATTERN), PATH).count() == 0
