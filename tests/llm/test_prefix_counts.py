import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from loglake.llm.prefix_counts import (
    PREFIX_COUNTS,
    counted,
    op11_prefix_token_counts,
    packed_counts,
    prefix_counts,
    prefix_table,
    truncated,
    unpacked_counts,
    within_budgets,
)

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["the", " the", "  ", " ", "\n", "\t", "　", "'re", "'ll", "'s", "'", "l", "é", "漢字", "👍", "<|endoftext|>", "<|endo", "1", " 23", "!?", "ing", " ", "A", "՘", "zzqx"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def brute(library, text):
    return [len(library.encode(text[:p], add_special_tokens=False).ids) for p in range(1, len(text) + 1)]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=14).map("".join))
def test_every_prefix_equals_the_library(text):
    starts, got = prefix_table(PATH).counts([text])
    assert got.tolist() == brute(_LIBRARY, text) and starts.tolist() == [0, len(text)]


_LIBRARY = Tokenizer.from_file(PATH)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=30))
def test_any_text(text):
    assert prefix_table(PATH).counts([text])[1].tolist() == brute(_LIBRARY, text)


def test_many_texts_at_once(library):
    rng = random.Random(1)
    texts = ["".join(rng.choices(PARTS, k=rng.randrange(12))) for _ in range(200)]
    starts, flat = prefix_table(PATH).counts(texts)
    for i, text in enumerate(texts):
        assert flat[starts[i] : starts[i + 1]].tolist() == brute(library, text), text


def test_packed_counts_round_trip():
    for counts in ([], [1, 1, 2, 1, 3], [5, 5000, 1, 70_000]):
        assert unpacked_counts(packed_counts(np.array(counts, np.int32))).tolist() == counts


def test_query_equals_the_library(spark, small, texts, library):
    got = {r["doc_id"]: r for r in op11_prefix_token_counts(spark, small).collect()}
    assert len(got) == len(texts)
    for doc, text in texts:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        r = got[doc]
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len((text or "").encode()), n, n > 512)
        if r["over_limit"]:
            assert len(library.encode(text[: r["fits_chars"]], add_special_tokens=False).ids) <= 512
            assert len(library.encode(text[: r["fits_chars"] + 1], add_special_tokens=False).ids) > 512
        else:
            assert r["fits_chars"] == len(text or "")


def test_budgets_without_encoding(spark, texts, library):
    some = [t for t in texts if len(t[1]) < 600][:6]
    stored = prefix_counts(spark.createDataFrame(some, "doc_id long, text string"), PATH)
    for r in within_budgets(stored, [0, 1, 7, 50]).collect():
        every = brute(library, r["text"])
        assert r["budget_chars"] == [max((p + 1 for p, c in enumerate(every) if c <= b), default=0) for b in (0, 1, 7, 50)]
    for r in truncated(stored, 9).collect():
        assert len(library.encode(r["truncated_text"], add_special_tokens=False).ids) <= 9


def test_odd_tables(odd, none, library):
    rows = counted(prefix_counts(odd, PATH), 512).collect()
    assert len(rows) == odd.count() and {"kept", "rank", "start", PREFIX_COUNTS} <= set(rows[0].asDict())
    for r in rows:
        assert r["n_tokens"] == len(library.encode(r["text"] or "", add_special_tokens=False).ids)
    assert counted(prefix_counts(none, PATH), 512).count() == 0
