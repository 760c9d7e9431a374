import hashlib

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from loglake.llm.chat import OP1_SQL, digests, escape, format_chats, op1_chat_format, read_back, render, token_mask, unescape

pieces = st.lists(st.sampled_from(["\\", "###", "#", "</turn>", "</", "turn>", " ", "\n", ": ", "### Assistant: ", "x", "é", "👍", ""])).map("".join)


@settings(deadline=None, max_examples=200)
@given(st.lists(st.tuples(pieces, pieces), max_size=5))
def test_render_and_read_back(turns):
    formatted, spans = render(turns)
    assert read_back(formatted) == turns
    assert [unescape(formatted[a:b]) for a, b in spans] == [t for _, t in turns]
    assert all(unescape(escape(t)) == t for _, t in turns)


def test_token_mask_is_the_overlap():
    rng = np.random.default_rng(1)
    for _ in range(200):
        cuts = np.unique(rng.integers(0, 60, 12))
        starts, ends = cuts[:-1], cuts[1:]
        twice = rng.random(len(starts)) < 0.3  # several tokens of one code point
        starts, ends = np.repeat(starts, 1 + twice), np.repeat(ends, 1 + twice)
        edges = np.unique(rng.integers(0, 60, 6))
        spans = [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2])]
        mask, covered = token_mask(starts, ends, spans)
        assert mask.tolist() == [int(any(s < b and e > a for a, b in spans)) for s, e in zip(starts, ends)]
        assert all(a <= c and d <= b for c, d in covered for a, b in spans if c < b and d > a)


def test_query_matches_sql(spark, small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{small}/conversations.parquet')")
    cur = con.execute(OP1_SQL)
    names = [d[0] for d in cur.description]
    want = sorted(cur.fetchall())
    assert sorted(tuple(r) for r in op1_chat_format(spark, small).select(*names).collect()) == want
    assert any(r[0] == -7 for r in want)


def test_odd_conversations(spark):
    import public_tokenizers

    rows = [
        (1, 2, "assistant", "second", "x"), (1, 1, "user", None, "x"), (1, None, "assistant", "first", "x"),
        (2, 1, None, "no role", "x"), (None, 1, "assistant", "a", "x"), (None, 1, "assistant", "a", "x"), (3, 1, "assistant", "", "x"),
        (4, 1, "user", "word " * 60_000, "x"), (4, 2, "assistant", "👍 \n\n é" * 1000, "x"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    path = public_tokenizers.path("byte_bpe_50k.json")
    out = {r["conv_id"]: r for r in digests(format_chats(df, path)).collect()}
    loss = {1: "firstsecond", 2: "", None: "aa", 3: "", 4: "👍 \n\n é" * 1000}
    assert {k: (r["loss_chars"], r["loss_sha256"]) for k, r in out.items()} == {k: (len(v), hashlib.sha256(v.encode()).hexdigest()) for k, v in loss.items()}
    assert out[1]["n_turns"] == 3 and out[None]["n_turns"] == 2
    assert digests(format_chats(df.limit(0), path)).count() == 0
