import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from loglake.llm import hmm


def test_recursions_against_enumeration(monkeypatch):
    monkeypatch.setattr(hmm, "CLASSES", 5)
    r, states = np.random.default_rng(0), 3
    start, move, emission = r.dirichlet(np.ones(states)), r.dirichlet(np.ones(states), states), r.dirichlet(np.ones(5), states)
    sizes, classes = np.array([3, 1, 4, 2]), r.integers(0, 5, 10)
    time, line = hmm.TimeMajor(sizes), np.empty(10, int)
    line[time.place] = classes
    told = np.empty(4)
    told[time.order] = hmm.forward(time, line, start, move, emission)
    counts, moves, starts, loglik = hmm.expected_counts(sizes, classes, start, move, emission)
    want = np.zeros((5, states)), np.zeros((states, states)), np.zeros(states)
    for k, seq in enumerate(np.split(classes, np.cumsum(sizes)[:-1])):
        paths = {}
        for z in itertools.product(range(states), repeat=len(seq)):
            p = start[z[0]] * emission[z[0], seq[0]]
            for t in range(1, len(seq)):
                p *= move[z[t - 1], z[t]] * emission[z[t], seq[t]]
            paths[z] = p
        total = sum(paths.values())
        assert told[k] == pytest.approx(math.log(total))
        for z, p in paths.items():
            want[2][z[0]] += p / total
            for t in range(len(seq)):
                want[0][seq[t], z[t]] += p / total
                if t:
                    want[1][z[t - 1], z[t]] += p / total
    for got, exact in zip((counts, moves, starts), want):
        assert np.allclose(got, exact)
    assert loglik == pytest.approx(told.sum())


def plain_counts(seq, start, move, emission):
    """Baum-Welch over one whole text, in logarithms, step by step."""
    with np.errstate(divide="ignore"):
        e, m = np.log(emission.T[seq]), np.log(move)
    alpha, beta = np.empty_like(e), np.zeros_like(e)
    alpha[0] = np.log(start) + e[0]
    for t in range(1, len(seq)):
        alpha[t] = np.logaddexp.reduce(alpha[t - 1][:, None] + m, axis=0) + e[t]
    for t in range(len(seq) - 2, -1, -1):
        beta[t] = np.logaddexp.reduce(m + (e[t + 1] + beta[t + 1])[None], axis=1)
    total = np.logaddexp.reduce(alpha[-1])
    gamma = np.exp(alpha + beta - total)
    moves = sum(np.exp(alpha[t][:, None] + m + (e[t + 1] + beta[t + 1])[None] - total) for t in range(len(seq) - 1))
    return gamma, moves, total


@pytest.mark.parametrize("run_tokens, piece", [(400_000, 512), (300, 100), (1, 1), (400_000, 5000)])
def test_whole_long_texts(monkeypatch, run_tokens, piece):
    """Texts of over 512 words are learned from whole, however they are cut."""
    monkeypatch.setattr(hmm, "RUN_TOKENS", run_tokens)
    monkeypatch.setattr(hmm, "PIECE", piece)
    r, states, kinds = np.random.default_rng(5), 3, 7
    start, move, emission = r.dirichlet(np.ones(states)), r.dirichlet(np.full(states, 0.3), states), r.dirichlet(np.ones(kinds), states)
    sizes = np.array([1500, 3, 700, 1, 513])
    classes = r.integers(0, kinds, sizes.sum())
    counts, moves, starts, loglik = hmm.expected_counts(sizes, classes, start, move, emission)
    want = np.zeros((kinds, states)), np.zeros((states, states)), np.zeros(states)
    total = 0.0
    for seq in np.split(classes, np.cumsum(sizes)[:-1]):
        gamma, m, own = plain_counts(seq, start, move, emission)
        np.add.at(want[0], seq, gamma)
        want[1][:] += m
        want[2][:] += gamma[0]
        total += own
    for got, exact in zip((counts, moves, starts, loglik), (*want, total)):
        assert np.allclose(got, exact, rtol=1e-8)


def test_frequent_words_have_classes_of_their_own(spark, medium):
    df = spark.read.parquet(f"{medium}/documents.parquet")
    docs = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    blocks, model = hmm.encoded_blocks(df, "doc_id", "text")
    trained = [t for d, t in docs if zlib.crc32(str(d).encode()) % 5 != 1]
    c = Counter(w for t in trained for w in re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), t or "")))
    often = sorted((x for x in c.items() if x[1] >= max(hmm.LEAST, hmm.SHARE * model.total)), key=lambda x: (-x[1], x[0].encode()))[: hmm.FREQUENT]
    assert len(often) > 500 and np.allclose(model.mass[: len(often)], [n + 0.5 for _, n in often]) and not model.mass[len(often) : hmm.FREQUENT].any()
    assert (model.mass >= 0).all() and model.mass.sum() == pytest.approx(model.scale)
    # each text's classes hold the frequent words in their places
    rank = {w: i for i, (w, _) in enumerate(often)}
    rows = {}
    for b in blocks.collect():
        at = 0
        sizes, classes = hmm.unpacked(b["sizes"]), hmm.unpacked(b["classes"])
        for d, n in zip(b["doc_id"], sizes):
            rows[d] = classes[at : at + n - 1]
            at += n
    for d, t in docs[:200]:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), t or ""))
        assert all((rank[w] == k) if w in rank else k >= hmm.FREQUENT for w, k in zip(words, rows[d]))


def base_of(docs):
    tokens = {i: [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), t or "")), "\0end"] for i, (_, t) in enumerate(docs)}
    out = [d is not None and zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in docs]
    c = Counter(w for i, ws in tokens.items() if not out[i] for w in ws)
    n, v = sum(c.values()), len(c)
    return [(d, out[i], len(tokens[i]), sum(c[w] > 0 for w in tokens[i]), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens[i])) for i, (d, _) in enumerate(docs)]


def rows_of(df, docs):
    blocks, model = hmm.encoded_blocks(df, "doc_id", "text")
    told = hmm.train(blocks, model, 6)
    return [(r["doc_id"], not r["train"], r["n_tokens"], r["n_known"], model.total, r["base_score"], r["score"]) for r in hmm.score_texts(blocks, model, "doc_id").collect()], told, model


def test_scores(spark, medium):
    df = spark.read.parquet(f"{medium}/documents.parquet")
    docs = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    rows, told, model = rows_of(df, docs)
    want = {r[0]: r for r in base_of(docs)}
    for r in rows:
        assert r[:5] == want[r[0]][:5] and r[5] == pytest.approx(want[r[0]][5], rel=1e-9)
    assert told == sorted(told)  # Baum-Welch (with little mixing) climbs
    out = [r for r in rows if r[1]]
    assert sum(r[6] for r in out) > sum(r[5] for r in out) + 0.1 * sum(r[2] for r in out)
    # the classes of a state, and the words of a class, are distributions
    assert np.allclose(model.emission.sum(axis=1), 1) and model.mass.sum() == pytest.approx(model.scale)


def test_one_state_is_the_base(spark, small):
    df = spark.read.parquet(f"{small}/documents.parquet")
    blocks, model = hmm.encoded_blocks(df, "doc_id", "text")
    one = hmm.Model.__new__(hmm.Model)
    one.__dict__ |= model.__dict__ | {"states": 1, "start": np.ones(1), "move": np.ones((1, 1)), "emission": model.base[None]}
    for r in hmm.score_texts(blocks, one, "doc_id").collect():
        assert r["score"] == pytest.approx(r["base_score"], rel=1e-9)


def test_odd_tables(odd, none):
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    rows, _, _ = rows_of(odd, docs)
    key = lambda r: (str(r[0]), r[2])
    for got, want in zip(sorted(rows, key=key), sorted(base_of(docs), key=key)):
        assert got[:5] == want[:5] and got[5] == pytest.approx(want[5]) and np.isfinite(got[6]) and got[6] < 0
    assert rows_of(none, [])[0] == []
    rows, _, _ = rows_of(odd.where("crc32(cast(doc_id as string)) % 5 = 1"), [])
    assert all(r[3] == 0 and np.isfinite(r[6]) for r in rows)  # nothing to learn from
