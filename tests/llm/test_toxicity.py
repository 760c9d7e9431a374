import numpy as np
import pyarrow as pa
import pytest

from loglake.llm import toxicity as T


def test_gradients():
    net, r = T.Network.fresh(), np.random.default_rng(0)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, mask, y = r.normal(size=(5, 3, 2 * T.DIM)), np.ones((5, 3), bool), np.array([1.0, 0, 1])
    mask[3:, 1], mask[:, 2] = False, False
    found, dx, _ = net.gradients(x, mask, y)
    for k in ("Uf", "Ub", "A", "v", "o", "bias", "Wf", "Wb", "cf", "cb"):
        i, e = tuple(r.integers(0, s) for s in net.p[k].shape), 1e-5
        net.p[k][i] += e
        up = net.gradients(x, mask, y)[2]
        net.p[k][i] -= 2 * e
        down = net.gradients(x, mask, y)[2]
        net.p[k][i] += e
        assert (up - down) / (2 * e) == pytest.approx(found[k][i], rel=0.2, abs=1e-4), k


def test_windows_cover_every_word():
    sizes = np.array([0, 1, 31, 32, 33, 48, 49, 1000])
    text, first, n = T.window_starts(np.concatenate(([0], np.cumsum(sizes))))
    for i, size in enumerate(sizes):
        base = int(sizes[:i].sum())
        own = [(int(f) - base, int(k)) for t, f, k in zip(text, first, n) if t == i]
        assert set().union(*(range(f, f + k) for f, k in own)) == set(range(size)) and len(own) >= 1
        assert all(b - a <= T.STRIDE for (a, _), (b, _) in zip(own, own[1:]))


def test_score_is_the_highest_window():
    net, r = T.Network.fresh(), np.random.default_rng(1)
    words = [f"v{i}" for i in range(50)]
    texts = [" ".join(r.choice(words, n)) for n in (100, 40, 20, 0)]
    got = net.scores(pa.array(texts, pa.large_string()))
    for text, score in zip(texts, got):
        w = text.split()
        starts, codes, vocabulary = T.word_codes(pa.array([text], pa.large_string()))
        x = net.inputs(vocabulary)
        best = -np.inf
        for _, a, n in zip(*T.window_starts(starts)):
            window = x[codes[a : a + n]][:, None] if n else np.zeros((1, 1, 2 * T.DIM), np.float32)
            best = max(best, float(net.forward(window, np.ones((max(n, 1), 1), bool) if n else np.zeros((1, 1), bool))[0]))
        assert score == pytest.approx(1 / (1 + np.exp(-best)), abs=1e-5), len(w)


@pytest.fixture(scope="module")
def invented():
    """Texts of rare made-up words; toxic ones hold one of a few words or stems somewhere."""
    r = np.random.default_rng(8)
    syllables = "an er on the re ti ou st in ed ha nd".split()
    word = lambda: "".join(r.choice(syllables, r.integers(1, 5)))
    texts, labels = [], []
    for i in range(900):
        w = [word() for _ in range(r.integers(20, 200))]
        if i % 6 == 0:
            for _ in range(r.integers(1, 4)):
                w[r.integers(0, len(w))] = r.choice(["vilewurm", "Quzzog!", "brakk" + word()])
        texts.append(" ".join(w))
        labels.append(int(i % 6 == 0))
    return texts, labels


def test_held_out_accuracy(invented):
    texts, labels = invented
    net = T.train(texts[:600], labels[:600])
    said, y = net.scores(pa.array(texts[600:], pa.large_string())) >= T.THRESHOLD, np.array(labels[600:]) == 1
    assert said[y].mean() >= 0.9 and said[~y].mean() <= 0.02


def test_sample_leaves_out_held_out_rows(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    texts, y = T.training_sample(docs, labels)
    held = {r["text"] for r in docs.where(T.held_out()).collect()} - {r["text"] for r in docs.where(~T.held_out()).collect()}
    known = labels.where(~T.held_out()).join(docs, "doc_id").where("toxic is not null").count()
    assert len(texts) == len(y) == known and not held & set(texts)


def test_odd_tables(spark, odd, none):
    labels = spark.createDataFrame([(1, None, 1), (1, 1, 1), (8, 1, 0), (7, 0, 0), (5, 1, 0), (5, 1, 1), (99, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    net = T.train(*T.training_sample(odd, labels))
    rows = T.score_toxicity(odd, net).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) and r["kept"] == "x" for r in rows)
    assert len({r["score"] for r in rows if not (r["text"] or "").strip()}) == 1
    assert T.score_toxicity(none, net).count() == 0
    assert T.training_sample(none, labels) == ([], []) and T.train([], []) is None
    assert {r["score"] for r in T.score_toxicity(odd, None).collect()} == {0.0}


def test_training_takes_a_vocabulary_in_runs(monkeypatch):
    words = [f"{i * 7919 % 99991:05d}w{i}" for i in range(45_000)]
    whole, runs = T.word_features(pa.array(words)), T.all_word_features(pa.array(words))
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(whole, runs))
    assert [len(x) for x in T.all_word_features(pa.array([], pa.string()))] == [0, 0, 1]
    sizes, one = [], T.word_features
    monkeypatch.setattr(T, "word_features", lambda some: sizes.append(len(some)) or one(some))
    monkeypatch.setattr(T, "EPOCHS", (1, 1))
    T.train([" ".join(words[i : i + 1500]) for i in range(0, 45_000, 1500)], [i % 2 for i in range(30)])
    assert max(sizes) <= 20_000 and sum(sizes) >= 45_000
