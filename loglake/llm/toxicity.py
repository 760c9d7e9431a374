"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word enters as the embedding of its hashed lower-case form beside the mean embedding of its hashed character (byte) 3-
to 5-grams. A forward and a backward recurrent layer read a window of ``WINDOW`` words, attention pools their states, and
a logistic unit scores the window. Windows overlap by half and cover the whole text, however long; a text's score is its
highest window's.

Training: labels belong to texts, so each epoch scores all windows of the sample and learns from the highest windows of
each text. The sample is bounded by ``MAX_TOXIC`` and ``MAX_CLEAN`` labelled texts of at most ``MAX_CHARS`` characters,
the first by a hash of the id. Everything else covers all rows; scoring has no bound.

Null and empty texts get the score of a window without words. Rows with a null label are not learned from; of repeated
label rows the highest counts. Without both classes in the sample every score is 0. Repeated rows get equal scores. Input
columns named ``score`` or ``predicted`` give way; all others stay. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from loglake.llm.text import add_columns, hashes, mix, texts_of, utf8_bytes, word_codes

WINDOW, STRIDE = 32, 16
ROWS, DIM, HIDDEN = 1 << 15, 8, 12
GRAMS = (3, 4, 5)
MAX_TOXIC, MAX_CLEAN, MAX_CHARS = 1200, 2400, 20_000
#: a small sample is gone through more often, so that there are about STEPS steps
STEPS, EPOCHS, BATCH, RATE = 320, (4, 20), 128, 0.005
THRESHOLD = 0.7
MIN_TEXTS = 3
#: the tables learn more slowly, so that what many texts share counts, not what marks a single one
TABLE_RATE = 0.2
_CHUNK = 2048
_WORDS = 20_000


def word_features(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word: its row in the word table; rows in the character table; where each word's character rows begin."""
    words = pc.utf8_lower(words.cast(pa.large_string()))
    bare = pc.utf8_trim(words, ".,;:!?\"'()[]«»¡¿…")
    rows = (mix(hashes(bare)) % np.uint64(ROWS)).astype(np.int64)
    raw, offsets = utf8_bytes(words)
    n, size = len(words), np.diff(offsets)
    marked = np.zeros(len(raw) + 2 * n, np.uint64)  # byte 1 before and 2 after each word
    at = offsets[:-1] + 2 * np.arange(n)
    marked[np.arange(len(raw)) + np.repeat(2 * np.arange(n) + 1, size)] = raw
    marked[at], marked[at + size + 1] = 1, 2
    owner = np.repeat(np.arange(n, dtype=np.int32), size + 2)
    found, owners = [], []
    with np.errstate(over="ignore"):
        for g in GRAMS:
            m = len(marked) - g + 1
            if m <= 0:
                continue
            h = np.full(m, g, np.uint64)
            for i in range(g):
                h = h * np.uint64(0x100000001B3) + marked[i : m + i]
            whole = owner[:m] == owner[g - 1 :]
            found.append((mix(h[whole]) % np.uint64(ROWS)).astype(np.int32))
            owners.append(owner[:m][whole])
    found, owners = np.concatenate(found or [np.zeros(0, np.int32)]), np.concatenate(owners or [np.zeros(0, np.int32)])
    order = np.argsort(owners, kind="stable")
    starts = np.searchsorted(owners[order], np.arange(n + 1))
    return rows, found[order], starts


def _runs_of_features(words: pa.Array):
    """``word_features`` of runs of words, each with its first word: a whole vocabulary at once takes many times its memory."""
    for a in range(0, len(words), _WORDS):
        yield a, word_features(words[a : a + _WORDS])


def all_word_features(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``word_features`` of a whole vocabulary, taken run by run."""
    runs = [f for _, f in _runs_of_features(words)] or [word_features(words)]
    sizes = np.concatenate([np.diff(starts) for _, _, starts in runs])
    return np.concatenate([r for r, _, _ in runs]), np.concatenate([g for _, g, _ in runs]), np.concatenate(([0], np.cumsum(sizes)))


def window_starts(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, words) of every window; the last window of a text ends with it."""
    n = np.diff(starts)
    k = np.where(n <= WINDOW, 1, -(-(n - WINDOW) // STRIDE) + 1)
    text = np.repeat(np.arange(len(n)), k)
    i = np.arange(len(text)) - np.repeat(np.cumsum(k) - k, k)
    first = np.minimum(i * STRIDE, np.maximum(n[text] - WINDOW, 0))
    return text, starts[:-1][text] + first, np.minimum(n[text], WINDOW)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Network:
    p: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fresh(cls, seed: int = 7) -> Network:
        r = np.random.default_rng(seed)
        draw = lambda *shape, scale: r.normal(0, scale, shape).astype(np.float32)
        p = {"words": draw(ROWS, DIM, scale=0.1), "chars": draw(ROWS, DIM, scale=0.1)}
        for d in "fb":
            p[f"W{d}"], p[f"U{d}"] = draw(2 * DIM, 3 * HIDDEN, scale=0.4), draw(HIDDEN, 3 * HIDDEN, scale=0.3)
            p[f"c{d}"] = np.zeros(3 * HIDDEN, np.float32)
        p["A"], p["v"] = draw(2 * HIDDEN, HIDDEN, scale=0.3), draw(HIDDEN, scale=0.3)
        p["o"], p["bias"] = draw(2 * HIDDEN, scale=0.3), np.full(1, -1, np.float32)
        return cls(p)

    def inputs(self, words: pa.Array) -> np.ndarray:
        """(words, 2 * DIM): the word row beside the mean of the character rows."""
        out = np.zeros((len(words), 2 * DIM), np.float32)
        for a, (rows, grams, starts) in _runs_of_features(words):
            out[a : a + len(rows), :DIM] = self.p["words"][rows]
            out[a : a + len(rows), DIM:] = _means(self.p["chars"][grams], starts)
        return out

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits of windows; x: (time, windows, 2 * DIM) inputs or a pair of ready projections; mask: (time, windows)."""
        p, H, (T, B) = self.p, HIDDEN, mask.shape
        states, saved = np.zeros((T, B, 2 * H), np.float32), {}
        full = mask.all()
        for d, times in (("f", range(T)), ("b", range(T - 1, -1, -1))):
            gates = x["fb".index(d)] if isinstance(x, tuple) else x @ p[f"W{d}"] + p[f"c{d}"]
            h, U, at = np.zeros((B, H), np.float32), p[f"U{d}"], slice(0, H) if d == "f" else slice(H, 2 * H)
            steps = []
            for t in times:
                g, u = gates[t], h @ U
                rz = _sigmoid(g[:, : 2 * H] + u[:, : 2 * H])
                r, z = rz[:, :H], rz[:, H:]
                n = np.tanh(g[:, 2 * H :] + r * u[:, 2 * H :])
                new = n + z * (h - n)
                if not full:
                    new = np.where(mask[t][:, None], new, h)
                if keep:
                    steps.append((t, h, r, z, n, u[:, 2 * H :]))
                h = new
                states[t, :, at] = h
            saved[d] = steps
        a = np.tanh(states @ p["A"])
        e = np.where(mask, a @ p["v"], -1e9)
        w = np.exp(e - e.max(axis=0))
        w = np.where(mask, w, 0)
        w /= np.maximum(w.sum(axis=0), 1e-9)
        pooled = (w[:, :, None] * states).sum(axis=0)
        logit = pooled @ p["o"] + p["bias"][0]
        return (logit, (states, a, w, pooled, saved)) if keep else logit

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, float]:
        """Gradients of the mean logistic loss, that of the inputs, and the loss."""
        p, H = self.p, HIDDEN
        logit, (states, a, w, pooled, saved) = self.forward(x, mask, keep=True)
        prob = _sigmoid(logit)
        loss = -np.mean(y * np.log(prob + 1e-7) + (1 - y) * np.log(1 - prob + 1e-7))
        d = ((prob - y) / len(y)).astype(np.float32)
        g = {"o": pooled.T @ d, "bias": np.array([d.sum()], np.float32)}
        dpool = d[:, None] * p["o"]
        dw = (states * dpool).sum(axis=2)
        de = w * (dw - (w * dw).sum(axis=0))
        g["v"] = np.einsum("tb,tbh->h", de, a)
        da = de[:, :, None] * p["v"] * (1 - a * a)
        g["A"] = np.einsum("tbs,tbh->sh", states, da)
        dstates = w[:, :, None] * dpool + da @ p["A"].T
        dx = np.zeros_like(x)
        for k, at in (("f", slice(0, H)), ("b", slice(H, 2 * H))):
            U, dh = p[f"U{k}"], np.zeros((len(y), H), np.float32)
            gU, dgates = np.zeros_like(U), np.zeros((*mask.shape, 3 * H), np.float32)
            for t, before, r, z, n, un in reversed(saved[k]):
                dh = dh + dstates[t, :, at]
                live = mask[t][:, None]
                dnew = np.where(live, dh, 0)
                dn = dnew * (1 - z) * (1 - n * n)
                dz = dnew * (before - n) * z * (1 - z)
                dr = dn * un * r * (1 - r)
                du = np.concatenate((dr, dz, dn * r), axis=1)
                dgates[t] = np.concatenate((dr, dz, dn), axis=1)
                gU += before.T @ du
                dh = np.where(live, dnew * z + du @ U.T, dh)
            g[f"U{k}"], g[f"c{k}"] = gU, dgates.sum(axis=(0, 1))
            g[f"W{k}"] = np.einsum("tbi,tbg->ig", x, dgates)
            dx += dgates @ p[f"W{k}"].T
        return g, dx, float(loss)

    def scores(self, texts: pa.Array) -> np.ndarray:
        """The highest window's probability of each text."""
        starts, codes, words = word_codes(texts)
        x = self.inputs(words)
        x = np.concatenate((x, np.zeros((1, 2 * DIM), np.float32)))  # the last row: no word
        ready = [x @ self.p[f"W{d}"] + self.p[f"c{d}"] for d in "fb"]
        text, first, size = window_starts(starts)
        logits = np.empty(len(text), np.float32)
        step = np.arange(WINDOW)[:, None]
        for full in (True, False):  # windows of short texts go apart, cut to their longest
            chosen = np.flatnonzero((size == WINDOW) == full)
            for a in range(0, len(chosen), _CHUNK):
                i = chosen[a : a + _CHUNK]
                live = step[: max(1, int(size[i].max()))] < size[i]
                at = np.where(live, codes[np.minimum(first[i] + step[: len(live)], max(len(codes) - 1, 0))] if len(codes) else 0, len(x) - 1)
                logits[i] = self.forward(tuple(r[at] for r in ready), live)
        best = np.full(len(texts), -np.inf, np.float32)
        np.maximum.at(best, text, logits)
        return _sigmoid(best.astype(np.float64))


def _means(rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
    total = np.zeros((len(starts) - 1, rows.shape[1] if rows.ndim == 2 else DIM), np.float32)
    full = np.flatnonzero(np.diff(starts))
    if len(full):
        total[full] = np.add.reduceat(rows, starts[full], axis=0) / np.diff(starts)[full, None]
    return total


def _scattered(n: int, index: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """(n, columns): the sums of the rows that share an index."""
    out = np.zeros((n, rows.shape[1]), np.float32)
    if len(index):
        order = np.argsort(index, kind="stable")
        index = index[order]
        first = np.concatenate(([0], np.flatnonzero(np.diff(index)) + 1))
        out[index[first]] = np.add.reduceat(rows[order], first, axis=0)
    return out


def _odds(toxic: np.ndarray, clean: np.ndarray, n_toxic: float, n_clean: float) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of each feature row by the toxic and clean texts that hold it (0 where under 2 toxic ones do), and
    whether MIN_TEXTS texts hold it: a rarer row stays 0, for it would only learn its text by heart."""
    odds = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))
    return np.where(toxic >= 2, odds, 0), (toxic + clean >= MIN_TEXTS).astype(np.float32)[:, None]


def train(texts: list[str], labels: list[int], seed: int = 7) -> Network | None:
    """The network fitted to a sample of whole texts; None without both classes."""
    y = np.array(labels, np.float32)
    if not (y == 1).any() or not (y == 0).any():
        return None
    net, r = Network.fresh(seed), np.random.default_rng(seed)
    starts, codes, words = word_codes(pa.array(texts, pa.large_string()))
    rows, grams, gram_starts = all_word_features(words)
    text, first, size = window_starts(starts)
    step = np.arange(WINDOW)[:, None]
    n_grams = np.maximum(np.diff(gram_starts), 1)
    pairs = np.unique(np.repeat(np.arange(len(y)), np.diff(starts)) * max(len(words), 1) + codes)  # distinct words of each text
    of_text, of_word = pairs // max(len(words), 1), pairs % max(len(words), 1)
    texts_with = [np.bincount(of_word, weights=y[of_text] == label, minlength=len(words)) for label in (1, 0)]
    sides = (y == 1).sum(), (y == 0).sum()
    odds, known_words = _odds(*(np.bincount(rows, weights=t, minlength=ROWS) for t in texts_with), *sides)
    del pairs, of_text, of_word
    # a gram counts with the texts of each of its words
    gram_odds, known_chars = _odds(*(np.bincount(grams, weights=np.repeat(t, np.diff(gram_starts)), minlength=ROWS) for t in texts_with), *sides)
    net.p["words"] *= known_words
    net.p["chars"] *= known_chars
    net.p["words"][:, 0], net.p["chars"][:, 0] = odds / 2, gram_odds / 2  # a start that the whole sample supports
    by_word = odds[rows]
    for a in range(0, len(words), _WORDS):
        own = gram_starts[a : a + _WORDS + 1]
        np.maximum.at(by_word, np.repeat(np.arange(a, a + len(own) - 1), np.diff(own)), gram_odds[grams[own[0] : own[-1]]])
    token_odds = np.concatenate((by_word[codes], [0.0]))
    prior = np.maximum.reduceat(token_odds, np.column_stack((first, first + np.maximum(size, 1))).ravel())[::2] if len(codes) else np.zeros(len(text))
    del texts_with, by_word, token_odds
    moment = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.p.items()}
    done, epoch = 0, 0
    while epoch < EPOCHS[0] or epoch < EPOCHS[1] and done < STEPS:
        # at first the windows with the most telling word or gram stand for their text, then those the network finds
        rank = prior if epoch < 2 else _window_logits(net, codes, words, first, size)
        order = np.lexsort((-rank, text))
        nth = np.arange(len(text)) - np.searchsorted(text[order], text[order])
        many = np.where(y[text[order]] == 1, 1, 2)
        chosen = r.permutation(order[nth < many])
        weight_word = 0.7  # words are dropped at times, so that the characters learn too
        for a in range(0, len(chosen), BATCH):
            i = chosen[a : a + BATCH]
            live = step < size[i]
            at = codes[np.minimum(first[i] + step, len(codes) - 1)] if len(codes) else np.zeros(live.shape, np.int64)
            uniq, inverse = np.unique(at, return_inverse=True)
            inverse = inverse.reshape(at.shape)
            kept = (r.random(len(uniq)) < weight_word)[:, None].astype(np.float32)
            own = np.concatenate(([0], np.cumsum(gram_starts[uniq + 1] - gram_starts[uniq])))
            take = np.repeat(gram_starts[uniq] - own[:-1], np.diff(own)) + np.arange(own[-1])
            base = np.concatenate((net.p["words"][rows[uniq]] * kept, _means(net.p["chars"][grams[take]], own)), axis=1)
            x = base[inverse] * live[:, :, None]
            g, dx, _ = net.gradients(x, live, y[text[i]])
            dbase = _scattered(len(uniq), inverse.ravel(), (dx * live[:, :, None]).reshape(-1, 2 * DIM))
            g["words"] = _scattered(ROWS, rows[uniq], dbase[:, :DIM] * kept)
            g["chars"] = _scattered(ROWS, grams[take], np.repeat(dbase[:, DIM:] / n_grams[uniq, None], np.diff(own), axis=0))
            g["words"] *= known_words
            g["chars"] *= known_chars
            done += 1
            for k, (m, v) in moment.items():  # Adam
                m += 0.1 * (g[k] - m)
                v += 0.001 * (g[k] ** 2 - v)
                rate = RATE * (TABLE_RATE if k in ("words", "chars") else 1)
                net.p[k] -= rate * (m / (1 - 0.9**done)) / (np.sqrt(v / (1 - 0.999**done)) + 1e-8)
        epoch += 1
    return net


def _window_logits(net: Network, codes: np.ndarray, words: pa.Array, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Logits of windows. Projections are made for the words of a chunk, those of a whole vocabulary are many."""
    x, step = np.concatenate((net.inputs(words), np.zeros((1, 2 * DIM), np.float32))), np.arange(WINDOW)[:, None]
    out = np.empty(len(first), np.float32)
    for a in range(0, len(first), _CHUNK):
        i = slice(a, a + _CHUNK)
        live = step < size[i]
        at = np.where(live, codes[np.minimum(first[i] + step, max(len(codes) - 1, 0))] if len(codes) else 0, len(x) - 1)
        seen = np.zeros(len(x), bool)
        seen[at] = True
        at, own = (np.cumsum(seen) - 1)[at], x[seen]
        out[i] = net.forward(tuple((own @ net.p[f"W{d}"] + net.p[f"c{d}"])[at] for d in "fb"), live)
    return out


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[list[str], list[int]]:
    """At most MAX_TOXIC + MAX_CLEAN labelled texts that are not held out, the first by a hash of their id."""
    known = labels.where(F.col("toxic").isNotNull() & ~held_out(id_col)).groupBy(id_col).agg(F.max("toxic").alias("toxic"))
    parts = []
    short = docs.select(id_col, text_col).where(F.char_length(text_col) <= MAX_CHARS)
    for label, limit in ((1, MAX_TOXIC), (0, MAX_CLEAN)):
        # candidates beyond the limit stand in for labelled ids whose text is missing or too long
        ids = known.where(F.col("toxic") == label).orderBy(F.xxhash64(id_col), id_col).limit(2 * limit)
        first = short.join(F.broadcast(ids), id_col).groupBy(id_col).agg(F.min(text_col).alias("text"), F.max("toxic").alias("toxic"))
        parts.append(first.orderBy(F.xxhash64(id_col), id_col).limit(limit))
    rows = [r for part in parts for r in part.select("text", "toxic").collect()]
    return [r["text"] for r in rows], [int(r["toxic"]) for r in rows]


def score_toxicity(df: DataFrame, net: Network | None, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``df`` with ``score`` (0 to 1) and ``predicted`` (1 if the score reaches the threshold)."""
    added = StructType([StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    shared = df.sparkSession.sparkContext.broadcast(net.p if net else None)  # 2 * ROWS * DIM floats and a few small tables

    def make(batch):
        if shared.value is None:
            s = np.zeros(batch.num_rows)
        else:
            s = Network(shared.value).scores(texts_of(batch.column(text_col)))
        return [pa.array(s), pa.array((s >= threshold).astype(np.int32))]

    return add_columns(df, text_col, make, added)


def op8_gru_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    net = train(*training_sample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return score_toxicity(docs, net).select("doc_id", held_out().alias("held_out"), "score", "predicted")
