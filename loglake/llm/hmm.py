"""Hidden Markov language model over words.

A word belongs to one of a fixed number of classes: the ``FREQUENT`` most frequent words have a class each, the rest share
classes by a hash of their last letters. A hidden state emits the class, and the class emits the word in proportion to its smoothed count, which comes
from the whole training part however many words there are:

    p(w) = (c + 0.5) / (N + 0.5 (V + 1)),   P(w | state) = P(class | state) p(w) / p(class)

Words never seen in training are one class with the one smoothed count that the base leaves them. With one state the
model is the base. Each Baum-Welch round is one job: tasks run the scaled forward and backward recursions over their
blocks, each over whole texts, and return expected counts, which Spark sums by class; only classes x states numbers reach
the driver. Texts run in pieces side by side that hand on their exact states (``expected_counts``). A text's score is its exact log10 likelihood by the scaled forward recursion, over the whole text and its end.

Null text counts as empty: the end alone. Rows with a null id are not held out. Repeated rows are learned and scored
each. Extra columns are left out. Without any training text every word is unknown; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, DoubleType, LongType, StringType, StructField, StructType

from loglake.llm.blocks import by_part, entries_of, packed, ragged, unpacked, unpacked_words, with_facts, word_blocks
from loglake.llm.scratch import written
from loglake.llm.text import hashes, mix, texts_of, word_codes

STATES, ROUNDS = 8, 5
FREQUENT, SUFFIXES = 8192, 4096
SUFFIX_CHARS = 3
#: words that may be frequent: with this share of the training tokens (so they are at most 200,000), and this count
SHARE, LEAST = 1 / 200_000, 20
MIXED = 0.05  # share of the base distribution in each state's emissions
END, UNKNOWN = FREQUENT + SUFFIXES, FREQUENT + SUFFIXES + 1
CLASSES = UNKNOWN + 1
BLOCK_BYTES = 8 << 20
#: words of a piece of a text in training, and tokens that recursions run over side by side
PIECE, RUN_TOKENS = 2048, 400_000


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 1, F.lit(False))


def shared_class(words: pa.Array) -> np.ndarray:
    """The class of each word among those that share one, by its last letters."""
    tail = hashes(pc.utf8_slice_codeunits(words, -SUFFIX_CHARS))
    return FREQUENT + (mix(tail) % np.uint64(SUFFIXES)).astype(np.int64)


class TimeMajor:
    """Texts of a block side by side, longest first: at step t the first width[t] texts still run."""

    def __init__(self, sizes: np.ndarray):
        self.order = np.argsort(-sizes, kind="stable")
        long = sizes[self.order]
        steps = int(long[0]) if len(long) else 0
        self.width = np.searchsorted(-long, -np.arange(steps), side="left")
        self.first = np.concatenate(([0], np.cumsum(self.width)))
        rank = np.empty_like(self.order)
        rank[self.order] = np.arange(len(self.order))
        starts = np.cumsum(sizes) - sizes
        step = np.arange(int(sizes.sum())) - np.repeat(starts, sizes)
        #: of each token in text order, its place in time order
        self.place = self.first[step] + np.repeat(rank, sizes)


def forward(time: TimeMajor, classes: np.ndarray, start: np.ndarray, move: np.ndarray, emission: np.ndarray) -> np.ndarray:
    """The log likelihood of each text, in time order; classes in time order."""
    n, steps, by_class = len(time.order), len(time.width), np.ascontiguousarray(emission.T)
    loglik = np.zeros(n)
    alpha = np.broadcast_to(start, (n, len(start)))
    for t in range(steps):
        w, a = time.width[t], time.first[t]
        alpha = (alpha[:w] if t == 0 else alpha[:w] @ move) * by_class[classes[a : a + w]]
        scale = alpha.sum(axis=1)
        alpha = alpha / scale[:, None]
        loglik[:w] += np.log(scale)
    return loglik


def _lines(sizes: np.ndarray, classes: np.ndarray):
    """(own, time, line) for each run of pieces of similar size: which pieces, their order in time, their classes in it."""
    firsts = np.cumsum(sizes) - sizes
    for own in _runs(sizes):
        time = TimeMajor(sizes[own])
        line = np.empty(int(sizes[own].sum()), np.int64)
        line[time.place] = classes[ragged(firsts[own], sizes[own])]
        yield own, time, line


def _transfer(time: TimeMajor, line: np.ndarray, move: np.ndarray, by_class: np.ndarray) -> np.ndarray:
    """For each piece, in time order, the matrix that takes the state before its first word to the scaled state after its
    last one (up to a factor)."""
    states = len(move)
    out = np.broadcast_to(np.eye(states), (len(time.order), states, states)).copy()
    for t, w in enumerate(time.width):
        emit = by_class[line[time.first[t] : time.first[t] + w]]
        now = out[:w] if t == 0 else (out[:w].reshape(-1, states) @ move).reshape(w, states, states)
        now = now * emit[:, None, :]
        if t % 16 == 15:  # far from what a double can hold
            now /= now.sum(axis=(1, 2), keepdims=True)
        out[:w] = now
    return out / out.sum(axis=(1, 2), keepdims=True)


def _borders(text: np.ndarray, nth: np.ndarray, sizes: np.ndarray, classes: np.ndarray, start: np.ndarray, move: np.ndarray, by_class: np.ndarray):
    """(state before, weight after) of each piece of the texts: what the pieces on either side say, exactly."""
    n, states = len(sizes), len(start)
    before, after = np.tile(start, (n, 1)), np.ones((n, states))
    pieces = np.bincount(text) if n else np.zeros(0, np.int64)
    cut = np.flatnonzero(pieces[text] > 1)  # pieces of texts that are cut at all
    if not len(cut):
        return before, after
    place = np.full(n, -1)
    place[cut] = np.arange(len(cut))
    matrix = np.empty((len(cut), states, states))
    at = np.cumsum(sizes) - sizes
    for own, time, line in _lines(sizes[cut], classes[ragged(at[cut], sizes[cut])]):
        matrix[own[time.order]] = _transfer(time, line, move, by_class)
    for r in range(1, int(nth.max()) + 1):
        here = np.flatnonzero(nth == r)
        alpha = np.einsum("ni,nij->nj", before[here - 1], matrix[place[here - 1]])
        before[here] = (alpha / alpha.sum(axis=1, keepdims=True)) @ move
    for r in range(int(nth.max()), 0, -1):
        here = np.flatnonzero(nth == r)
        first = np.einsum("nij,nj->ni", matrix[place[here]], after[here])
        after[here - 1] = (first / first.sum(axis=1, keepdims=True)) @ move.T
    return before, after


def expected_counts(sizes: np.ndarray, classes: np.ndarray, start: np.ndarray, move: np.ndarray, emission: np.ndarray):
    """(class counts, transition counts, start counts, log likelihood) over whole texts of ``sizes`` words each.

    Long texts are cut into pieces, so that all pieces can run side by side. A matrix for each piece first tells the exact
    state before it and weight after it; with these, the recursions inside the pieces, and the step from one piece to the
    next, give what one pass over the whole text gives."""
    states, by_class = len(start), np.ascontiguousarray(emission.T)
    parts = -(-sizes // PIECE)
    text = np.repeat(np.arange(len(sizes)), parts)
    nth = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
    sizes = np.minimum(PIECE, np.repeat(sizes, parts) - nth * PIECE)
    before, after = _borders(text, nth, sizes, classes, start, move, by_class)
    counts, moves, loglik = np.zeros((len(by_class), states)), np.zeros((states, states)), 0.0
    last, first, starts = np.empty_like(before), np.empty_like(before), np.zeros(states)
    for own, time, line in _lines(sizes, classes):
        ids = own[time.order]
        emit = by_class[line]
        alphas, scales = np.empty_like(emit), np.empty(len(emit))
        alpha = before[ids]
        for t, w in enumerate(time.width):
            a = time.first[t]
            now = alphas[a : a + w]
            np.multiply(alpha[:w] if t == 0 else alpha[:w] @ move, emit[a : a + w], out=now)
            now.sum(axis=1, out=scales[a : a + w])
            now /= scales[a : a + w, None]
            alpha = now
        ends = np.append(time.width[1:], 0)  # pieces from there on end with the step
        for t in np.flatnonzero(ends < time.width):
            a = time.first[t]
            last[ids[ends[t] : time.width[t]]] = alphas[a + ends[t] : a + time.width[t]]
        loglik += float(np.log(scales).sum())
        emit /= scales[:, None]
        ahead = np.zeros((0, states))
        for t in range(len(time.width) - 1, -1, -1):
            w, a, go = time.width[t], time.first[t], len(ahead)
            if go < w:
                beta = np.empty((w, states))
                own_after = after[ids[go:w]]
                beta[go:] = own_after / (alphas[a + go : a + w] * own_after).sum(axis=1, keepdims=True)
                if go:
                    beta[:go] = ahead @ move.T
            else:
                beta = ahead @ move.T
            if go:
                moves += alphas[a : a + go].T @ ahead
            ahead = emit[a : a + w] * beta
            alphas[a : a + w] *= beta  # the share of each state from here on
        first[ids] = ahead
        starts += alphas[: len(ids)][nth[ids] == 0].sum(axis=0) if len(ids) else 0
        counts += np.column_stack([np.bincount(line, weights=alphas[:, k], minlength=len(by_class)) for k in range(states)])
    inner = np.flatnonzero(nth > 0)
    moves += last[inner - 1].T @ first[inner]
    return counts, moves * move, starts, loglik


def count_words(words: DataFrame, total: int) -> DataFrame:
    """block, entries, counts and shared classes (by entry, packed; counts over the whole training part), and the entries
    (``often_at``, packed places) and words that may be frequent. In one row of each part the number of its distinct training
    words, the smoothed mass of its shared classes, and its words that may be frequent with their counts."""
    out = StructType([
        StructField("block", LongType()), StructField("entries", BinaryType()), StructField("counts", BinaryType()),
        StructField("classes", BinaryType()), StructField("often_at", BinaryType()), StructField("often", ArrayType(StringType())),
        StructField("distinct_words", LongType()), StructField("mass_class", ArrayType(LongType())), StructField("mass", ArrayType(DoubleType())),
        StructField("top_word", ArrayType(StringType())), StructField("top_count", ArrayType(LongType())),
    ])
    words_kind = pa.list_(pa.string())
    kinds = [pa.int64(), *[pa.binary()] * 4, words_kind, pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64()), words_kind, pa.list_(pa.int64())]

    def run(batches):
        # a part holds every block's entries of its words: sum over all rows first, then answer each row
        rows, index, sums = [], {}, []
        for b in batches:
            for r in b.select(["block", "entries", "lengths", "data", "counts"]).to_pylist():
                text = unpacked_words(r.pop("lengths"), r.pop("data")).to_pylist()
                at = np.fromiter((index.setdefault(w, len(index)) for w in text), np.int32, len(text))
                rows.append((r["block"], r["entries"], at))
                sums.append((at, unpacked(r["counts"])))
        counts = np.zeros(len(index), np.int64)
        for at, c in sums:
            counts[at] += c  # an entry is distinct in its row
        names = pa.array(list(index), pa.large_string())
        classes = np.where(counts > 0, shared_class(names), UNKNOWN)
        mass = np.bincount(classes, weights=np.where(counts > 0, counts + 0.5, 0), minlength=CLASSES)
        held = np.flatnonzero(mass)
        often = counts >= max(LEAST, SHARE * total)
        top = np.flatnonzero(often)
        told = [int((counts > 0).sum()), held.tolist(), mass[held].tolist(), names.take(pa.array(top)).to_pylist(), counts[top].tolist()]
        for block, entries, at in rows:
            marked = np.flatnonzero(often[at])
            columns = [block, entries, packed(counts[at]), packed(classes[at]), packed(marked), names.take(pa.array(at[marked])).to_pylist(), *told]
            told = [0, None, None, None, None]
            yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(columns, kinds)], names=out.fieldNames())

    return written(by_part(words).mapInArrow(run, out), "counts", "uncompressed")


def frequent_words(facts: DataFrame) -> list[tuple[str, int]]:
    """The ``FREQUENT`` words with the highest counts (ties by word): at most that many rows reach the driver."""
    words = facts.where("top_word is not null").select(F.explode(F.arrays_zip("top_word", "top_count")).alias("t")).select("t.*")
    return [(r["top_word"], r["top_count"]) for r in words.orderBy(F.desc("top_count"), "top_word").limit(FREQUENT).collect()]


class Model:
    """Base figures and the parameters of the chain."""

    def __init__(self, total: int, distinct: int, mass: np.ndarray, states: int = STATES, seed: int = 3):
        self.total, self.scale, self.mass = total, total + 0.5 * (distinct + 1), mass
        base = mass / mass.sum()
        rng = np.random.default_rng(seed)
        self.base, self.states = base, states
        self.start = np.full(states, 1 / states)
        self.move = np.full((states, states), 0.5 / states) + 0.5 * np.eye(states)
        self._emit(base * (0.5 + rng.random((states, CLASSES))))

    def _emit(self, counts: np.ndarray) -> None:
        """Emissions by counts (states, classes); words never seen keep what the base leaves them in every state."""
        seen = counts.copy()
        seen[:, UNKNOWN] = 0
        seen /= np.maximum(seen.sum(axis=1, keepdims=True), 1e-300)
        seen *= 1 - self.base[UNKNOWN]
        self.emission = (1 - MIXED) * seen + MIXED * self.base
        self.emission[:, UNKNOWN] = self.base[UNKNOWN]
        self.emission /= self.emission.sum(axis=1, keepdims=True)

    def learn(self, counts: np.ndarray, moves: np.ndarray, starts: np.ndarray) -> None:
        self._emit(counts.T)
        moves = moves + 1 / self.states
        self.move = moves / moves.sum(axis=1, keepdims=True)
        self.start = (starts + 1) / (starts + 1).sum()


def encoded_blocks(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, Model]:
    """Blocks as class sequences with their texts' base figures (written), and the untrained model."""

    def split(b):
        starts, codes, words = word_codes(texts_of(b.column(text_col)))
        # the distinct words are lowered, not the texts
        lowered = pc.ascii_lower(words).dictionary_encode()
        return starts, lowered.indices.to_numpy(zero_copy_only=False)[codes].astype(np.int32), lowered.dictionary

    docs = df.select(id_col, text_col, (~held_out(id_col)).alias("train"))
    skeletons, words = word_blocks(docs, id_col, text_col, split, ["train"], BLOCK_BYTES)
    told = skeletons.agg(F.sum("tokens"), F.sum(F.size(F.filter("train", lambda t: t)))).first()
    texts = int(told[1] or 0)  # each ends once
    total = int(told[0] or 0) + texts
    facts = count_words(words, total)
    distinct = int(facts.agg(F.sum("distinct_words")).first()[0] or 0) + (texts > 0)
    mass = np.zeros(CLASSES)
    mass[UNKNOWN], mass[END] = 0.5, texts + 0.5 if texts else 0
    masses = facts.where("mass is not null").select(F.explode(F.arrays_zip("mass_class", "mass")).alias("m"))
    for r in masses.groupBy("m.mass_class").agg(F.sum("m.mass").alias("mass")).collect():  # at most CLASSES rows
        mass[r["mass_class"]] += r["mass"]
    top = frequent_words(facts)
    if top:  # their mass moves from the class that they would share to their own
        np.subtract.at(mass, shared_class(pa.array([w for w, _ in top], pa.large_string())), np.array([c + 0.5 for _, c in top]))
        mass[: len(top)] = [c + 0.5 for _, c in top]
        mass[np.abs(mass) < 0.25] = 0  # of a class that only frequent words shared: rounding is left
    own = df.sparkSession.sparkContext.broadcast({w: i for i, (w, _) in enumerate(top)})  # at most FREQUENT words
    model = Model(total, distinct, mass)
    scale, end_class = model.scale, END if texts else UNKNOWN
    kind = df.schema[id_col].dataType
    out = StructType([
        StructField(id_col, ArrayType(kind)), StructField("train", ArrayType(BooleanType())),
        StructField("known", ArrayType(LongType())), StructField("base", ArrayType(DoubleType())),
        StructField("within", ArrayType(DoubleType())), StructField("sizes", BinaryType()), StructField("classes", BinaryType()),
    ])

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                facts = b.column("facts")[i].as_py() or []
                entries = [entries_of(f["entries"]) for f in facts]
                count_of = np.zeros(max((int(e.max()) for e in entries), default=-1) + 1, np.int64)
                class_by = np.full(len(count_of), -1, np.int64)
                for e, f in zip(entries, facts):
                    count_of[e] = unpacked(f["counts"])
                    found = unpacked(f["classes"]).astype(np.int64)
                    for at, w in zip(unpacked(f["often_at"]), f["often"]):
                        found[at] = own.value.get(w, found[at])
                    class_by[e] = found
                codes = unpacked(b.column("codes")[i].as_py())
                sizes = unpacked(b.column("sizes")[i].as_py()).astype(np.int64)
                ends = np.cumsum(sizes)
                counts = np.insert(count_of[codes], ends, texts)
                classes = np.insert(class_by[codes], ends, end_class)
                if (classes < 0).any():
                    raise ValueError("a word of the block has no count")
                cuts = np.concatenate(([0], np.cumsum(sizes + 1)))
                sums = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[cuts])
                base = np.add.reduceat(np.log10((counts + 0.5) / scale), cuts[:-1])
                within = np.add.reduceat(np.log10((counts + 0.5) / mass[classes]), cuts[:-1])
                columns = [b.column(id_col)[i].values, b.column("train")[i].values, pa.array(sums(counts > 0)), pa.array(base), pa.array(within)]
                lists = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in columns]
                yield pa.RecordBatch.from_arrays([*lists, pa.array([packed(sizes + 1)]), pa.array([packed(classes)])], names=out.fieldNames())

    return written(with_facts(skeletons, facts, ["entries", "counts", "classes", "often_at", "often"]).mapInArrow(run, out), "encoded", "uncompressed"), model


def _runs(sizes: np.ndarray) -> list[np.ndarray]:
    """Texts in runs of similar size with about RUN_TOKENS tokens."""
    order = np.argsort(-sizes, kind="stable")
    run = np.cumsum(sizes[order]) // RUN_TOKENS
    return np.split(order, np.flatnonzero(np.diff(run)) + 1) if len(order) else []


def _expected(blocks: DataFrame, model: Model):
    """(counts, moves, starts, log likelihood) over the training texts of all blocks."""
    shared = blocks.sparkSession.sparkContext.broadcast((model.start, model.move, model.emission))  # classes x states numbers
    states = model.states
    names = ["row", *(f"s{i}" for i in range(states))]

    def run(batches):
        start, move, emission = shared.value
        counts, moves, starts, loglik = np.zeros((CLASSES, states)), np.zeros((states, states)), np.zeros(states), 0.0
        for b in batches:
            for i in range(b.num_rows):
                train = b.column("train")[i].values.to_numpy(zero_copy_only=False)
                sizes, classes = unpacked(b.column("sizes")[i].as_py()).astype(np.int64), unpacked(b.column("classes")[i].as_py())
                classes, sizes = classes[np.repeat(train, sizes)], sizes[train]
                found = expected_counts(sizes, classes, start, move, emission)
                counts += found[0]
                moves += found[1]
                starts += found[2]
                loglik += found[3]
        held = np.flatnonzero(counts.any(axis=1))
        table = np.concatenate((counts[held], moves, starts[None], np.full((1, states), loglik / states)))
        rows = np.concatenate((held, -1 - np.arange(states + 2)))
        yield pa.RecordBatch.from_arrays([pa.array(rows), *(pa.array(table[:, s]) for s in range(states))], names=names)

    sums = blocks.select("train", "sizes", "classes").mapInArrow(run, "row long, " + ", ".join(f"{n} double" for n in names[1:]))
    counts, moves, starts, loglik = np.zeros((CLASSES, states)), np.zeros((states, states)), np.zeros(states), 0.0
    for r in sums.groupBy("row").agg(*(F.sum(n).alias(n) for n in names[1:])).collect():
        k, v = r["row"], np.array(r[1:], float)
        if k >= 0:
            counts[k] = v
        elif -k <= states:
            moves[-1 - k] = v
        elif -k == states + 1:
            starts = v
        else:
            loglik = float(v.sum())
    return counts, moves, starts, loglik


def train(blocks: DataFrame, model: Model, rounds: int = ROUNDS) -> list[float]:
    """Baum-Welch rounds; the log likelihood of the training texts before each."""
    told = []
    for _ in range(rounds):
        counts, moves, starts, loglik = _expected(blocks, model)
        model.learn(counts, moves, starts)
        told.append(loglik)
    return told


def score_texts(blocks: DataFrame, model: Model, id_col: str) -> DataFrame:
    """One row per text: id, train, n_tokens, n_known, base_score, score (log10)."""
    kind = blocks.schema[id_col].dataType.elementType
    shared = blocks.sparkSession.sparkContext.broadcast((model.start, model.move, model.emission))
    out = StructType([
        StructField(id_col, kind), StructField("train", BooleanType()), StructField("n_tokens", LongType()),
        StructField("n_known", LongType()), StructField("base_score", DoubleType()), StructField("score", DoubleType()),
    ])

    def run(batches):
        start, move, emission = shared.value
        for b in batches:
            for i in range(b.num_rows):
                sizes, classes = unpacked(b.column("sizes")[i].as_py()).astype(np.int64), unpacked(b.column("classes")[i].as_py())
                loglik = np.zeros(len(sizes))
                for own, time, line in _lines(sizes, classes):
                    loglik[own[time.order]] = forward(time, line, start, move, emission)
                within = b.column("within")[i].values.to_numpy()
                columns = [b.column(id_col)[i].values, b.column("train")[i].values, pa.array(sizes), b.column("known")[i].values, b.column("base")[i].values, pa.array(loglik / np.log(10) + within)]
                yield pa.RecordBatch.from_arrays(columns, names=out.fieldNames())

    return blocks.mapInArrow(run, out)


def op5_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    blocks, model = encoded_blocks(docs, "doc_id", "text")
    train(blocks, model)
    return score_texts(blocks, model, "doc_id").select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score",
    )
