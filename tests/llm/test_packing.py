import itertools
import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from loglake.llm.packing import closest_fill, op7_min_bin_slack, pack, plan_windows, token_pieces

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_closest_fill_is_the_best_sum():
    r = random.Random(2)
    for _ in range(300):
        counts = {r.randint(1, 12): r.randint(1, 3) for _ in range(r.randint(1, 5))}
        room = r.randint(0, 30)
        taken = closest_fill(sorted(counts, reverse=True), counts, room)
        sums = {sum(x * k for x, k in zip(counts, ks)) for ks in itertools.product(*(range(c + 1) for c in counts.values()))}
        assert all(0 < k <= counts[x] for x, k in taken.items())
        assert sum(x * k for x, k in taken.items()) == max(s for s in sums if s <= room)


def test_plan_uses_each_piece_once_with_little_slack():
    r = random.Random(3)
    histogram = {}
    for _ in range(5000):
        x = r.choice([r.randint(1, 4095), r.randint(1, 500)])
        histogram[x] = histogram.get(x, 0) + 1
    used, windows = {}, {}
    for x, first, last, k, sequence, offset in plan_windows(histogram):
        assert used.get(x, 0) == first and (last - first) % k == 0
        used[x] = last
        for i in range((last - first) // k):
            windows.setdefault(sequence + i, []).extend((offset + j * x, x) for j in range(k))
    assert used == histogram and sorted(windows) == list(range(len(windows)))
    for held in windows.values():
        at = 0
        for offset, x in sorted(held):
            assert offset == at
            at += x
        assert at <= 4096
    least = -(-sum(x * c for x, c in histogram.items()) // 4096)
    assert len(windows) <= least * 1.01 + 1
    assert plan_windows({}) == []


def check(rows, docs, capacity=4096):
    """Each id in one piece, pieces gapless in sequences."""
    tokenizer, by_seq, by_doc = Tokenizer.from_file(PATH), {}, {}
    for r in rows:
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
    for held in by_seq.values():
        at = 0
        for offset, n in sorted(held):
            assert offset == at
            at += n
        assert at <= capacity
    want = {}
    for doc, text in docs:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        want.setdefault(doc, []).extend((a, len(ids[a : a + capacity]), zlib.crc32(ids[a : a + capacity].tobytes()), len(ids)) for a in range(0, len(ids), capacity))
    assert {k: sorted(v) for k, v in by_doc.items()} == {k: sorted(v) for k, v in want.items()}


def test_query(spark, small, texts):
    rows = op7_min_bin_slack(spark, small).collect()
    check(rows, texts)
    total = sum(r["length"] for r in rows)
    assert len({r["sequence_id"] for r in rows}) <= -(-total // 4096) * 1.02 + 1


def test_odd_tables(odd, none):
    from pyspark.sql import functions as F

    def packed(df, capacity):
        pieces = token_pieces(df, PATH, capacity=capacity).withColumn("ids_crc32", F.crc32("ids"))
        return pack(pieces, ["doc_id", "start", "ids_crc32", "doc_tokens"], capacity).collect()

    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    for capacity in (4096, 16):
        check(packed(odd, capacity), docs, capacity)
    assert packed(none, 4096) == []
