import hashlib
import re
from collections import Counter

import numpy as np

from pyspark.sql import functions as F

from loglake.llm.fingerprint import fingerprints, op4_weighted_sampling, samples


def weights(text):
    return Counter(re.findall(r"[^\x20\x09-\x0D]+", text)) or Counter([""])


def jaccard(a, b):
    a, b = weights(a), weights(b)
    return sum((a & b).values()) / sum((a | b).values())


def test_query_against_exact_similarity(spark, small, texts):
    rows = {r["doc_id"]: r for r in op4_weighted_sampling(spark, small).collect()}
    texts = sorted(texts)
    assert len(rows) == len(texts)
    errors, by_text = [], {}
    for i, (doc, text) in enumerate(texts):
        follows, r = texts[(i + 1) % len(texts)][1], rows[doc]
        k = len(text) // 4
        edited = text[: len(text) - k] + follows[:k]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        errors += [r["near_edited"] - jaccard(text, edited), r["near_next"] - jaccard(text, follows)]
        assert by_text.setdefault(text, r["fingerprint"]) == r["fingerprint"]
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.09


def test_odd_tables(odd, none):
    rows = fingerprints(odd).collect()
    assert len(rows) == odd.count()
    prints = {}
    for r in rows:
        prints.setdefault(r["doc_id"], set()).add(r["fingerprint"])
    assert prints[2] == prints[3] == prints[4] != prints[8]  # no words: alike
    assert prints[1] == prints[6] and prints[1] <= prints[None]
    empty = [r for r in rows if r["doc_id"] == 3]
    assert len(empty) == 2 and all(r["n_chars"] == 0 and 0 <= r["near_next"] <= 1 for r in empty)
    assert fingerprints(none).count() == 0
    one = fingerprints(odd.where("doc_id = 8")).collect()
    assert [r["near_next"] for r in one] == [1.0]


def test_left_out_draws_change_no_sample(spark, odd):
    words = [f"w{i * i % 97}" for i in range(400)]
    made = spark.createDataFrame([(i, " ".join(words[i : i + 3 * i]), "en", "a", 0) for i in range(1, 40)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = odd.select(made.columns).unionByName(made)
    plain = docs.select(F.monotonically_increasing_id().alias("k"), F.coalesce("text", F.lit("")).alias("text")).localCheckpoint()
    part = F.array(*(F.struct(F.trim("text").alias("text"), (F.lit(i) == 0).alias("blank"), F.lit(1).alias("w0"), F.lit(i).alias("w1")) for i in (0, 1, 3)))
    keyed = plain.select("k", part.alias("pieces"))
    drawn = {reach: {r["k"]: r for r in samples(keyed, ["k"], "pieces", ["a", "b"], reach=reach).collect()} for reach in (None, 12.0, 2.0)}
    assert all(r["sure"] for r in drawn[None].values()) and not all(r["sure"] for r in drawn[2.0].values())
    for reach in (12.0, 2.0):
        assert drawn[reach].keys() == drawn[None].keys() or reach == 2.0
        for k, r in drawn[reach].items():
            assert not r["sure"] or (r["samples_a"], r["samples_b"]) == (drawn[None][k]["samples_a"], drawn[None][k]["samples_b"])
    # whatever is left out, texts that are not sure are sampled again
    want = sorted(map(str, fingerprints(docs).collect()))
    assert sorted(map(str, fingerprints(docs, reach=2.0).collect())) == sorted(map(str, fingerprints(docs, reach=0.01).collect())) == want
