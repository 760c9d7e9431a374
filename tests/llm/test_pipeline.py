import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as P
from loglake.llm.quality import quality_rules
from test_neardup import brute


def test_stages_against_brute_force(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet").cache()
    kept = P.quality(spark, docs, medium).cache()
    assert kept.columns == docs.columns
    verdict = {r["doc_id"]: r for r in quality_rules(docs).collect()}
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in kept.collect()} == {d: (r["clean_text"], len(r["clean_text"])) for d, r in verdict.items() if r["kept"]}

    clean = P.toxicity(spark, kept, medium).cache()
    assert clean.columns == docs.columns
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{medium}/labels.parquet").collect()}
    left, before = {r["doc_id"] for r in clean.collect()}, {r["doc_id"] for r in kept.collect()}
    gone = before - left
    assert gone and sum(labels.get(d) == 0 for d in before & left) >= 0.98 * sum(labels.get(d) == 0 for d in before)

    unique = P.near_duplicates(spark, clean, medium).cache()
    assert unique.columns == docs.columns
    classes = {}
    for d, c, _ in brute([(r["doc_id"], r["text"]) for r in clean.collect()]):
        classes.setdefault(c, []).append(d)
    assert sorted(r["doc_id"] for r in unique.collect()) == sorted(min(v) for v in classes.values())

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = P.packing(spark, unique, medium).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        got.setdefault(r["doc_id"], []).extend(np.frombuffer(r["ids"], "<u4").tolist())
    assert got == {r["doc_id"]: tokenizer.encode(r["text"], add_special_tokens=False).ids + [2] for r in unique.collect()}


def test_odd_tables(spark, odd, none, small):
    for docs in (odd, none):
        for name, stage in P.STAGES[:3]:
            out = stage(spark, docs, small)
            assert out.columns == P.COLUMNS, name
            out.count()
        P.packing(spark, docs, small).count()


def test_repeated_rows_become_one(spark, small, odd):
    kept = P.near_duplicates(spark, odd, small)
    assert kept.where("doc_id = 6 or doc_id = 1").count() == 1


def test_run(spark, small):
    rows = P.run(spark, small).collect()
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert rows and all(sum(n for _, n in v) <= 4096 for v in by_sequence.values())
