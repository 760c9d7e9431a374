import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loglake.llm.hilbert import curve_index, hilbert_shards, op9_hilbert_shards, write_shards


@pytest.mark.parametrize("dims, bits", [(1, 4), (2, 4), (3, 3), (4, 2)])
def test_curve_visits_each_cell_by_unit_steps(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    index = curve_index(cells, bits)
    assert sorted(index) == list(range(len(cells)))
    path = cells[np.argsort(index)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def check(rows, shards):
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())
    sizes = [len(by_shard.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and set(by_shard) <= set(range(shards))


def test_query(spark, small, texts):
    rows = op9_hilbert_shards(spark, small).collect()
    check(rows, 24)
    got = {r["doc_id"]: (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) for r in rows}
    want = {d: (len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), "rows", None) for d, t in texts}
    assert got == want and len(rows) == len(texts)


def test_odd_tables(odd, none):
    rows = hilbert_shards(odd, ["lang", "source", "n_chars"], ["doc_id"], 5).collect()
    assert len(rows) == odd.count() and rows[0]["kept"] == "x"
    check(rows, 5)
    twice = odd.withColumn("n_total", F.lit("y"))
    rows = hilbert_shards(twice, ["lang", "rank"], ["doc_id", "n_total"], 5).collect()
    assert all(r["rank"] == "x" and r["n_total"] == "y" for r in rows)  # other columns stay
    assert hilbert_shards(none, ["lang", "n_chars"], ["doc_id"], 5).count() == 0


def test_strings_that_begin_alike_are_told_apart(spark):
    rows = [(i, f"https://example.org/{'abcdefgh'[i % 8]}/page") for i in range(800)]
    out = hilbert_shards(spark.createDataFrame(rows, "doc_id long, source string"), ["source"], ["doc_id"], 8).collect()
    by_shard = {}
    for r in out:
        by_shard.setdefault(r["shard"], set()).add(r["source"])
    assert all(len(v) == 1 for v in by_shard.values()) and len(by_shard) == 8


def test_files_of_a_shard_prune_several_dimensions(spark, medium, tmp_path):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    out = hilbert_shards(docs, ["lang", "source", "n_chars"], ["doc_id"], 24)
    write_shards(out, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == docs.count()
    spread = lambda df: df.selectExpr("count(distinct lang) l", "count(distinct source) s").first()
    per_shard = back.groupBy("shard").agg({"lang": "approx_count_distinct", "source": "approx_count_distinct"}).toPandas()
    whole = spread(docs)
    assert per_shard.iloc[:, 1:].mean().sum() < 0.8 * (whole["l"] + whole["s"])
