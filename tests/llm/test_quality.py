import re
from collections import Counter

import pyarrow as pa

from loglake.llm.quality import MAX_LOST, judge, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), failed)


def test_base_figures_match_brute_force(spark, odd, texts, small):
    for df in (odd, spark.read.parquet(f"{small}/documents.parquet")):
        rows = quality_rules(df).collect()
        assert len(rows) == df.count()
        for r in rows:
            got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
            assert got == base(r["text"]), r["doc_id"]
            assert r["kept"] == (not r["base_failed"] and r["lost_share"] <= MAX_LOST)


def test_line_rules():
    good = "This is a plain sentence with enough words to pass every rule of the list, one after another and so on."
    other = "Here stands quite another sentence, so that no window of eight words comes again in this short text."
    bad = ["Home | About | Contact | Help |", "BUY!! NOW!! CHEAP!!", "a$$$ b### c%%% d***", "All rights reserved.", "du " * 30]
    for line in bad:
        r = judge(pa.array([f"{good}\n{line}\n{other}"], pa.large_string()))
        assert r[7].to_pylist() == [1] and line not in r[10][0].as_py() and good in r[10][0].as_py()
    r = judge(pa.array([f"{good}\n\n{good}\n{other}"], pa.large_string()))
    assert r[10][0].as_py() == f"{good}\n\n{other}"  # a copied line goes, its first copy and blank lines stay
    r = judge(pa.array(["\n".join([good, *(f"{i} | {i} | {i} | {i} |" * 9 for i in range(9))])], pa.large_string()))
    assert r[9].to_pylist() == [False]


def test_clean_documents_stay_and_junk_goes(spark, medium):
    docs, labels = (spark.read.parquet(f"{medium}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_rules(docs).join(labels, "doc_id").collect()
    clean = [r for r in rows if r["quality"] == 1 and not r["base_failed"]]
    assert sum(r["kept"] for r in clean) == len(clean)
    assert not any(r["kept"] for r in rows if r["quality"] == 0)


def test_odd_tables(odd, none):
    out = quality_rules(odd)
    assert out.columns.count("kept") == 1 and dict(out.dtypes)["kept"] == "boolean" and dict(out.dtypes)["shard"] == "string"
    assert all(r["n_words"] == 0 and not r["kept"] and r["clean_text"] == "" for r in out.where("text is null").collect())
    assert quality_rules(none).count() == 0
