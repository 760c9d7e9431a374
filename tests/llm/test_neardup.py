import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from loglake.llm.neardup import prefix_length, shared, similarity_join
from loglake.llm.shingles import shingle_sets


def shingles(text):
    w = (text or "").split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(docs):
    """(class, links) of each row by all pairs."""
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * len(docs)
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    for i, s in enumerate(sets):
        common = defaultdict(int)
        for x in s:
            for j in holders[x]:
                common[j] += 1
        for j, c in common.items():
            if j != i and c >= 0.8 * (len(s) + len(sets[j]) - c) - 1e-9:
                links[i] += 1
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(docs):
        r = find(i)
        least[r] = min((x for x in (least.get(r), d) if x is not None), default=None)
    return sorted(((d, least[find(i)], links[i]) for i, (d, _) in enumerate(docs)), key=str)


def check(df):
    docs = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    rows = similarity_join(df).collect()
    assert sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in rows), key=str) == brute(docs)
    return rows


def test_prefix_is_the_longest_that_reaches_the_recall():
    n = prefix_length()
    assert 1 - (1 - 0.8**n) ** 40 >= 0.9999 > 1 - (1 - 0.8 ** (n + 1)) ** 40
    with pytest.raises(ValueError):
        prefix_length(trees=1)


def test_shared_counts():
    texts = ["a b c d e f g", "a b c d e f x", "b c d e f g h", "", "q r s t u"]
    starts, values = shingle_sets(pa.array(texts, pa.large_string()))
    want = [[len(shingles(a) & shingles(b)) for b in texts[2:]] for a in texts[:2]]
    assert np.array_equal(shared(starts, values, 2), want)


def test_documents(spark, medium):
    rows = check(spark.read.parquet(f"{medium}/documents.parquet"))
    assert any(r["n_links"] for r in rows)
    per_class = defaultdict(int)
    for r in rows:
        per_class[r["class_id"]] += r["first"]
    assert set(per_class.values()) == {1}


def test_dense_group_of_near_copies(spark):
    r = random.Random(4)
    words = [f"w{r.randint(0, 500)}" for _ in range(200)]
    docs = []
    for i in range(700):  # several tiles
        w = list(words)
        for _ in range(r.randint(0, 4)):
            w[r.randint(0, 199)] = f"x{r.randint(0, 50)}"
        docs.append((i, " ".join(w)))
    docs += [(1000 + i, " ".join(words)) for i in range(50)]
    check(spark.createDataFrame(docs, "doc_id long, text string").repartition(5))


def test_odd_tables(odd, none):
    rows = check(odd)
    firsts = [r for r in rows if r["first"]]
    assert len(firsts) == len({r["class_id"] for r in rows if r["n_links"]}) + sum(r["n_links"] == 0 for r in rows)
    assert similarity_join(none).count() == 0
