import random

import pytest

LONG = " ".join(random.Random(5).choices("alpha beta gamma delta epsilon zeta eta theta. iota kappa".split(), k=30_000))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in any column, empty, blank and very long texts, ties and repeated rows."""
    words = "one two three four five six seven eight nine ten eleven twelve".split()
    text = " ".join(words)
    return [
        (1, text, "en", "a", 10),
        (2, None, "en", "a", None),
        (3, "", None, None, 0),
        (3, "", None, None, 0),
        (None, text, "en", "b", 5),
        (4, " \t\n ", "de", "b", 4),
        (5, LONG, "en", "c", len(LONG)),
        (6, text, "en", "a", 10),
        (6, text, "en", "a", 10),
        (7, "é́ 漢字 👍 <|endoftext|> </turn> \\### x", "fr", "c", 3),
        (8, "two words", "en", "c", 9),
        (None, None, None, None, None),
    ]


DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: names that operators use for their own columns
CLASHES = "kept string, score string, predicted string, shard string, slot string, hilbert string, rank string, n_words string, clean_text string, ids string, length string, block string, row string, class_id string, id string, key string, hash string, side string, word string, n string, start string"


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The rows with extra columns whose names clash with those of operators."""
    extra = CLASHES.count(",") + 1
    return spark.createDataFrame([(*r, *["x"] * extra) for r in odd_rows], f"{DOC_SCHEMA}, {CLASHES}")


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def texts(spark, small):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
