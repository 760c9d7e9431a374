"""A training-data pipeline over ``documents``: quality, toxicity, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's ``docs``; all but the last return the columns of ``documents``. Part of the subpackage ``loglake.llm``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglake.llm.neardup import similarity_join
from loglake.llm.packing import pack, token_pieces
from loglake.llm.quality import quality_rules
from loglake.llm.scratch import written
from loglake.llm.toxicity import score_toxicity, train, training_sample

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, without their failing lines; ``n_chars`` is that of the text that stays."""
    kept = quality_rules(docs.select(*COLUMNS)).where("kept")
    clean = F.col("clean_text")
    return kept.select("doc_id", clean.alias("text"), "lang", "source", F.char_length(clean).cast("long").alias("n_chars"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network, trained on the labelled ones among them, does not call toxic."""
    net = train(*training_sample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return score_toxicity(docs.select(*COLUMNS), net).where("predicted = 0").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: that with the least id."""
    docs = docs.select(*COLUMNS)
    first = similarity_join(docs).where("first").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    match = (F.col("_hash") == F.xxhash64("text")) & F.col("_id").eqNullSafe(F.col("doc_id"))
    kept = docs.join(first, match, "left_semi")
    # rows that repeat an id and its text are one class, of which the join lets each pass; texts without words stay apart
    return kept.groupBy("doc_id", F.xxhash64("text").alias("_hash")).agg(F.first(F.struct(*COLUMNS)).alias("d")).select("d.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents' token ids, each with its place in a sequence of at most 4096."""
    import public_tokenizers

    pieces = token_pieces(docs, public_tokenizers.path("word_bpe_49k.json")).withColumn("ids_crc32", F.crc32("ids"))
    return pack(pieces, ["doc_id", "start", "ids", "ids_crc32", "doc_tokens"])


STAGES = [
    ("quality rules", quality),
    ("toxicity", toxicity),
    ("n-gram Jaccard join", near_duplicates),
    ("packing", packing),
]

#: no SQL for rules, networks and tokenizers; tests/llm compares with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, f"stage{i}")
    return docs
