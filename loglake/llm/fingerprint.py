"""Document fingerprints by consistent weighted sampling, in DataFrame functions alone.

A text is its words with their counts as weights. For each of ``SAMPLES`` numbers k, every (word, weight) draws from
hashes of the word and k: r and c from a gamma distribution (shape 2) and b from a uniform one, and with
t = floor(ln(weight) / r + b) the word with the least ln(c) - r (t - b) - r gives the sample (word, t). Two texts share a
sample with the probability of their generalised Jaccard similarity, sum of least weights over sum of greatest ones. A
fingerprint is the samples' 25-bit hashes, seven hex digits each; ``likeness`` is the share of equal ones.

Most draws cannot win, and their uniform numbers tell without a logarithm: the least of a text of n words is below
``REACH`` / n but for a chance of exp(-REACH), so draws that lie above for certain are left out before the rest is computed.
A text of which some sample stays above that bound is sampled again from all its draws: the samples are those of all.

Null text counts as empty; a text without words has the one term "" of weight 1, so empty texts are alike. The next
document follows in ascending id (null first), then by a hash of the text; after the last comes the first, and a single
document follows itself. Repeated rows of one id and text are one document for this order and give equal rows. An empty
table gives an empty result. Extra columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from loglake.llm.scratch import ranked, written

SAMPLES = 64
#: a larger one computes more draws to the end, a smaller one samples more texts again: with 12, one text in a thousand
REACH = 12.0
_SPACE = " \t\n\x0b\f\r"
_LOW = 25  # bits of a sample's hash


def _uniform(bits: str, shift: int, width: int) -> Column:
    return (F.shiftrightunsigned(F.col(bits), shift).bitwiseAND(F.lit((1 << width) - 1)) + 0.5) / float(1 << width)


def _rank(value: Column) -> Column:
    return ((F.greatest(value, F.lit(-63.0)) + 64) * float(1 << 31)).cast("long")


def _sample(weight_log: Column, h: Column, r: Column, b: Column, c: Column) -> Column:
    """The sample of a term as one number: its rank value in the high bits, the hash of (term, t) in the low ones."""
    t = F.floor(weight_log / r + b)
    high = F.shiftleft(_rank(c - r * (t - b + 1)), _LOW)
    return high.bitwiseOR(F.xxhash64(h, t).bitwiseAND(F.lit((1 << _LOW) - 1)))


def pieces_of_pair(text: str, edited: str, shared: Column) -> Column:
    """The words of two texts that agree in their first ``shared`` characters, as pieces with a weight for each text:
    the part up to the last white space before the difference once, then both rests; last, the term "" of a blank text."""
    common = F.regexp_extract(F.substring(F.col(text), F.lit(1), shared.cast("int")), r"(?s)^(.*[ \t\n\x0B\f\r])", 1)
    rest = lambda c: F.substring(F.col(c), F.char_length(common) + 1, F.char_length(c))
    blank = lambda c: (F.btrim(F.col(c), F.lit(_SPACE)) == "").cast("int")
    parts = [(common, F.lit(1), F.lit(1)), (rest(text), F.lit(1), F.lit(0)), (rest(edited), F.lit(0), F.lit(1))]
    named = [F.struct(F.btrim(t, F.lit(_SPACE)).alias("text"), F.lit(False).alias("blank"), x.alias("w0"), y.alias("w1")) for t, x, y in parts]
    return F.array(*named, F.struct(F.lit("").alias("text"), F.lit(True).alias("blank"), blank(text).alias("w0"), blank(edited).alias("w1")))


def samples(texts: DataFrame, key: list[str], pieces: str, sides: list[str], samples: int = SAMPLES, reach: float | None = REACH) -> DataFrame:
    """key, for each of ``sides`` an array of sample hashes, and ``sure``: whether these are the samples of all draws. With
    no ``reach`` every draw is computed, and all are.

    ``pieces`` is an array of structs: text, blank, and the weight w0, w1, ... of its words for each side. ``texts`` holds
    each key once and lies dealt by some of the key columns: nothing is shuffled again.
    """
    side = range(len(sides))
    full = "(s.blank and " + " + ".join(f"s.w{i}" for i in side) + " > 0) or s.text <> ''"
    words = lambda s: F.split(s["text"], r"[ \t\n\x0B\f\r]+")
    count = lambda i: F.aggregate(pieces, F.lit(0), lambda n, s: n + F.size(words(s)) * s[f"w{i}"])
    # words of the shorter side; blank pieces count too, which only moves the bound
    texts = texts.select(*key, pieces, F.greatest(F.lit(1), F.least(*(count(i) for i in side), F.lit(1 << 30))).alias("n"))
    key = [*key, "n"]
    rows = texts.select(*key, F.explode(pieces).alias("s")).where(full)
    rows = rows.select(*key, *(F.col(f"s.w{i}").alias(f"w{i}") for i in side), F.explode(words(F.col("s"))).alias("word"))
    weights = rows.groupBy(*key, "word").agg(*(F.sum(f"w{i}").alias(f"w{i}") for i in side))
    heaviest = F.greatest(*(F.col(f"w{i}") for i in side), F.lit(0))
    terms = weights.select(*key, F.xxhash64("word").alias("word"), *(F.log(f"w{i}").alias(f"l{i}") for i in side), (heaviest * (reach or 0.0) / F.col("n")).alias("limit"))
    numbered = terms.select("*", F.explode(F.sequence(F.lit(0), F.lit(samples - 1))).alias("_number"))
    # adds 0: a column that Spark takes for indeterminate keeps the filter below from moving ahead and hashing again for itself
    numbered = numbered.withColumn("number", F.col("_number") + F.shiftright(F.spark_partition_id(), 31)).drop("_number")
    # a word draws once for all sides, whatever its weight
    bits = numbered.select(*key, "number", "limit", *(f"l{i}" for i in side), F.xxhash64("word", "number").alias("h"), F.xxhash64("number", "word").alias("g"))
    drawn = bits.select(*key, "number", "limit", *(f"l{i}" for i in side), "h", (_uniform("h", 0, 21) * _uniform("h", 21, 21)).alias("u"), _uniform("h", 42, 21).alias("b"), (_uniform("g", 0, 31) * _uniform("g", 31, 31)).alias("v"))
    if reach is not None:
        # the exponential of a draw's rank value is -ln(v) u^(t-b+1), at least (1 - v) u / weight
        drawn = drawn.where((1 - F.col("v")) * F.col("u") <= F.col("limit"))
    final = drawn.select(*key, "number", *(f"l{i}" for i in side), "h", (-F.log("u")).alias("r"), "b", F.log(-F.log("v")).alias("c"))
    drawn_for = lambda i: F.when(F.col(f"l{i}").isNotNull(), _sample(F.col(f"l{i}"), *(F.col(x) for x in "hrbc")))
    first = final.select("*", drawn_for(0).alias("m0"))
    # mostly the weight is that of the first side, and so is the sample
    each = first.select(*key, "number", "m0", *(F.when(F.col(f"l{i}") == F.col("l0"), F.col("m0")).otherwise(drawn_for(i)).alias(f"m{i}") for i in side[1:]))
    least = each.groupBy(*key, "number").agg(*(F.min(f"m{i}").alias(f"m{i}") for i in side))
    low = lambda c: c.bitwiseAND(F.lit((1 << _LOW) - 1)).cast("int")
    ok = F.lit(True)
    if reach is not None:  # with a margin for what rounding may do to the bound
        below = F.shiftleft(_rank(F.log(F.lit(reach) / F.col("n")) - 1e-6), _LOW)
        for i in side:
            ok = ok & F.coalesce(F.col(f"m{i}") < below, F.lit(False))
    parts = least.select(*key, ok.cast("int").alias("ok"), F.struct("number", *(low(F.col(f"m{i}")).alias(f"a{i}") for i in side)).alias("part"))
    lists = parts.groupBy(*key).agg(F.array_sort(F.collect_list("part")).alias("parts"), F.sum("ok").alias("ok"))
    return lists.select(*key[:-1], *(F.col(f"parts.a{i}").alias(f"samples_{c}") for i, c in enumerate(sides)), (F.col("ok") == samples).alias("sure"))


def hexed(samples_col: str) -> Column:
    return F.lower(F.array_join(F.transform(samples_col, lambda s: F.lpad(F.hex(s), 7, "0")), ""))


def likeness(a: str, b: str, samples: int = SAMPLES) -> Column:
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same)) / float(samples)


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: float = REACH) -> DataFrame:
    """One row per row of ``df``: fingerprints of its text and of its text with the last quarter taken from the next."""
    plain = isinstance(df.schema[id_col].dataType, IntegralType)
    own = F.coalesce(F.col(id_col).cast("long"), F.lit(0)) if plain else F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = df.select(F.col(id_col).alias("id"), own.alias("key"), F.xxhash64(text, F.col(id_col).isNull()).alias("hash"), text.alias("text"))
    # the order of documents needs no texts
    slim = docs.groupBy("id", "key", "hash").agg(F.max(F.char_length("text")).alias("n"), F.count(F.lit(1)).alias("copies"))
    order = written(ranked(slim, ["id", "hash"], "order"), "ranks")
    near = lambda name, step: order.select(
        ((F.col("rank") + step + F.col("n_total")) % F.col("n_total")).alias("rank"),
        F.col("key").alias(f"{name}_key"), F.col("hash").alias(f"{name}_hash"), F.col("n").alias(f"{name}_n"),
    )
    linked = order.join(near("next", -1), "rank").join(near("prev", 1), "rank")
    linked = written(linked.drop("rank", "n_total"), "links")

    drawn = written(samples(_pairs(docs, linked), ["key", "hash", "digest"], "pieces", ["text", "edited"], reach=reach), "samples")
    # a text without any draw left has no row
    unsure = written(linked.select("key", "hash").join(drawn.where("sure"), ["key", "hash"], "left_anti"), "unsure")
    if not unsure.isEmpty():
        # with their followers, whose heads they need
        near = linked.join(unsure, ["key", "hash"], "left_semi").select("next_key", "next_hash").toDF("key", "hash").union(unsure)
        near = written(near.distinct(), "near")
        some = docs.join(near, ["key", "hash"], "left_semi"), linked.join(near, ["key", "hash"], "left_semi")
        pairs = _pairs(*some).join(unsure, ["key", "hash"], "left_semi")
        drawn = drawn.where("sure").unionByName(written(samples(pairs, ["key", "hash", "digest"], "pieces", ["text", "edited"], reach=None), "samples"))

    following = drawn.select(F.col("key").alias("next_key"), F.col("hash").alias("next_hash"), F.col("samples_text").alias("samples_next"))
    result = linked.join(drawn, ["key", "hash"]).join(following, ["next_key", "next_hash"])
    # repeated rows come back
    result = result.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return result.select(
        F.col("id").alias(id_col), F.col("n").cast("long").alias("n_chars"), F.lower(F.hex("digest")).alias("edited_sha256"),
        hexed("samples_text").alias("fingerprint"), hexed("samples_edited").alias("edited_fingerprint"),
        likeness("samples_text", "samples_edited").alias("near_edited"), likeness("samples_text", "samples_next").alias("near_next"),
    )


def _pairs(docs: DataFrame, linked: DataFrame) -> DataFrame:
    """key, hash, the digest of the edited text, and the pieces of both texts, of the documents whose follower is there."""
    # texts are shuffled once by their key; the heads that predecessors need follow them there
    wants = linked.select("key", "hash", "n", "prev_key", "prev_hash", F.expr("prev_n div 4").alias("want"))
    once = docs.drop("id").join(wants, ["key", "hash"]).groupBy("key", "hash").agg(*(F.first(c).alias(c) for c in ("text", "n", "prev_key", "prev_hash", "want")))
    heads = once.select(F.col("prev_key").alias("key"), F.col("prev_hash").alias("hash"), F.expr("substring(text, 1, cast(want as int))").alias("head"))
    pairs = once.select("key", "hash", "text", "n").join(heads, ["key", "hash"])
    edited = F.concat(F.expr("substring(text, 1, cast(n - n div 4 as int))"), F.col("head"))
    pairs = pairs.select("key", "hash", "text", "n", edited.alias("edited"))
    shared = F.expr("n - n div 4")
    return pairs.select("key", "hash", F.unhex(F.sha2("edited", 256)).alias("digest"), pieces_of_pair("text", "edited", shared).alias("pieces"))


def op4_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
