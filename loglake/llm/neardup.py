"""N-gram Jaccard self-join by a MinHash LSH forest, with exact verification.

Texts are sets of 5-word shingles. Rows of equal sets are one node. Each of ``TREES`` trees holds a node's signature of
``LONGEST`` minima; nodes that share a prefix in one tree are candidates. ``prefix_length`` shortens the prefix from the
full length on until the expected recall at the threshold reaches the target. The shuffle sorts the prefixes, so a trie
node is a run of equal keys.

* Trie nodes of up to ``SMALL`` texts give their pairs; each pair is verified once on the texts.
* Larger ones are joined to dense groups (components over stars, never all pairs). A dense group is dealt into blocks,
  each pair of blocks is one task's tile, and a tile counts the shared shingles of all its pairs exactly by products of
  0/1 matrices. A tile returns one row per text, so no pairs are emitted, and no group meets in one task.

Classes are the components of the verified links. Result: one row per input row. ``class_id`` is the least id in its
class; ``n_links`` counts the other rows with similarity of ``THRESHOLD`` or more, copies included; ``first`` marks one
row of each class (least id, then least row). Null or wordless texts have no shingles: no links, their own id as class,
``first`` true. A text of 1 to 4 words is one shingle. Null ids come last among the ids of a class. Repeated rows are
rows as any other. An empty table gives an empty result. Extra columns are not used and not returned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from loglake.llm.components import components
from loglake.llm.scratch import written
from loglake.llm.shingles import shingle_sets, signatures
from loglake.llm.text import add_columns, mix, texts_of
from loglake.operators.sizing import broadcast_if_small

THRESHOLD, RECALL = 0.8, 0.9999
TREES, LONGEST = 40, 12
SMALL = 8
#: a dense group's block, in texts and characters
BLOCK_TEXTS, BLOCK_CHARS = 256, 4 << 20


def prefix_length(trees: int = TREES, longest: int = LONGEST, threshold: float = THRESHOLD, recall: float = RECALL) -> int:
    """The longest prefix whose matches in any of the trees find a pair at the threshold with the wanted probability."""
    for length in range(longest, 0, -1):
        if 1 - (1 - threshold**length) ** trees >= recall:
            return length
    raise ValueError("too few trees for this recall")


def tree_keys(signature: np.ndarray, length: int, trees: int = TREES) -> np.ndarray:
    """(texts, trees): a key of each tree's number and prefix."""
    out = np.empty((len(signature), trees), np.uint64)
    with np.errstate(over="ignore"):
        for t in range(trees):
            key = np.full(len(signature), t + 1, np.uint64)
            for i in range(length):
                key = key * np.uint64(0x9E3779B97F4A7C15) + signature[:, t * length + i]
            out[:, t] = mix(key)
    return out


_SIGNED = StructType([
    StructField("n", LongType()), StructField("h1", LongType()), StructField("h2", LongType()),
    StructField("keys", ArrayType(LongType())),
])


def _signed(texts: pa.Array, length: int) -> list:
    starts, values = shingle_sets(texts)
    n = np.diff(starts)
    full = np.flatnonzero(n)
    sums = []
    for salt in (0x1234567, 0x89ABCDE):
        s = np.zeros(len(n), np.uint64)
        if len(full):
            s[full] = np.add.reduceat(mix(values ^ np.uint64(salt)), starts[full])
        sums.append(pa.array(s.view(np.int64)))
    keys = tree_keys(signatures(starts, values, TREES * length), length)
    flat = pa.array(keys.ravel().view(np.int64))
    return [pa.array(n), *sums, pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * TREES), flat)]


def shared(starts: np.ndarray, values: np.ndarray, split: int) -> np.ndarray:
    """(split, rest): how many shingles each of the first ``split`` texts shares with each of the others."""
    _, column, count = np.unique(values, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    often = count[column] > 1
    owner = owner[often]
    _, column = np.unique(column[often], return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    n, out, width = len(starts) - 1, np.zeros((split, len(starts) - 1 - split), np.float64), 4096
    last = int(column[-1]) + 1 if len(column) else 0
    for a in range(0, last, width):
        i = slice(*np.searchsorted(column, (a, a + width)))
        m = np.zeros((n, min(width, last - a)), np.float32)
        m[owner[i], column[i] - a] = 1
        out += m[:split] @ m[split:].T
    return out


def _tile(key, table: pa.Table) -> pa.Table:
    """Links of one pair of blocks, or of one block: a row per text that has any."""
    block = table.column("block").to_numpy()
    order = np.argsort(block, kind="stable")
    table = table.take(pa.array(order))
    one_block = key[1].as_py() == key[2].as_py()
    starts, values = shingle_sets(texts_of(table.column("text")))
    rep, copies = table.column("rep").to_numpy(), table.column("copies").to_numpy()
    n = np.diff(starts)
    if one_block:
        split = len(n)
        both = np.concatenate((starts, starts[1:] + starts[-1]))
        common = shared(both, np.concatenate((values, values)), split)
        left = right = np.arange(split)
    else:
        split = int((block == key[1].as_py()).sum())
        common = shared(starts, values, split)
        left, right = np.arange(split), np.arange(split, len(n))
    union = n[left][:, None] + n[right][None, :] - common
    linked = common >= THRESHOLD * union - 1e-9
    links, root = np.zeros(len(n), np.int64), rep.copy()
    if one_block:
        np.fill_diagonal(linked, False)
    links[left] += linked.astype(np.int64) @ copies[right]
    if not one_block:
        links[right] += copies[left] @ linked.astype(np.int64)
    a, b = np.nonzero(linked)
    a, b = left[a], right[b]
    while True:  # least representative within the tile
        before = root.copy()
        np.minimum.at(root, a, root[b])
        np.minimum.at(root, b, root[a])
        if (root == before).all():
            break
    keep = links > 0
    return pa.table({"rep": rep[keep], "links": links[keep], "root": root[keep]})


def _pairs_alike(batches):
    """Verified pairs among rows a, b, text_a, text_b."""
    for whole in batches:
        for at in range(0, whole.num_rows, 1000):
            b = whole.slice(at, 1000)
            sets = [shingle_sets(texts_of(b.column(c))) for c in ("text_a", "text_b")]
            owner = [np.repeat(np.arange(b.num_rows), np.diff(s)) for s, _ in sets]
            own, value = np.concatenate(owner), np.concatenate([v for _, v in sets])
            order = np.lexsort((value, own))
            own, value = own[order], value[order]
            same = (own[1:] == own[:-1]) & (value[1:] == value[:-1])
            common = np.bincount(own[1:][same], minlength=b.num_rows)
            union = np.diff(sets[0][0]) + np.diff(sets[1][0]) - common
            yield b.select(["a", "b"]).filter(pa.array(common >= THRESHOLD * union - 1e-9))


def similarity_join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: id, text_hash, class_id, n_links, first."""
    length = prefix_length()
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash"))
    signed = add_columns(docs, "text", lambda b: _signed(texts_of(b.column("text")), length), _SIGNED).drop("text")
    signed = written(signed.withColumn("row", F.monotonically_increasing_id()), "signed")

    rank = F.struct(F.col("id").isNull().alias("last"), "id", "row")
    sets = signed.where("n > 0").groupBy("h1", "h2", "n").agg(F.min("row").alias("rep"), F.count(F.lit(1)).alias("copies"), F.min(rank).alias("least"))
    sets = written(sets, "sets")
    node = signed.join(sets.select("rep", "copies"), F.col("row") == F.col("rep")).select("rep", "id", "text_hash", "copies", "keys")

    placed = node.select("rep", F.explode("keys").alias("key"))
    runs = placed.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("rep").alias("hub")).where("size > 1")
    bucket = written(placed.join(runs, "key"), "buckets")

    star = bucket.where(F.col("size") > SMALL).select("rep", "hub")
    dense = components(star).select(F.col("node").alias("rep"), F.col("root").alias("group"))
    ids = bucket.where(F.col("size") <= SMALL).groupBy("key").agg(F.collect_set("rep").alias("ids"))
    pair = "explode(flatten(transform(ids, x -> transform(filter(ids, y -> y > x), y -> struct(x as a, y as b))))) as p"
    pairs = ids.selectExpr(pair).select("p.a", "p.b").distinct()
    group = [dense.select(F.col("rep").alias(c), F.col("group").alias(f"group_{c}")) for c in "ab"]
    pairs = pairs.join(group[0], "a", "left").join(group[1], "b", "left").where("group_a is null or group_b is null or group_a <> group_b")
    pairs = written(pairs.select("a", "b"), "pairs")

    needed = pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).union(dense.select("rep")).distinct()
    wanted = broadcast_if_small(node.drop("keys").join(needed, "rep"))
    texts = docs.alias("d").join(wanted.alias("w"), F.expr("d.text_hash = w.text_hash and d.id <=> w.id"))
    # repeated rows of one id and text are one node
    texts = written(texts.select("rep", "copies", "text").dropDuplicates(["rep"]), "texts")

    tile = _tiles(texts, dense).groupBy("group", "i", "j").applyInArrow(lambda key, rows: _tile(key, rows), "rep long, links long, root long")
    tile = written(tile, "tiles")
    side = [texts.select(F.col("rep").alias(c), F.col("text").alias(f"text_{c}"), F.col("copies").alias(f"copies_{c}")) for c in "ab"]
    alike = pairs.join(side[0].drop("copies_a"), "a").join(side[1].drop("copies_b"), "b").select("a", "b", "text_a", "text_b")
    alike = written(alike.mapInArrow(_pairs_alike, "a long, b long"), "alike")

    counted = alike.join(side[1].select("b", "copies_b"), "b").select(F.col("a").alias("rep"), F.col("copies_b").alias("links"))
    counted = counted.union(alike.join(side[0].select("a", "copies_a"), "a").select("b", "copies_a"))
    links = counted.union(tile.select("rep", "links")).groupBy("rep").agg(F.sum("links").alias("links"))
    root = components(alike.toDF("u", "v").union(tile.select("rep", "root").toDF("u", "v")))

    # classes are settled over distinct sets; copies meet them in one last join
    found = sets.join(links, "rep", "left").join(root.withColumnRenamed("node", "rep"), "rep", "left")
    found = written(found.withColumn("root", F.coalesce("root", "rep")), "found")
    least = found.groupBy("root").agg(F.min("least").alias("class"))
    found = found.join(least, "root").select(
        "h1", "h2", "n", F.col("class.id").alias("class_id"), F.col("class.row").alias("first_row"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    found = signed.where("n > 0").select("h1", "h2", "n", "id", "text_hash", "row").join(found, ["h1", "h2", "n"])
    found = found.select("id", "text_hash", "class_id", "n_links", (F.col("row") == F.col("first_row")).alias("first"))
    alone = signed.where("n = 0").select("id", "text_hash", F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(True).alias("first"))
    return found.union(alone).withColumnRenamed("id", id_col)


def _tiles(texts: DataFrame, dense: DataFrame) -> DataFrame:
    """Each text of a dense group once for every tile of its block: group, i <= j, block, rep, copies, text."""
    own = texts.join(dense, "rep")
    size = own.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.sum(F.char_length("text")).alias("chars"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_TEXTS), F.ceil(F.col("chars") / BLOCK_CHARS))
    # a row per group, broadcast only if they are few: a hot group then stays where its texts lie
    dealt = own.join(broadcast_if_small(size.select("group", blocks.cast("int").alias("blocks"))), "group")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    other = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return other.select("group", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "rep", "copies", "text")


def op2_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return similarity_join(docs).select("doc_id", "class_id", "n_links")
