"""Ranked lexical search by an exact inner-product search over sparse ball trees.

Every document is a sparse vector of integers, one for each term that some item asks for; an item's vector holds the
integer weights of its terms. A score is their inner product. Three passes, none of which shuffles texts:

1. Tasks split texts into terms and write blocks: for each document its number of terms and how often it holds the terms
   that are asked for, and for each block how many of its documents hold a term. Spark sums these up to N, L and the
   document frequencies.
2. Blocks are read again, some thousand documents at a time make a ball tree: a node is split between the member farthest
   from its centroid and the one farthest from that, until few members, or only equal ones, are left. Coordinates are
   scaled by the square root of the term's weight, which balances rare and frequent terms and keeps inner products.
3. Every item searches the tree best-first. A node's bound is the lesser of two: from centroid c and radius r of its ball,
   q.c + |q| r, rounded up by more than floating point can lose; and from its centroid and upward radius in each single
   dimension, which is exact in integers. Subtrees whose bound is below the item's tenth score so far are left out,
   leaves are scored in exact integers. The best documents of a task stay for its next trees; Spark ranks those of all tasks.

Items are held by every task in turns of bounded size (``ITEM_BYTES`` of text), so there may be any number of them.

Null or termless texts are no documents and match nothing; an item without terms has no rows. Rows of one item id are one
item with the terms of all of them; a null item id is an item. Repeated documents are documents as any other. Equal scores
rank by ascending id, null ids last; rows equal in both are ranked in some order. Texts of any length are taken whole. No
documents or no items give an empty result. Extra columns are not used. Ids of documents are integers.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from loglake.llm.blocks import packed, ragged, unpacked
from loglake.llm.scratch import written
from loglake.llm.text import list_starts, slices, texts_of, utf8_bytes

TOP = 10
LEAF = 32  # documents
TREE = 16_384  # documents
ITEM_BYTES = 16 << 20

#: what a byte of a text becomes: A-Z in lower case, other ASCII letters and digits and all bytes of other characters as they are, the rest a space
_TERM_BYTE = np.array([b + 32 if 0x41 <= b <= 0x5A else b if chr(b).isalnum() or b >= 0x80 else 0x20 for b in range(256)], np.uint8)


def term_lists(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(starts, terms): text i has terms[starts[i]:starts[i+1]]."""
    raw, at = utf8_bytes(texts)
    plain = pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(at.tobytes()), pa.py_buffer(_TERM_BYTE[raw].tobytes())])
    lists = pc.ascii_split_whitespace(plain)
    starts, terms = list_starts(lists), lists.flatten()
    full = pc.not_equal(pc.binary_length(terms), 0)
    there = np.concatenate(([0], np.cumsum(full.to_numpy(zero_copy_only=False))))
    return there[starts], terms.filter(full)


def _of_rows(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of values[starts[i]:starts[i+1]], none of which is empty."""
    return np.add.reduceat(values, starts[:-1]) if len(starts) > 1 else values[:0]


# --- pass 1: blocks ---------------------------------------------------------------

_BLOCK = StructType(
    [
        StructField("ids", ArrayType(LongType())),
        *(StructField(c, BinaryType()) for c in ("sizes", "held", "terms", "tf")),
        StructField("n_docs", LongType()),
        StructField("n_terms", LongType()),
        StructField("df_term", ArrayType(IntegerType())),
        StructField("df", ArrayType(LongType())),
    ]
)


def term_blocks(docs: DataFrame, vocabulary: pa.Array, id_col: str, text_col: str) -> DataFrame:
    """Blocks of documents: ids, number of terms, and (packed) which terms of the vocabulary they hold how often."""
    v = len(vocabulary)

    def run(batches):
        for batch in batches:
            for b in slices(batch, text_col):
                starts, terms = term_lists(texts_of(b.column(text_col)))
                size = np.diff(starts)
                index = pc.index_in(terms, value_set=vocabulary).to_numpy(zero_copy_only=False)
                known = ~np.isnan(index) if index.dtype.kind == "f" else np.ones(len(index), bool)
                row = np.repeat(np.arange(len(size)), size)[known]
                pair, tf = np.unique(row * v + index[known].astype(np.int64), return_counts=True)
                row, term = pair // max(v, 1), pair % max(v, 1)
                held = np.bincount(row, minlength=len(size))
                some = np.flatnonzero(held)  # the others match no item
                df_term, df = np.unique(term, return_counts=True)
                ids = b.column(id_col).cast(pa.int64()).take(pa.array(some)).to_pylist()
                row = {"ids": ids, "sizes": packed(size[some]), "held": packed(held[some]), "terms": packed(term), "tf": packed(tf)}
                row |= {"n_docs": int((size > 0).sum()), "n_terms": int(size.sum()), "df_term": df_term.tolist(), "df": df.tolist()}
                kinds = [pa.list_(pa.int64()), *[pa.binary()] * 4, pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array([row[n]], k) for n, k in zip(_BLOCK.fieldNames(), kinds)], names=_BLOCK.fieldNames())

    return docs.select(id_col, text_col).mapInArrow(run, _BLOCK)


# --- pass 2: trees ----------------------------------------------------------------


class BallTree:
    """A ball tree over sparse rows: ``values[at[i]:at[i+1]]`` (positive integers) in dimensions ``dims``, none empty.

    ``order`` are the rows by leaf; a node covers a run of them and knows its children. ``bounds`` has, for each node and
    each query, an integer that no inner product of a member with the query exceeds.
    """

    def __init__(self, at: np.ndarray, dims: np.ndarray, values: np.ndarray, weights: np.ndarray, queries: list[np.ndarray], leaf: int = LEAF):
        self.n_dims = len(weights)
        root = np.sqrt(weights.astype(float))
        scaled = values * root[dims]
        square = _of_rows(scaled * scaled, at)
        size = np.diff(at)
        q_at = np.concatenate(([0], np.cumsum([len(q) for q in queries]))).astype(np.int64)
        q_dims = np.concatenate([*queries, np.zeros(0, np.int64)]).astype(np.int64)
        q_root, q_weight = root[q_dims], weights[q_dims]
        q_norm = np.sqrt(_of_rows(weights[q_dims].astype(float), q_at))
        self.span: list[tuple[int, int]] = []
        self.children: list[tuple[int, int] | None] = []
        bounds: list[np.ndarray] = []
        order = np.arange(len(size))
        work = [(0, len(size), -1, 0)]
        while work:
            a, z, parent, side = work.pop()
            me = len(self.span)
            self.span.append((a, z))
            self.children.append(None)
            if parent >= 0:
                left = self.children[parent]
                self.children[parent] = (me, left[1]) if side == 0 else (left[0], me)
            rows = order[a:z]
            own = ragged(at[rows], size[rows])
            starts = np.concatenate(([0], np.cumsum(size[rows])))
            d, x = dims[own], scaled[own]
            centroid = np.bincount(d, x, self.n_dims) / len(rows)
            within, middle = square[rows], float(centroid @ centroid)
            away = np.maximum(within - 2 * _of_rows(x * centroid[d], starts) + middle, 0.0)
            # what rounding may have taken from a squared distance is far below this share of its terms
            radius = math.sqrt(float(away.max()) + 1e-10 * (float(within.max()) + middle))
            up = np.zeros(self.n_dims, np.int64)  # centroid plus upward radius in each dimension
            np.maximum.at(up, d, values[own])
            ball = (_of_rows(centroid[q_dims] * q_root, q_at) + q_norm * radius) * (1 + 1e-9) + 1
            bounds.append(np.minimum(np.minimum(ball, 2.0**62).astype(np.int64), _of_rows(up[q_dims] * q_weight, q_at)))
            if z - a <= leaf:
                continue
            far = _of_rows(x * self._dense(d, x, starts, int(away.argmax()))[d], starts)
            from_first = within + within[away.argmax()] - 2 * far
            second = int(from_first.argmax())
            from_second = within + within[second] - 2 * _of_rows(x * self._dense(d, x, starts, second)[d], starts)
            if from_first[second] <= 1e-9 * float(within.max()):
                continue  # equal rows
            nearer = from_first - from_second
            split = nearer <= 0
            if min(split.sum(), len(rows) - split.sum()) * 8 < len(rows):  # no thin slices: cut at the median
                split = np.zeros(len(rows), bool)
                split[np.argsort(nearer, kind="stable")[: len(rows) // 2]] = True
            order[a:z] = np.concatenate((rows[split], rows[~split]))
            middle_at = a + int(split.sum())
            self.children[me] = (-1, -1)
            work += [(middle_at, z, me, 1), (a, middle_at, me, 0)]
        self.order, self.bounds = order, np.array(bounds).reshape(len(bounds), len(queries))
        own = ragged(at[order], size[order])
        self.at, self.dims, self.values = np.concatenate(([0], np.cumsum(size[order]))), dims[own], values[own]

    def _dense(self, d: np.ndarray, x: np.ndarray, starts: np.ndarray, row: int) -> np.ndarray:
        out = np.zeros(self.n_dims)
        out[d[starts[row] : starts[row + 1]]] = x[starts[row] : starts[row + 1]]
        return out

    def search(self, query: int, weights: np.ndarray, keys: list, best: list[tuple[int, int]], k: int = TOP) -> int:
        """Put the members with positive scores into ``best``, a heap of at most ``k`` (score, -key) with the least first.

        ``weights`` are the query's in all dimensions, ``keys`` the rows' keys, of which lower ones win ties. Returns the
        number of leaves scored."""
        bound = self.bounds[:, query].tolist()
        queue, leaves = [(-bound[0], 0)], 0
        while queue:
            most, node = heapq.heappop(queue)
            if most == 0 or (len(best) == k and -most < best[0][0]):
                break
            below = self.children[node]
            if below is not None:
                for child in below:
                    heapq.heappush(queue, (-bound[child], child))
                continue
            leaves += 1
            a, z = self.span[node]
            i, j = self.at[a], self.at[z]
            scores = _of_rows(weights[self.dims[i:j]] * self.values[i:j], self.at[a : z + 1] - i)
            least = best[0][0] if len(best) == k else 1
            for r in np.flatnonzero(scores >= least):
                entry = (int(scores[r]), -keys[self.order[a + r]])
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        return leaves


def term_weights(df: dict[int, int], n_docs: int, size: int) -> np.ndarray:
    """The integer weight of each term from its document frequency."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(t, 0) + 1))) for t in range(size)], np.int64)


def document_values(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term's weight is multiplied by in a document of ``n`` terms that holds it ``tf`` times (integers)."""
    if len(n) and 90 * int(n.max()) * n_docs >= 2**63:
        m = 10 + np.array([90 * int(x) * n_docs // n_terms for x in n], np.int64)
    else:
        m = 10 + (90 * n * n_docs) // max(n_terms, 1)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


NULL_KEY = 2**63  # of a null id: after all others


def _searched(blocks: DataFrame, items: list[np.ndarray], weights: np.ndarray, n_docs: int, n_terms: int, k: int, tree_docs: int, leaf: int) -> DataFrame:
    """(item, doc_id, score) of the ``k`` best documents of each task for each item (by its place in ``items``)."""
    out = StructType().add("item", LongType()).add("doc_id", LongType()).add("score", LongType())

    def run(batches):
        best: list[list[tuple[int, int]]] = [[] for _ in items]
        held: list[tuple] = []

        def grow():
            keys = [NULL_KEY if i is None else i for b in held for i in b[0]]
            n, per_row, terms, tf = (np.concatenate([b[c] for b in held]) for c in (1, 2, 3, 4))
            held.clear()
            if not keys:
                return
            used, dims = np.unique(terms, return_inverse=True)
            local = np.full(len(weights), -1, np.int64)
            local[used] = np.arange(len(used))
            queries = [(i, q[q >= 0]) for i, q in ((i, local[q]) for i, q in enumerate(items))]
            queries = [(i, q) for i, q in queries if len(q)]
            values = document_values(tf, np.repeat(n, per_row), n_docs, n_terms)
            own = weights[used]
            tree = BallTree(np.concatenate(([0], np.cumsum(per_row))), dims, values, own, [q for _, q in queries], leaf)
            asked = np.zeros(len(used), np.int64)
            for place, (i, q) in enumerate(queries):
                asked[q] = own[q]
                tree.search(place, asked, keys, best[i], k)
                asked[q] = 0

        for b in batches:
            for r in range(b.num_rows):
                blobs = (unpacked(b.column(c)[r].as_py()).astype(np.int64) for c in ("sizes", "held", "terms", "tf"))
                held.append((b.column("ids")[r].as_py(), *blobs))
                if sum(len(h[0]) for h in held) >= tree_docs:
                    grow()
        if held:
            grow()
        rows = [(i, None if -key == NULL_KEY else -key, score) for i, found in enumerate(best) for score, key in found]
        cols = list(zip(*rows)) if rows else [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=out.fieldNames())

    return blocks.select("ids", "sizes", "held", "terms", "tf").mapInArrow(run, out)


# --- pass 3: ranks ----------------------------------------------------------------


def ranked_search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", k: int = TOP, tree_docs: int = TREE, leaf: int = LEAF) -> DataFrame:
    """item id, rank, document id and score of each item's ``k`` best documents."""
    spark = docs.sparkSession
    parts: list[DataFrame] = []
    asked = items.select(F.col(item_col).alias("_item"), F.col(item_text).cast("string").alias("_text"))
    size = asked.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    turns = -(-size // ITEM_BYTES)
    turn = F.pmod(F.xxhash64("_item"), F.lit(max(turns, 1)))
    kind = items.schema[item_col].dataType
    empty = spark.createDataFrame([], StructType().add(item_col, kind).add("rank", IntegerType()).add(id_col, LongType()).add("score", LongType()))
    for i in range(turns):
        rows = asked.where(turn == i).collect()  # about ITEM_BYTES of text
        starts, flat = term_lists(texts_of(pa.array([r["_text"] for r in rows], pa.large_string())))
        flat = flat.dictionary_encode()
        vocabulary, codes = flat.dictionary, flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        names: dict = {}
        for r, a, z in zip(rows, starts, starts[1:]):
            names.setdefault(r["_item"], set()).update(codes[a:z].tolist())
        names = {x: t for x, t in names.items() if t}
        if not names:
            continue
        blocks = written(term_blocks(docs, vocabulary, id_col, text_col), "terms")
        n_docs, n_terms = blocks.agg(F.sum("n_docs"), F.sum("n_terms")).first()
        if not n_docs:
            continue
        df = blocks.select(F.explode(F.arrays_zip("df_term", "df")).alias("t")).groupBy("t.df_term").agg(F.sum("t.df").alias("df"))
        weights = term_weights({r["df_term"]: r["df"] for r in df.collect()}, n_docs, len(vocabulary))
        lists = [np.array(sorted(t), np.int64) for t in names.values()]
        found = _searched(blocks, lists, weights, n_docs, n_terms, k, tree_docs, leaf)
        ids = spark.createDataFrame([(i, x) for i, x in enumerate(names)], StructType().add("item", LongType()).add(item_col, kind))
        place = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
        parts.append(best.join(F.broadcast(ids), "item").select(item_col, "rank", F.col("doc_id").alias(id_col), "score"))
    for p in parts:
        empty = empty.unionByName(p)
    return empty


def op12_ball_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), total AS (
  SELECT count(*)::BIGINT AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d WHERE len(terms) > 0
), tf AS (
  SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, len(terms)::BIGINT AS n, unnest(terms) AS term FROM d) GROUP BY ALL
), w AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, total GROUP BY term, n_docs
), scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * n_docs) // n_terms)))))::BIGINT AS score
  FROM i JOIN tf USING (term) JOIN w USING (term), total
  GROUP BY item_id, doc_id
), ranked AS (
  SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
