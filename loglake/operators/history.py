"""Duplicates against everything that ever was, without reading it again.

An id history holds, for the ids of all batches so far, compressed bitmaps (one bit per hashed id, in buckets of 32,768
bits) and the ids themselves. A batch meets the bitmaps of its buckets: an id whose bit is not set was never there, and that
settles nearly all new ids. Only the ids whose bit is set are compared with the ids of their part of the history, so the
result is exact whatever the hash does.

Each batch adds a folder to the bitmaps and to the ids (written over if the batch is run again); ``compact`` folds the bitmaps
into one. Ids are any type with a text form; a null id equals no other and always stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglake.operators.dedup import dedup_batch
from loglake.operators.sizing import broadcast_if_small
from loglake.session import delete_path, path_exists

BUCKET_BITS = 32_768  # of Spark's bitmap functions
PARTS = 64  # folders of ids: an id is looked for in its own


class IdHistory:
    """The ids seen so far, at ``root``. ``space`` is the number of bits; about ten times the number of ids keeps the
    exact comparison to a tenth of the new ids (a smaller one is slower, not wrong)."""

    def __init__(self, spark: SparkSession, root: str, space: int = 1 << 33):
        if space % BUCKET_BITS:
            raise ValueError(f"the number of bits must be a multiple of {BUCKET_BITS}")
        self.spark, self.root, self.space = spark, root.rstrip("/"), space

    def _placed(self, df: DataFrame, id_col: str) -> DataFrame:
        bit = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(self.space))
        placed = df.withColumn("_id", F.col(id_col).cast("string")).withColumn("_bit", bit)
        return placed.withColumn("_bucket", F.expr(f"_bit div {BUCKET_BITS}")).withColumn("_pos", F.expr(f"cast(_bit % {BUCKET_BITS} as int)"))

    def _bitmaps(self) -> DataFrame | None:
        path = f"{self.root}/bitmaps"
        if not path_exists(self.spark, path):
            return None
        read = self.spark.read.schema("_bucket bigint, bitmap binary").option("recursiveFileLookup", True)
        return read.parquet(path).groupBy("_bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))

    def new(self, df: DataFrame, id_col: str, order: list[str] | None = None) -> DataFrame:
        """The rows of a batch that are first with their id, in the batch (by ``order``) and in all of the history."""
        cols = df.columns
        once = self._placed(dedup_batch(df, id_col, order), id_col)
        bitmaps = self._bitmaps()
        if bitmaps is None:
            return once.select(*cols)
        byte = "cast(conv(hex(substring(bitmap, cast(_pos div 8 as int) + 1, 1)), 16, 10) as int)"
        hit = F.expr(f"coalesce((shiftright({byte}, _pos % 8) & 1) = 1, false) and _id is not null")
        met = once.join(bitmaps, "_bucket", "left").withColumn("_hit", hit).drop("bitmap")
        maybe = met.filter("_hit").withColumn("_part", F.expr(f"cast(_bucket % {PARTS} as int)"))
        keys = ["_part", "_id"]
        ids = self.spark.read.schema("_id string, batch int, _part int").option("basePath", f"{self.root}/ids").parquet(f"{self.root}/ids").select(*keys)
        # the history is read in place, not shuffled, as long as the ids to look for are few
        found = ids.join(broadcast_if_small(maybe.select(*keys)), keys, "left_semi")
        never = maybe.join(found, keys, "left_anti")
        return met.filter("not _hit").select(*cols).unionByName(never.select(*cols))

    def remember(self, df: DataFrame, id_col: str, batch_id: int) -> None:
        """Add the ids of a batch."""
        ids = self._placed(df.select(id_col).filter(F.col(id_col).isNotNull()).distinct(), id_col)
        ids = ids.select("_id", "_bucket", "_pos", F.expr(f"cast(_bucket % {PARTS} as int)").alias("_part"))
        # the ids first: a bit that is set always finds its id
        ids.select("_id", "_part").write.mode("overwrite").partitionBy("_part").parquet(f"{self.root}/ids/batch={int(batch_id)}")
        made = self.spark.read.schema("_id string, _part int").parquet(f"{self.root}/ids/batch={int(batch_id)}")
        bits = self._placed(made, "_id").groupBy("_bucket").agg(F.bitmap_construct_agg("_pos").alias("bitmap"))
        bits.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.root}/bitmaps/batch={int(batch_id)}")

    def compact(self, below: int) -> None:
        """Fold the bitmaps of the batches before ``below`` into one folder."""
        path = f"{self.root}/bitmaps"
        old = [b for b in range(below) if path_exists(self.spark, f"{path}/batch={b}")]
        if len(old) < 2:
            return
        folded = self.spark.read.schema("_bucket bigint, bitmap binary").parquet(*(f"{path}/batch={b}" for b in old)).groupBy("_bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
        # written beside them first: until the old folders go, a bit is merely there twice
        folded.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/folded={below}")
        for b in old:
            delete_path(self.spark, f"{path}/batch={b}")
