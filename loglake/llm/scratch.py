"""Written tables that cut lineage, in the folder that the cluster shares, and ranks over a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loglake.operators.sizing import input_bytes
from loglake.session import scratch_path

TASK_BYTES = 256 << 20
_BITS = 33  # monotonically_increasing_id: the partition's index stands above this bit


def written(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """``df`` written once and read back: its values are fixed from here on, whatever executor is lost later."""
    path = scratch_path(df.sparkSession, "llm", name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def range_tasks(df: DataFrame) -> list[int]:
    """The count to give to a range exchange of ``df``, to unpack before its columns: none while the session's shuffle
    partitions hold at most ``TASK_BYTES`` each, else as many as it takes (AQE does not split range partitions)."""
    size = input_bytes(df)
    tasks = -(-size // TASK_BYTES) if size is not None else 0
    return [tasks] if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else []


def ranked(df: DataFrame, order: list[str], name: str, sums: dict[str, str] | None = None) -> DataFrame:
    """``df`` with ``rank`` (0-based, over all rows by ``order``, nulls first) and ``n_total``.

    Range partitions hold runs of the order; a run table with one row per task turns places in a task into ranks.
    Ties get different ranks in a fixed, arbitrary order. ``sums``: for each name, that column's sum over all earlier rows.
    """
    sums = sums or {}
    placed = df.repartitionByRange(*range_tasks(df), *order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id())
    fixed = written(placed, name).withColumn("_run", F.shiftright("_place", _BITS))
    before = Window.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    runs = fixed.groupBy("_run").agg(F.count(F.lit(1)).alias("_n"), *(F.sum(c).alias(f"_s_{k}") for k, c in sums.items()))
    runs = runs.select(
        "_run",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(whole).alias("n_total"),
        *(F.coalesce(F.sum(f"_s_{k}").over(before), F.lit(0)).alias(f"_b_{k}") for k in sums),
    )
    # one row for each task of the range exchange: far below any broadcast bound
    out = fixed.join(F.broadcast(runs), "_run")
    within = Window.partitionBy("_run").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    for k, c in sums.items():
        out = out.withColumn(k, F.col(f"_b_{k}") + F.coalesce(F.sum(c).over(within), F.lit(0)))
    place = F.col("_place").bitwiseAND(F.lit((1 << _BITS) - 1))
    return out.withColumn("rank", F.col("_before") + place).drop("_run", "_place", "_before", *(f"_b_{k}" for k in sums))
