"""Dense numbering of rows inside groups without gathering a group in one task.

``row_number() OVER (PARTITION BY topic, partition ORDER BY ...)`` sends a
whole topic partition to one task; a hot partition (a third of the log) would
then be sorted by one core. Here the rows are range-partitioned on
(group, order) so a hot group is split across many tasks, each task numbers its
own contiguous run, and a tiny table of run sizes turns local numbers into
global ones:

1. range-partition + sort on (group, order); tag each row with
   ``monotonically_increasing_id`` (partition index in the high bits, position
   in the partition in the low bits);
2. write the tagged rows once to the shared scratch folder, so the ids are fixed
   values (a re-run after a lost executor could otherwise sample other range
   bounds and give other ids);
3. per (task, group): row count and first id -- at most
   ``tasks + groups - 1`` rows, proven small before it is broadcast;
4. offset = rows of the group in earlier tasks + (id - first id of the run).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loglake.operators.sizing import file_tasks
from loglake.session import scratch_path

# Largest run table we broadcast (rows). Beyond it the join shuffles on the run
# key, which is unique per row of the run table, so it cannot skew.
BROADCAST_RUN_ROWS = 2_000_000
_ID_BITS = 33  # monotonically_increasing_id puts the partition index above bit 33


def number_within(
    df: DataFrame,
    group_cols: list[str],
    order_cols: list[str],
    out: str = "offset",
    base: str | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``out`` = 0-based position of each row inside its group by
    ``order_cols`` (plus column ``base`` when given). Nulls of a group column
    are a group of their own; ``order_cols`` should be a total order inside a group for a
    reproducible numbering (ties are numbered in an arbitrary but fixed way)."""
    spark = df.sparkSession
    keys = [*group_cols, *order_cols]
    tagged = (
        df.repartitionByRange(num_partitions or file_tasks(df), *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    path = scratch_path(spark, "numbering")
    tagged.write.mode("overwrite").parquet(path)
    fixed = spark.read.parquet(path).withColumn("_task", F.shiftright(F.col("_mid"), _ID_BITS))

    earlier = Window.partitionBy(*group_cols).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        fixed.groupBy("_task", *group_cols)
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .select(F.col("_task").alias("_t"), *(F.col(c).alias(f"_g{i}") for i, c in enumerate(group_cols)), "_first", "_before")
    )
    if runs.count() <= BROADCAST_RUN_ROWS:
        runs = F.broadcast(runs)
    number = F.col("_before") + F.col("_mid") - F.col("_first")
    if base is not None:
        number = number + F.col(base)
    same = F.col("_task") == F.col("_t")
    for i, c in enumerate(group_cols):  # a null group is a group
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    out_df = (
        fixed.join(runs, same)
        .withColumn(out, number.cast("bigint"))
        .drop("_task", "_mid", "_first", "_before", "_t", *(f"_g{i}" for i in range(len(group_cols))))
    )
    out_df.scratch = [path]  # copies to delete once the numbered rows are written elsewhere
    return out_df
