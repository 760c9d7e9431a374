"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglake.llm.scratch import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v): root is the least node of its component.

    Edges are star-shaped after each step, so hot nodes cost no more than their edges; each round is written, and the
    rounds grow with the logarithm of the longest path. Only two numbers of each round come to the driver.
    """
    now = written(edges.toDF("u", "v").where("u <> v").distinct(), "edges")
    state = None
    while True:
        now = written(_small_star(_large_star(now)).where("u <> v").distinct(), "edges")
        told = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(told) == state:
            break
        state = tuple(told)
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.toDF("node", "root").union(roots.select("node", F.col("node").alias("root")))
